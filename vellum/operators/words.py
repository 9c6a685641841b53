"""From recognised words to lines, blocks, columns, pages and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import strip


def joined_in_order(value: Column, order: list[Column], separator: str) -> Column:
    """Aggregate: values joined in an explicit order."""
    rows = F.array_sort(F.collect_list(F.struct(*(o.alias(f"k{i}") for i, o in enumerate(order)), value.alias("v"))))
    return F.array_join(F.transform(rows, lambda r: r["v"]), separator)


def usable_words(words: DataFrame) -> DataFrame:
    """Words that hold more than white space and were recognised with a positive confidence."""
    return words.withColumn("text", strip(F.col("text"))).where((F.col("text") != "") & (F.col("conf").cast("int") > 0))


def words_to_lines(words: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each (block, line): its words in order of arrival. Paragraphs are not told apart."""
    return (
        usable_words(words)
        .groupBy(*keys, "block_num", "line_num")
        .agg(
            joined_in_order(F.col("text"), [F.col("seq")], " ").alias("line"),
            F.count("*").alias("n_words"),
            F.sum("conf").cast("long").alias("sum_conf"),
        )
    )


def lines_to_text(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Lines joined by newline in order of (block, line), with word count and mean confidence."""
    return lines.groupBy(*keys).agg(
        joined_in_order(F.col("line"), [F.col("block_num"), F.col("line_num")], "\n").alias("text"),
        F.sum("n_words").alias("word_count"),
        (F.sum("sum_conf") / F.sum("n_words")).alias("mean_conf"),
    )


def blocks_to_columns(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Non-empty blocks joined by a blank line; confidence is the plain mean of the blocks'."""
    return (
        blocks.where("text <> ''")
        .groupBy(*keys)
        .agg(
            joined_in_order(F.col("text"), [F.col("block")], "\n\n").alias("full_text"),
            F.avg("confidence").alias("confidence"),
            F.count("*").alias("n_blocks"),
        )
    )


def reading_order(header: Column, columns: Column) -> Column:
    """Header and columns, the empty ones left out, joined by a blank line."""
    return F.array_join(F.filter(F.concat(F.array(header), columns), lambda x: x != ""), "\n\n")


def page_confidence(header: Column, columns: Column) -> Column:
    """Mean over the header (0 where it is empty) and all columns."""
    values = F.concat(F.array(header), columns)
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x) / F.size(values)


def pages_to_documents(pages: DataFrame, key: str, page: str, text: str) -> DataFrame:
    return pages.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(page, text))), lambda r: r[text]).alias("pages")
    )


def page_banner(page: Column, header: Column, columns: Column) -> Column:
    """The text rendering of a page; ``columns`` holds index, confidence (one decimal) and full_text."""
    head = F.when(header != "", F.concat(F.lit("[HEADER]\n"), header, F.lit("\n\n"))).otherwise("")
    body = F.transform(
        columns,
        lambda c: F.concat(
            F.lit("--- Column "), c["index"].cast("string"), F.lit(" (confidence: "), c["confidence"],
            F.lit("%) ---\n"), c["full_text"], F.lit("\n\n"),
        ),
    )
    return F.concat(F.lit("===== Page "), page.cast("string"), F.lit(" =====\n\n"), head, F.array_join(body, ""))


def large_enough(height: Column, width: Column, least: int) -> Column:
    return (height >= least) & (width >= least)
