"""From scanned documents to nested JSON and rendered text, one folder for each document."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.text import python_round
from vellum.operators import layout, pages, words
from vellum.sources import files


def rendered(results: DataFrame) -> DataFrame:
    """The text file of each page: a banner, the header if there is one, and every column."""
    columns = F.transform(
        "columns",
        lambda c: F.struct(c["index"].alias("index"), F.format_string("%.1f", c["confidence"]).alias("confidence"), c["full_text"].alias("full_text")),
    )
    return results.select("source_pdf", "page", words.page_banner(F.col("page"), F.col("header.text"), columns).alias("text"))


def overlays(results: DataFrame, longest: int = 2000) -> DataFrame:
    """What a debug image would draw on each page, scaled to at most ``longest`` pixels."""
    scale = F.least(F.lit(1.0), F.lit(longest) / F.greatest("image_size.width", "image_size.height"))
    boxes = F.transform("columns", lambda c: F.struct(c["index"].alias("index"), c["bounds"]["x"].alias("x"), c["bounds"]["width"].alias("width")))
    header_end = F.col("header.bounds.y_end")
    return results.select("source_pdf", "page", layout.overlay(boxes, header_end, scale).alias("overlay"))


def run(
    spark: SparkSession, source: str, output: str, make: Callable[[], tuple[pages.Renderer, pages.Recogniser]],
    dpi: int = 600, page_range: str | None = None, debug: bool = False,
) -> DataFrame:
    """Recognise every document of a folder and write ``json``, ``text``, ``failures`` (what could
    not be read, and why) and, if asked for, ``debug``.

    A document is a unit of work, read and recognised in one task; only words are shuffled.
    """
    docs = files.collect_documents(spark, source)
    found = pages.recognise(docs, make, dpi, page_range)
    path = files.scratch(spark, "words")
    found.write.parquet(path)  # pages are recognised once, whatever is written from them
    found_again = spark.read.schema(found.schema).parquet(path)
    results = pages.assemble(found_again, dpi)
    files.save_json(pages.documents(results), f"{output}/json", "source_pdf")
    files.save_text(rendered(results).orderBy("source_pdf", "page"), f"{output}/text", "source_pdf")
    pages.failures(found_again).write.json(f"{output}/failures")
    if debug:
        overlays(results).write.json(f"{output}/debug")
    return results


def _load(name: str) -> Callable[[], tuple[pages.Renderer, pages.Recogniser]]:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="vellum.plans.scan", description="Recognise scanned documents.")
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--engine", required=True, help="module:function that makes a (renderer, recogniser) pair")
    parser.add_argument("--resolution", type=int, default=600)
    parser.add_argument("--pages", help="a-b or a, from 1, both ends included")
    parser.add_argument("--debug", action="store_true")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("vellum-scan").getOrCreate()
    results = run(spark, args.input, args.output, _load(args.engine), args.resolution, args.pages, args.debug)
    print(results.select(F.count("*"), python_round(F.avg("average_confidence"))).first())


if __name__ == "__main__":
    main()
