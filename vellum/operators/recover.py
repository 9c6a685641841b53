"""Selection, resume and bookkeeping over row tables keyed by ``row_idx``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def parse_page_range(text: str) -> tuple[int, int]:
    """``a-b`` or ``a``: pages from 1, both ends included."""
    first, _, last = text.partition("-")
    return int(first), int(last or first)


def parse_row_range(text: str, n_rows: int) -> tuple[int, int]:
    """``a-b`` or ``a``: rows from 0, the end excluded and held to the number of rows; a single
    row is not held to it. A leading minus sign is an error."""
    if "-" not in text:
        return int(text), int(text) + 1
    first, _, last = text.partition("-")
    return int(first), min(int(last), n_rows)


def select_pages(df: DataFrame, spec: str, page: str, n_pages: Column | None = None) -> DataFrame:
    """Rows whose page lies in a range; pages that do not exist are skipped, not clamped."""
    first, last = parse_page_range(spec)
    wanted = F.col(page).between(first, last)
    return df.where(wanted if n_pages is None else wanted & F.col(page).between(1, n_pages))


def select_rows(df: DataFrame, start: int, end: int | None, idx: str = "row_idx") -> DataFrame:
    keep = F.col(idx) >= start
    return df.where(keep if end is None else keep & (F.col(idx) < end))


def last_wins(log: DataFrame, key: str, seq: str) -> DataFrame:
    """The last entry of each key; entries without a key are dropped."""
    rest = [c for c in log.columns if c != key]
    latest = F.max_by(F.struct(*rest), F.col(seq)).alias("_last")
    return log.where(F.col(key).isNotNull()).groupBy(key).agg(latest).select(
        *(F.col(key) if c == key else F.col(f"_last.{c}").alias(c) for c in log.columns)
    )


def pending(rows: DataFrame, done: DataFrame, key: str = "row_idx") -> DataFrame:
    """Rows that no run has completed."""
    return rows.join(done.select(key), key, "left_anti")


def completed(rows: DataFrame, done: DataFrame, key: str = "row_idx") -> DataFrame:
    """Rows that a run has completed."""
    return rows.join(done.select(key).distinct(), key, "left_semi")


def completed_texts(rows: DataFrame, done: DataFrame, key: str = "row_idx", text: str = "text") -> DataFrame:
    """The completed rows with their corrected texts: what an unfinished run can already give."""
    return rows.drop(text).join(done.select(key, text).dropDuplicates([key]), key)


def merge_completed(rows: DataFrame, done: DataFrame, key: str = "row_idx", text: str = "text") -> DataFrame:
    """Every row with its corrected text, or its own where there is none yet.

    A recorded null or empty text counts as recorded, so presence decides, not the value. A row
    that was recorded twice comes once.
    """
    once = done.dropDuplicates([key])
    marked = once.select(key, F.col(text).alias("_done_text"), F.lit(True).alias("_done"))
    joined = rows.join(marked, key, "left")
    value = F.when(F.col("_done"), F.col("_done_text")).otherwise(F.col(text))
    return joined.withColumn(text, value).withColumn("completed", F.coalesce("_done", F.lit(False))).drop("_done", "_done_text")


def with_fallback(corrected: Column, error: Column, original: Column) -> Column:
    """A failed row keeps its text, and counts as done."""
    return F.when(error.isNotNull(), original).otherwise(corrected)


def config_hash(*parts: Column) -> Column:
    """First 16 hex digits of the SHA-256 over parts joined by ``|``, spelled as Python does."""
    return F.substring(F.sha2(F.concat_ws("|", *(F.coalesce(p, F.lit("None")) for p in parts)), 256), 1, 16)


def spelled(flag: Column) -> Column:
    """A boolean as ``True`` or ``False``."""
    return F.initcap(flag.cast("string"))


def run_config_hash(path, era, skip_regex, skip_enrich, model, start, end, *extra: str) -> str:
    """The hash of a run's settings. ``extra`` (rule-set version, input fingerprint) closes the
    hole that a changed input or rule set would otherwise resume an old run."""
    import hashlib

    key = "|".join(str(p) for p in (path, era, skip_regex, skip_enrich, model, start, end, *extra))
    return hashlib.sha256(key.encode()).hexdigest()[:16]


def checkpoint_batches(df: DataFrame, every: int, order: str, group: Column) -> DataFrame:
    """Number the batches in which rows are committed: ``every`` rows each, in order.

    Batches follow the order within ``group``, the unit that one writer commits; one task orders
    a group, so there is no group of all rows by default.
    """
    by = Window.partitionBy(group).orderBy(order)
    return df.withColumn("batch", F.floor((F.row_number().over(by) - 1) / every).cast("long"))


def length_delta(before: Column, after: Column) -> Column:
    return (F.length(before) - F.length(after)).cast("long")


def rate_limit_starts(df: DataFrame, arrival_us: str, order: str, per_minute: int, group: Column) -> DataFrame:
    """When each call may start under a minimum spacing: a running maximum over arrivals.

    Calls queue within ``group`` (a worker's share of the limit), which one task orders.
    """
    gap = 60_000_000 // per_minute
    by = Window.partitionBy(group).orderBy(order)
    n = F.row_number().over(by) - 1
    ready = df.withColumn("_n", n).withColumn("_base", F.col(arrival_us) - F.col("_n") * gap)
    upto = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ready.withColumn("start_us", F.max("_base").over(upto) + F.col("_n") * gap).drop("_n", "_base")


def is_shortened(before: Column, after: Column, least: float = 0.9) -> Column:
    """Whether a reply keeps less than a share of the text's length; never of an empty text."""
    size = F.length(before)
    return F.coalesce((size > 0) & (F.length(after) / size < least), F.lit(False))


def token_budget(text: Column) -> Column:
    """Reply tokens allowed: one and a half times the estimate, within 1024 and 16384."""
    tokens = F.ceil(F.length(text) / 4).cast("long")
    return F.greatest(F.lit(1024), F.least(F.lit(16384), F.floor(tokens * 3 / 2))).cast("long")


def retry_delays(attempts: int = 3) -> Column:
    """Seconds waited after each failed attempt but the last: 2, 4, 8, ..."""
    return F.transform(F.sequence(F.lit(1), F.lit(max(1, attempts - 1))), lambda k: F.pow(F.lit(2), k).cast("int"))


def page_id(path: Column, page: Column) -> Column:
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]+$", "")
    return F.format_string("%s_p%02d", stem, page)


def is_safe_key(name: str) -> bool:
    return bool(re.fullmatch(r"[A-Za-z0-9_.-]+", name))
