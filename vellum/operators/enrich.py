"""Calling an external corrector: spacing, retries, and what stands in for it offline."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import strip
from vellum.operators import chunks as C


class Enricher(Protocol):
    def __call__(self, chunk: str) -> str | None: ...


class RateLimiter:
    """A minimum spacing between calls, shared by the threads of a process."""

    def __init__(self, per_minute: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.gap, self.clock, self.sleep = 60.0 / per_minute, clock, sleep
        self.next, self.lock = float("-inf"), threading.Lock()

    def wait(self) -> None:
        with self.lock:
            now = self.clock()
            start = max(now, self.next)
            self.next = start + self.gap
            if start > now:
                self.sleep(start - now)


def with_retries(call: Enricher, attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> Enricher:
    """Try a call several times, waiting 2, 4, 8, ... seconds in between; the last error is raised."""

    def run(chunk: str) -> str | None:
        for attempt in range(1, attempts + 1):
            try:
                return call(chunk)
            except Exception:
                if attempt == attempts:
                    raise
                sleep(2.0**attempt)
        return None

    return run


def limited(call: Enricher, limiter: RateLimiter) -> Enricher:
    """Wait for the limiter once for each chunk, before the first attempt."""

    def run(chunk: str) -> str | None:
        limiter.wait()
        return call(chunk)

    return run


def partition_limiter(per_minute: float, partitions: int) -> RateLimiter:
    """The share of a limit that each of so many concurrent partitions may use."""
    return RateLimiter(per_minute / max(1, partitions))


def enrich_texts(
    df: DataFrame,
    make_enricher: Callable[[], Enricher],
    key: str = "row_idx",
    text: str = "text",
    limit: int = C.MAX_CHARS,
    partitions: int | None = None,
    compat: bool = False,
    threads: int = 1,
    least_ratio: float | None = None,
) -> DataFrame:
    """Send texts through an enricher in chunks; blank texts stay as they are.

    The enricher sees only rows that need it: blank rows take another way. ``key`` must be
    unique. Adds ``error``, the first failure among a row's chunks, whose text then stays.
    """
    blank = strip(F.coalesce(F.col(text), F.lit(""))) == ""
    parts = C.explode_chunks(df.where(~blank).select(key, text), text, limit)
    if partitions:
        parts = parts.repartition(partitions, key, "pos")
    replies = C.map_chunks(parts, make_enricher, compat, threads, least_ratio)
    errors = replies.groupBy(key).agg(F.min("error").alias("error"))
    done = C.reassemble(replies, [key], text).join(errors, key)
    seen = df.where(~blank).drop(text).join(done, key)
    return seen.unionByName(df.where(blank).withColumn("error", F.lit(None).cast("string")))
