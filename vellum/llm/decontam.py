"""Benchmark decontamination by Wu-Manber search over words.

Test texts are cut into windows of eight words. Windows of one length share a shift table over
blocks of two words: a block that no window holds lets the search jump almost a window ahead; a
block that ends some window selects, by that suffix and by the first word, the few windows that
are then compared in full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import cut, slices, unused

WINDOW = 8
BLOCK = 2
#: Bytes that one search table may hold in memory; a larger test set is searched in several
#: passes, whose tables are not held at once.
TABLE_BYTES = 128 << 20
#: What is reckoned for a word of a test text, and for a distinct word of the vocabulary.
WORD_BYTES, DISTINCT_BYTES = 48, 176

_UPPER, _DIGIT, _LOWER = range(0x41, 0x5B), range(0x30, 0x3A), range(0x61, 0x7B)
#: A-Z to a-z; bytes of digits, a-z and non-ASCII characters stay; any other byte parts words.
_FOLD = bytes(
    b + 32 if b in _UPPER else b if b >= 0x80 or b in _DIGIT or b in _LOWER else 0x20 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: runs of digits, letters a-z after folding A-Z, and non-ASCII."""
    return text.translate(_FOLD).split() if text else []


def windows_of(words: list[bytes], size: int = WINDOW) -> Iterator[tuple[bytes, ...]]:
    """Every run of ``size`` words; a shorter text, unless empty, is one window."""
    n = min(size, len(words))
    if n:
        for i in range(len(words) - n + 1):
            yield tuple(words[i : i + n])


def _mixed(a, b, bits: int):
    """A hash of two word numbers in ``bits`` bits, for whole numbers and arrays of them."""
    return ((a * 0x9E3779B1 + b * 0x85EBCA77) & 0xFFFFFFFF) >> (32 - bits)


class WuManber:
    """Search for many word sequences of one length, over numbered words.

    The shift table is an array over hashed blocks: where two blocks meet in one place, the
    smaller shift stands. The windows lie in buckets by the hash of their last block; in a
    bucket, first the first words are compared, then all. Nothing is held for a window but where
    it starts and whose it is.
    """

    def __init__(self, words: np.ndarray, starts: np.ndarray, owners: np.ndarray, length: int):
        self.length, self.block = length, min(BLOCK, length)
        self.jump = length - self.block + 1
        self.bits = min(30, max(4, (2 * len(starts)).bit_length()))
        self.words = words
        shift = np.full(1 << self.bits, self.jump, np.uint8)
        for end in range(self.block, length + 1):
            np.minimum.at(shift, self._block_at(starts + end), min(255, length - end))
        last = self._block_at(starts + length)
        order = np.lexsort((starts, last))
        self.starts, self.owners = starts[order], owners[order]
        self.first = words[self.starts]
        self.bucket = np.searchsorted(last[order], np.arange((1 << self.bits) + 1)).astype(np.int32)
        self.shift = shift.tobytes()

    def _block_at(self, ends: np.ndarray) -> np.ndarray:
        b = self.words[ends - 1].astype(np.int64)
        a = self.words[ends - 2].astype(np.int64) if self.block > 1 else np.zeros_like(b)
        return _mixed(a, b, self.bits)

    def search(self, words: list, number: Callable) -> Iterator[tuple[int, list[int]]]:
        """(start, owners) of every occurrence, from left to right. ``number`` gives a word's
        number in the vocabulary, or None; it is asked only for words that the search stops at."""
        shift, jump, bits, single = self.shift, self.jump, self.bits, self.block == 1
        at, n = self.length, len(words)
        while at <= n:
            b = number(words[at - 1])
            a = 0 if single else number(words[at - 2])
            if a is None or b is None:
                at += jump
                continue
            block = ((a * 0x9E3779B1 + b * 0x85EBCA77) & 0xFFFFFFFF) >> (32 - bits)
            skip = shift[block]
            if skip:
                at += skip
                continue
            found = self._confirm([number(w) for w in words[at - self.length : at]], block)
            if found:
                yield at - self.length, found
            at += 1

    def _confirm(self, text: list, block: int) -> list[int]:
        low, high = int(self.bucket[block]), int(self.bucket[block + 1])
        if text[0] is None:
            return []
        out = []
        for i in np.flatnonzero(self.first[low:high] == text[0]) + low:
            at = int(self.starts[i])
            if self.words[at : at + self.length].tolist() == text:
                out.append(int(self.owners[i]))
        return out


class Tables:
    """One search table for each window length that occurs, over one vocabulary."""

    def __init__(self, items: Iterable[tuple[str | None, bytes | None]], size: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.ids: list[str | None] = []
        number, flat, begin = self.vocabulary, [], [0]
        for item_id, text in items:
            words = words_of(text)
            self.ids.append(item_id)
            flat.append(np.array([number.setdefault(w, len(number) + 1) for w in words], np.int32))
            begin.append(begin[-1] + len(words))
        words = np.concatenate(flat) if flat else np.zeros(0, np.int32)
        counts = np.diff(begin)
        length = np.minimum(counts, size)
        self.searches = []
        for n in sorted({int(x) for x in length if x}):
            owners = np.flatnonzero(length == n)
            windows = counts[owners] - n + 1
            starts = np.concatenate([np.arange(begin[o], begin[o] + w) for o, w in zip(owners, windows)])
            self.searches.append(WuManber(words, starts.astype(np.int64), np.repeat(owners, windows).astype(np.int32), n))

    def find(self, words: list[bytes]) -> tuple[set[str], list[tuple[int, int]]]:
        """(ids of the items with an occurring window, word ranges that occurrences cover)."""
        found, hit = set(), []
        for table in self.searches:
            for start, owners in table.search(words, self.vocabulary.get):
                found.update(owners)
                hit.append((start, start + table.length))
        return {self.ids[o] for o in found if self.ids[o] is not None}, hit


def passes_for(words: int, distinct: int, table_bytes: int) -> int:
    """How many tables keep each within its bytes, whichever of the words each gets."""
    passes = 1
    while True:
        part = -(-words // passes)
        if WORD_BYTES * part + DISTINCT_BYTES * min(distinct, part) <= table_bytes or part <= 1:
            return passes
        passes += 1


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = WINDOW,
    min_items: int = 2,
    keep: list[str] | None = None,
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """Mark the words of documents that lie in an occurrence of a test window.

    Returns the columns ``keep`` (all, if None) of every row, with ``n_words``, ``n_hit``,
    ``spans`` (word ranges [a, b) that are hit), ``items`` (ids with an occurring window, as
    sorted strings) and ``contaminated`` (``min_items`` ids or more); columns of those names in
    the input are replaced. Null and empty texts have no words and hit nothing; repeated rows
    are judged alike; an item with a null id is searched for, but not counted as an item;
    repeated items count once; an empty test set hits nothing.

    Rows never leave their partition. The words and distinct words of the test set are counted
    beforehand; items are dealt by hash to so many tables that each holds ``table_bytes`` at
    most (an item longer than that makes a table of its own size). Each table is broadcast once,
    and between two tables the rows are written, so that only one is held at a time.
    """
    new = ["n_words", "n_hit", "spans", "items", "contaminated"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    spark, hidden = docs.sparkSession, unused(docs.columns, "_searched_text")
    state = docs.select(*keep, F.col(text_col).alias(hidden)).withColumns(
        {
            "n_words": F.lit(0).cast("long"),
            "n_hit": F.lit(0).cast("long"),
            "spans": F.array().cast("array<struct<a:int,b:int>>"),
            "items": F.array().cast("array<string>"),
        }
    )
    tests = (
        benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(item_text_col).cast("string").alias("t"))
        .where("t is not null")
        .distinct()
    )
    word = F.explode(F.regexp_extract_all("t", F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)")))
    counted = tests.select(word.alias("w")).groupBy("w").agg(F.count("*").alias("n")).agg(F.sum("n"), F.count("*")).first()
    passes = passes_for(counted[0] or 0, counted[1], table_bytes)
    lot = F.pmod(F.xxhash64("i", "t"), F.lit(passes))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in state.schema])
    for number in range(passes):
        part = (tests.where(lot == number) if passes > 1 else tests).select("i", F.col("t").cast("binary").alias("t"))
        tables = spark.sparkContext.broadcast(Tables(((r["i"], bytes(r["t"])) for r in part.toLocalIterator()), size))
        state = state.mapInArrow(_searcher(tables, hidden), schema)
        if number + 1 < passes:
            state = cut(state)
    return state.drop(hidden).withColumn("contaminated", F.size("items") >= min_items)


def _searcher(tables, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = tables.value.find
        for batch in slices(batches):
            cols = {n: batch.column(n) for n in batch.schema.names}
            n_words, n_hit, spans, items = [], [], [], []
            before = zip(cols["spans"].to_pylist(), cols["items"].to_pylist(), strict=True)
            for text, (old, seen) in zip(cols[text_col].cast(pa.large_binary()), before, strict=True):
                words = words_of(text.as_py())
                found, hit = find(words)
                hit = _merged(hit + [(s["a"], s["b"]) for s in old])
                n_words.append(len(words))
                n_hit.append(sum(b - a for a, b in hit))
                spans.append([{"a": a, "b": b} for a, b in hit])
                items.append(sorted(found.union(seen)))
            cols |= {
                "n_words": pa.array(n_words, pa.int64()),
                "n_hit": pa.array(n_hit, pa.int64()),
                "spans": pa.array(spans, batch.schema.field("spans").type),
                "items": pa.array(items, batch.schema.field("items").type),
            }
            yield pa.RecordBatch.from_arrays([cols[n] for n in batch.schema.names], schema=batch.schema)

    return run


_SQL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS w FROM documents
), b AS (
  SELECT item_id, {_SQL_WORDS} AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least({WINDOW}, len(w)) AS m,
    array_to_string(w[i : i + least({WINDOW}, len(w)) - 1], ' ') AS k
  FROM b, LATERAL unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS u(i)
  WHERE len(w) > 0
), dw AS (
  SELECT r, i, m, array_to_string(w[i : i + m - 1], ' ') AS k
  FROM d, (SELECT DISTINCT m FROM bw) AS ms, LATERAL unnest(range(1, len(w) - m + 2)) AS u(i)
), hits AS (
  SELECT r, i, dw.m AS m, item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.k = bw.k
), covered AS (
  SELECT r, count(DISTINCT i + j) AS n_hit
  FROM (SELECT DISTINCT r, i, m FROM hits) AS h, LATERAL unnest(range(0, m)) AS u(j) GROUP BY r
), found AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM hits WHERE item_id IS NOT NULL) AS x GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""
