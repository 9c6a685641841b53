"""Removal of long repeated strings with suffix arrays and longest-previous-factor arrays.

No suffix array spans the corpus. Every 200-byte string has one smallest byte n-gram under a
fixed hash order (its minimiser), so equal strings have equal minimisers at equal places. A text
falls into pieces, runs of string starts with one minimiser, and two strings can only be equal
if the minimisers of their pieces are. Pieces whose minimiser occurs once are out at once, equal
pieces are counted, and only the different pieces around one minimiser meet in a suffix array.
There the longest previous factor of a position tells whether its string starts earlier, and
where: the nearest smaller positions before and after it in suffix order are the candidates.

Pieces count as equal if two 64-bit hashes agree, of the piece and of its minimiser; as pieces
only meet those of their own minimiser, a billion pieces around one of them would agree by chance
with odds of one in 37.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import cut, drop_cut, map_columns, slices

LENGTH = 200
GRAM = 32
#: Bytes of text that one suffix array covers, groups being kept whole.
ARRAY_BYTES = 1 << 20
#: Different pieces around one minimiser that meet in one suffix array, about as many as it
#: covers; more are cut finer.
GROUP_PIECES = ARRAY_BYTES // 256
#: String starts that are hashed at once.
BLOCK_STARTS = 1 << 22
_PLACE_BITS = 24
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _gram_hashes(text: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each run of ``gram`` (a power of two) bytes, by doubling."""
    h = (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    factor, size = _BASE, 1
    while size < gram:
        h = h[:-size] * factor + h[size:]
        factor, size = factor * factor, size * 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _window_min(keys: np.ndarray, window: int) -> np.ndarray:
    size = 1
    while size * 2 <= window:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return np.minimum(keys[: len(keys) - (window - size)], keys[window - size :]) if window > size else keys


def pieces(text: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int, int, int]]:
    """(minimiser hash, piece hash, first start, number of starts) of each piece of a text."""
    view = memoryview(text)
    with np.errstate(over="ignore"):
        for block in range(0, len(text) - length + 1, BLOCK_STARTS):
            part = view[block : block + BLOCK_STARTS + length - 1]
            hashes = _gram_hashes(np.frombuffer(part, np.uint8), gram)
            places = np.arange(len(hashes), dtype=np.uint64)
            least = _window_min((hashes >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | places, length - gram + 1)
            first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
            count = np.diff(np.append(first, len(least)))
            at = (least[first] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
            for m, a, n in zip(hashes[at].view(np.int64).tolist(), first.tolist(), count.tolist()):
                p = xxhash.xxh3_64_intdigest(part[a : a + n + length - 1])
                yield m, p - (1 << 63), block + a, n


def suffix_levels(text: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """(bytes, ranks): the rank of each position by so many bytes from it on, for 8, 16, ... and
    last ``length`` bytes; equal strings share a rank.

    Prefix doubling: ranks of twice as many bytes come from sorting pairs of ranks.
    """
    n = len(text)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = text
    words = np.zeros(n, np.uint64)
    for k in range(min(8, length)):
        words |= padded[k : k + n].astype(np.uint64) << np.uint64(56 - 8 * k)
    size, rank = min(8, length), np.unique(words, return_inverse=True)[1].astype(np.int64)
    levels = [(size, rank)]
    while size < length:
        step = min(size, length - size)
        behind = np.zeros(n, np.int64)
        behind[: max(0, n - step)] = rank[step:] + 1
        rank = np.unique(rank * (n + 2) + behind, return_inverse=True)[1].astype(np.int64)
        size += step
        levels.append((size, rank))
    return levels


def common_prefixes(text: np.ndarray, levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes that the suffixes at a and b begin with in common, up to the length of the levels."""
    n, most = len(text), levels[-1][0]
    room = np.minimum(most, n - np.maximum(a, b))
    out = np.zeros(len(a), np.int64)
    for size, rank in reversed(levels):
        fits = np.flatnonzero(out + size <= room)
        same = rank[a[fits] + out[fits]] == rank[b[fits] + out[fits]]
        out[fits[same]] += size
    for _ in range(levels[0][0]):
        fits = np.flatnonzero(out < room)
        same = text[a[fits] + out[fits]] == text[b[fits] + out[fits]]
        if not same.any():
            break
        out[fits[same]] += 1
    return out


def longest_previous_factor(order: list[int], lcp: list[int]) -> tuple[list[int], list[int]]:
    """(length, source) of the longest factor that starts at each position and also earlier.

    ``order``: positions 0..n-1 in suffix order; ``lcp[r]``: common prefix of ranks r-1 and r.
    Positions leave a list in suffix order from the last to the first, so that the neighbours of
    each are then its nearest smaller positions on either side. Source -1: none.
    """
    n = len(order)
    if not n:
        return [], []
    up, down = [-1] * n, [-1] * n
    up_lcp, down_lcp = [0] * n, [0] * n
    for r in range(1, n):
        up[order[r]], down[order[r - 1]] = order[r - 1], order[r]
        up_lcp[order[r]] = down_lcp[order[r - 1]] = lcp[r]
    length, source = [0] * n, [-1] * n
    for i in range(n - 1, -1, -1):
        a, b, la, lb = up[i], down[i], up_lcp[i], down_lcp[i]
        if la >= lb:
            length[i], source[i] = la, (a if la else -1)
        else:
            length[i], source[i] = lb, b
        if a >= 0:
            down[a], down_lcp[a] = b, min(la, lb)
        if b >= 0:
            up[b], up_lcp[b] = a, min(la, lb)
    return length, source


def repeated_starts(parts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, again, earlier) over parts given from the earliest to the latest.

    ``starts``: (part, offset) of each string of ``length`` bytes; ``again``: it also starts
    elsewhere; ``earlier``: it also starts earlier.
    """
    sizes = np.array([len(p) for p in parts], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    text = np.frombuffer(b"".join(parts), np.uint8)
    counts = np.maximum(0, sizes - length + 1)
    part = np.repeat(np.arange(len(parts)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    again, earlier = np.zeros(len(part), bool), np.zeros(len(part), bool)
    if not len(part):
        return np.stack([part, offset]), again, earlier
    levels = suffix_levels(text, length)
    place = begin[part] + offset
    order = np.argsort(levels[-1][1][place], kind="stable")
    lcp = np.append(0, common_prefixes(text, levels, place[order[:-1]], place[order[1:]]))
    # a factor of the length lies between ranks that all have it in common: the list in suffix
    # order falls apart where neighbours have less, and ranks without a neighbour are left out
    near = (lcp >= length) | np.append(lcp[1:] >= length, False)
    left = order[near]
    if len(left):
        at = np.sort(left)
        dense = np.searchsorted(at, left)
        found, source = longest_previous_factor(dense.tolist(), lcp[near].tolist())
        found, source = np.array(found), np.array(source)
        late = found >= length
        earlier[at[late]] = again[at[late]] = True
        again[at[source[late]]] = True
    return np.stack([part, offset]), again, earlier


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


_RANGES = "array<struct<a:int,b:int>>"


def _compare_groups(length: int):
    """Rows (m, p, text), sorted by m with groups whole: the repeated starts of each piece."""
    out = pa.schema([("m", pa.int64()), ("p", pa.int64()), ("again", _arrow_ranges()), ("earlier", _arrow_ranges())])

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        rows = sorted(rows, key=lambda r: (r[0], r[2:6]))
        (part, _), again, earlier = repeated_starts([r[6] for r in rows], length)
        edges = np.searchsorted(part, np.arange(len(rows) + 1))
        ranges = lambda mask: [
            [{"a": a, "b": b} for a, b in _runs(mask[edges[i] : edges[i + 1]])] for i in range(len(rows))
        ]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array(ranges(again), _arrow_ranges()),
                pa.array(ranges(earlier), _arrow_ranges()),
            ],
            schema=out,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a piece of a repeated row comes once for each of its rows and is held once
        held: dict[tuple, tuple] = {}
        size, last = 0, None
        for batch in slices(batches):
            cols = [batch.column(c).to_pylist() for c in ("m", "p", "place", "d1", "d2", "at", "piece")]
            for row in zip(*cols, strict=True):
                if size > ARRAY_BYTES and row[0] != last:
                    yield flush(list(held.values()))
                    held, size = {}, 0
                last = row[0]
                if row[:2] not in held:
                    held[row[:2]] = row
                    size += len(row[6])
        if held:
            yield flush(list(held.values()))

    return run


def _arrow_ranges() -> pa.DataType:
    return pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _cut_pieces(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Add the bytes of pieces: ``wanted`` has d1, d2, at, n and more columns."""
    lists = wanted.groupBy("d1", "d2").agg(F.collect_list(F.struct(*wanted.columns)).alias("w"))
    rows = docs.join(lists, ["d1", "d2"]).select("_bytes", F.explode("w").alias("w"))
    return rows.select(
        "w.*", F.substring("_bytes", F.col("w.at") + 1, F.col("w.n") + (length - 1)).alias("piece")
    )


def repeated_spans(docs: DataFrame, length: int = LENGTH, keep_first: bool = False) -> DataFrame:
    """Byte ranges of texts that repeated strings cover.

    ``docs`` has ``d1, d2`` (a key of the row's text), ``o`` (its place in order) and ``_bytes``. Returns
    d1, d2 and ``spans``: sorted, disjoint [a, b). Without ``keep_first`` a string is repeated if
    it starts anywhere else; with it, if it starts anywhere earlier.
    """
    def fingerprint(d1, d2, o, text) -> dict[str, list]:
        cols: dict[str, list] = {c: [] for c in ("k1", "k2", "place", "m", "p", "at", "n")}
        for a, b, c, t in zip(d1, d2, o, text, strict=True):
            if t and len(t) >= length:
                for m, p, at, n in pieces(t, length):
                    for name, v in zip(cols, (a, b, c, m, p, at, n), strict=True):
                        cols[name].append(v)
        return cols

    types = {"k1": "long", "k2": "long", "place": "long", "m": "long", "p": "long", "at": "int", "n": "int"}
    inputs = {"d1": "d1", "d2": "d2", "o": "o", "text": "_bytes"}
    all_pieces = cut(map_columns(docs, fingerprint, inputs, types, keep=[]).withColumnsRenamed({"k1": "d1", "k2": "d2"}))
    # written tables, so that both sides of a join come from plain exchanges and hot keys can be split
    shared = cut(all_pieces.groupBy("m").agg(F.count("*").alias("c")).where("c > 1").select("m"))
    candidates = cut(all_pieces.join(shared, "m", "left_semi"))
    drop_cut(all_pieces, shared)
    place = F.struct("place", "d1", "d2", "at")
    distinct = cut(
        candidates.groupBy("m", "p").agg(F.count("*").alias("c"), F.min(place).alias("first"), F.first("n").alias("n"))
    )
    groups = distinct.groupBy("m").agg(F.count("*").alias("k")).where("k > 1")
    mixed = distinct.join(groups, "m").select("m", "p", "k", "n", "first.*")
    texts = cut(_cut_pieces(docs, mixed, length))
    compared = (
        texts.where(F.col("k") <= GROUP_PIECES)
        .select("m", "p", "place", "d1", "d2", "at", "piece")
        .repartition("m")
        .sortWithinPartitions("m")
        .mapInArrow(_compare_groups(length), f"m long, p long, again {_RANGES}, earlier {_RANGES}")
    )
    found = compared.unionByName(_by_string(texts.where(F.col("k") > GROUP_PIECES), length, keep_first))
    judged = cut(
        distinct.join(found, ["m", "p"], "left")
        .where("c > 1 or size(again) > 0")
        .select("m", "p", F.col("c") > 1, "first", "n", "again", "earlier")
        .toDF("m", "p", "often", "first", "n", "again", "earlier")
        .drop("n")
    )
    drop_cut(texts, distinct)
    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("size").alias("b")))
    none = F.array().cast(_RANGES)
    is_first = F.col("first") == F.struct("place", "d1", "d2", "at")
    ranges = (
        F.when(F.col("often") & ~is_first, whole).otherwise(F.coalesce("earlier", none))
        if keep_first
        else F.when(F.col("often"), whole).otherwise(F.coalesce("again", none))
    )
    hits = (
        candidates.select("m", "p", "place", "d1", "d2", "at", F.col("n").alias("size"))
        .join(judged.select("m", "p", "often", "first", "again", "earlier"), ["m", "p"])
        .select("d1", "d2", F.transform(ranges, lambda r: F.struct((F.col("at") + r["a"]).alias("a"), (F.col("at") + r["b"] + (length - 1)).alias("b"))).alias("r"))
        .where(F.size("r") > 0)
    )
    return hits.groupBy("d1", "d2").agg(F.flatten(F.collect_list("r")).alias("ranges"))


def _by_string(texts: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """The same for very large groups: their pieces are cut into single strings, dealt by hash.

    Equal strings are counted with partial sums, so neither a minimiser nor a string gathers
    its rows in one task.
    """

    def strings(m, p, piece) -> dict[str, list]:
        cols: dict[str, list] = {c: [] for c in ("g", "q", "off", "w1", "w2")}
        for g, q, t in zip(m, p, piece, strict=True):
            view = memoryview(t)
            for off in range(len(t) - length + 1):
                w = xxhash.xxh3_128_intdigest(view[off : off + length])
                cols["g"].append(g)
                cols["q"].append(q)
                cols["off"].append(off)
                cols["w1"].append((w >> 64) - (1 << 63))
                cols["w2"].append((w & (2**64 - 1)) - (1 << 63))
        return cols

    types = {"g": "long", "q": "long", "off": "int", "w1": "long", "w2": "long"}
    place = ["place", "d1", "d2", "at"] if keep_first else []
    inputs = {"m": "m", "p": "p", "piece": "piece"}
    rows = cut(map_columns(texts, strings, inputs, types, keep=[]).withColumnsRenamed({"g": "m", "q": "p"}))
    if keep_first:
        rows = rows.join(texts.select("m", "p", *place), ["m", "p"])
    start = F.struct(*place, "m", "p", "off")
    firsts = [F.min(start).alias("first")] if keep_first else []
    again = rows.groupBy("w1", "w2").agg(F.count("*").alias("c"), *firsts).where("c > 1")
    late = F.col("first") < start if keep_first else F.lit(False)
    hits = rows.join(again, ["w1", "w2"]).select("m", "p", "off", late.alias("late"))

    def ranges(offsets: Column) -> Column:
        return F.transform(F.array_sort(offsets), lambda i: F.struct(i.alias("a"), (i + 1).alias("b")))

    return hits.groupBy("m", "p").agg(
        ranges(F.collect_list("off")).alias("again"),
        ranges(F.collect_list(F.when(F.col("late"), F.col("off")))).alias("earlier"),
    )


def merge_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(r) for r in out]


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    keep_first: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    with_text: bool = True,
) -> DataFrame:
    """Cut every byte out of a text that a repeated string of ``length`` bytes covers.

    Returns the columns ``keep`` (all, if None) with ``n_bytes``, ``n_removed``, ``n_spans``,
    ``spans`` (the removed byte ranges), ``kept_sha256`` and, if asked for, ``kept`` (the
    remaining bytes). Strings are judged on the input, within and across documents, never over
    the end of one. Null counts as empty; texts under ``length`` bytes stay whole; a repeated
    row repeats its strings, so its long texts go entirely (with ``keep_first``, rows that agree
    in id and text are one document and none is cut for the other's sake); columns of the same
    names are replaced; an empty table gives an empty result. With ``keep_first`` the string at
    the smallest id (hash of id and text where ids are not whole numbers), then place, stays.
    """
    new = ["n_bytes", "n_removed", "n_spans", "spans", "kept_sha256", "kept"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    whole = dict(docs.dtypes)[id_col] in ("tinyint", "smallint", "int", "bigint")
    d1, d2 = F.xxhash64(F.col(id_col), F.col(text_col)), F.xxhash64(F.lit(1), F.col(id_col), F.col(text_col))
    rows = docs.select(
        *(F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)),
        d1.alias("d1"),
        d2.alias("d2"),
        (F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)) if whole else d1).alias("o"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_bytes"),
    )
    spans = repeated_spans(rows.select("d1", "d2", "o", "_bytes"), length, keep_first)
    joined = rows.join(spans.hint("shuffle_hash"), ["d1", "d2"], "left")

    def carve(text, ranges) -> dict[str, list]:
        out: dict[str, list] = {c: [] for c in new}
        for t, r in zip(text, ranges, strict=True):
            t = t or b""
            merged = merge_ranges([(x["a"], x["b"]) for x in r or ()])
            left, at = [], 0
            for a, b in merged:
                left.append(t[at:a])
                at = b
            kept = b"".join([*left, t[at:]])
            out["n_bytes"].append(len(t))
            out["n_removed"].append(len(t) - len(kept))
            out["n_spans"].append(len(merged))
            out["spans"].append([{"a": a, "b": b} for a, b in merged])
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept)
        return out if with_text else {c: v for c, v in out.items() if c != "kept"}

    types = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "spans": _RANGES, "kept_sha256": "string"}
    if with_text:
        types["kept"] = "binary"
    carved = map_columns(
        joined, carve, {"text": "_bytes", "ranges": "ranges"}, types, keep=[f"_keep_{i}" for i in range(len(keep))]
    )
    return carved.withColumnsRenamed({f"_keep_{i}": c for i, c in enumerate(keep)})


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), s AS (
  SELECT r, i, hash(substr(h, 2 * i + 1, {2 * LENGTH})) AS k
  FROM d, LATERAL unnest(range(length(h) // 2 - {LENGTH - 1})) AS u(i)
), again AS (
  SELECT r, i FROM s WHERE k IN (SELECT k FROM s GROUP BY k HAVING count(*) > 1)
), marked AS (
  SELECT *, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i) > {LENGTH}, TRUE)::INTEGER AS starts FROM again
), spans AS (
  SELECT r, min(i) AS a, max(i) + {LENGTH} AS b FROM (SELECT *, sum(starts) OVER (PARTITION BY r ORDER BY i) AS g FROM marked) GROUP BY r, g
), edges AS (
  SELECT r, list(a ORDER BY a) AS froms, list(b ORDER BY a) AS tos FROM spans GROUP BY r
), kept AS (
  SELECT doc_id, h, length(h) // 2 AS n, coalesce(froms, []) AS froms, coalesce(tos, []) AS tos FROM d LEFT JOIN edges USING (r)
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(list_sum([tos[i] - froms[i] for i in range(1, len(froms) + 1)]), 0)::BIGINT AS n_removed,
  len(froms)::BIGINT AS n_spans,
  sha256(unhex(array_to_string([substr(h, 2 * (CASE WHEN i = 0 THEN 0 ELSE tos[i] END) + 1,
    2 * ((CASE WHEN i = len(froms) THEN n ELSE froms[i + 1] END) - (CASE WHEN i = 0 THEN 0 ELSE tos[i] END))::BIGINT)
    for i in range(len(froms) + 1)], ''))) AS kept_sha256
FROM kept
"""
