"""N-gram Jaccard self-join by chosen paths.

A text is its set of five-word shingles. As in the published join, sets are first embedded in
sets of one size: 128 tokens, each the least shingle under a hash order of its own, of which two
sets share as large a part as their similarity. Each run of the join grows a tree of buckets: a
bucket samples one or two of these tokens and splits its sets by them, so that similar sets keep
meeting. Buckets that are small are compared
outright, large ones are split further, and what still does not part is compared block against
block. As many runs are made as the target recall takes at the last depth.

Sets that meet and look alike form candidate clusters. Within a cluster all pairs are verified
exactly on whole shingle sets, so a link that no bucket showed is still found there.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import cut, drop_cut, map_columns, slices, unused

WORDS, THRESHOLD, TARGET_RECALL = 5, 0.8, 0.9999
PLACES = 128
DEPTH, DEEPER, MAX_DEPTH = 2, 2, 6
#: Sets that are compared outright in a bucket; sets, and bytes of them, in a block of a verified
#: cluster.
BUCKET_ROWS, CLUSTER_ROWS, CLUSTER_BYTES = 256, 512, 4 << 20
#: Rows of keys, and of sets, in one written file of an intermediate table, if that gives enough files.
FILE_KEYS, FILE_SETS, LEAST_FILES = 1 << 20, 1 << 14, 32
#: Standard deviations below the threshold at which signatures still count as alike.
MARGIN = 5.0
_WORD = re.compile(r"\w+")
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


with np.errstate(over="ignore"):
    _MULTIPLIERS = _mix(np.arange(1, PLACES + 1, dtype=np.uint64) * _STEP) | _U(1)


class Shingler:
    """Texts to sorted arrays of distinct 64-bit shingle hashes."""

    def __init__(self, size: int = WORDS, most_cached: int = 100_000):
        self.size, self.most = size, most_cached
        self.cache: dict[str, int] = {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = _WORD.findall((text or b"").decode("utf-8", "replace").lower())
        if not words:
            return np.zeros(0, np.uint64)
        cache, codes = self.cache, []
        for w in words:
            c = cache.get(w)
            if c is None:
                if len(cache) >= self.most:
                    cache.clear()
                c = cache[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "replace"))
            codes.append(c)
        a = np.array(codes, np.uint64)
        size = min(self.size, len(a))
        with np.errstate(over="ignore"):
            h = np.zeros(len(a) - size + 1, np.uint64)
            for k in range(size):
                h = _mix(h * _STEP + a[k : k + len(h)])
        return np.unique(h)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Min-hash values of a set, 16 bits for each place."""
    least = np.full(PLACES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 2048):
            part = shingles[at : at + 2048]
            least = np.minimum(least, (part[:, None] * _MULTIPLIERS).min(axis=0))
        return (_mix(least) >> _U(48)).astype(np.uint16)


def survival(similarity: float, depth: int, threshold: float = THRESHOLD) -> float:
    """Chance that two sets share a path of some depth in one run."""
    two, alive = 1 / threshold - 1, 1.0
    for _ in range(depth):
        miss = 1 - similarity * alive
        alive = 1 - (1 - two) * miss - two * miss * miss
    return alive


def missed(runs: int, threshold: float = THRESHOLD, depth: int = DEPTH) -> float:
    """Chance that two sets at the threshold share no path of some depth in any run, averaged
    over the number of signature places in which they agree."""
    total = 0.0
    for k in range(PLACES + 1):
        odds = math.comb(PLACES, k) * threshold**k * (1 - threshold) ** (PLACES - k)
        total += odds * (1 - survival(k / PLACES, depth, threshold)) ** runs
    return total


def runs_for(recall: float, threshold: float = THRESHOLD, depth: int = DEPTH) -> int:
    if not recall < 1:
        raise ValueError("recall must be below 1")
    runs = 1
    while missed(runs, threshold, depth) > 1 - recall:
        runs += 1
    return runs


def grow(paths: np.ndarray, signatures: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """One level deeper: (row, path) of the children. A bucket samples one place, or two with
    the chance that makes 1/threshold on average; the sample depends on the path alone."""
    rows = np.arange(len(paths))
    with np.errstate(over="ignore"):
        draw = _mix(paths + _STEP)
        second = (draw >> _U(11)).astype(np.float64) / float(1 << 53) < 1 / threshold - 1
        out = []
        for picked, salt in ((rows, _U(1)), (rows[second], _U(2))):
            own = paths[picked]
            first_place = (_mix(own * _STEP + _U(1)) % _U(PLACES)).astype(np.int64)
            place = first_place
            if salt == 2:
                place = (first_place + 1 + (_mix(own * _STEP + salt) % _U(PLACES - 1)).astype(np.int64)) % PLACES
            value = signatures[picked, place].astype(np.uint64)
            out.append((picked, _mix(own ^ _mix((place.astype(np.uint64) << _U(16)) + value + salt))))
    return np.concatenate([r for r, _ in out]), np.concatenate([p for _, p in out])


def _pairs_in_groups(keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within runs of equal keys, in bounded lots."""
    edges = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
    end = np.repeat(edges[1:], np.diff(edges))
    i = np.arange(len(keys))
    d = 1
    while True:
        i = i[i + d < end[i]]
        if not len(i):
            return
        yield i, i + d
        d += 1


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index in the component of each of n points."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = np.minimum(label, label[label])
        if np.array_equal(before, label):
            break
    return label


def _whole_groups(columns: tuple[str, ...], keys: int, most_rows: int, handle, schema: pa.Schema):
    """Feed rows sorted by their first ``keys`` columns to ``handle``, groups kept whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in slices(batches):
            for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if len(held) >= most_rows and row[:keys] != held[-1][:keys]:
                    yield pa.RecordBatch.from_pydict(handle(held), schema=schema)
                    held = []
                held.append(row)
        if held:
            yield pa.RecordBatch.from_pydict(handle(held), schema=schema)

    return run


def _alike(threshold: float):
    """In each bucket, link sets that look alike to the first of their component.

    Where two blocks of a bucket meet, the components within each are told where that block meets
    itself; only what links one component to another is told here.
    """
    least = PLACES * threshold - MARGIN * math.sqrt(PLACES * threshold * (1 - threshold))

    def handle(rows: list[tuple]) -> dict[str, list]:
        # a group is named by a path and two blocks; blocks are compared across, or with themselves
        names = np.unique(np.array([r[:3] for r in rows], np.int64), axis=0, return_inverse=True)[1].ravel()
        order = np.argsort(names, kind="stable")
        names = names[order]
        alone = np.array([r[1] == r[2] for r in rows])[order]
        own = np.array([r[6] for r in rows], np.int64)[order]
        v = np.array([r[3] for r in rows], np.int64)[order]
        size = np.array([r[4] for r in rows], np.float64)[order]
        sig = np.frombuffer(b"".join(rows[i][5] for i in order), np.uint16).reshape(len(rows), PLACES)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j in _pairs_in_groups(names):
            fits = (np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j]) - 1e-9) & (v[i] != v[j])
            i, j = i[fits], j[fits]
            same = (sig[i] == sig[j]).sum(axis=1) >= least
            left.append(i[same])
            right.append(j[same])
        i, j, all_rows = np.concatenate(left), np.concatenate(right), np.arange(len(v))
        within = own[i] == own[j]
        root = _components(len(v), i[within], j[within])
        over = _components(len(v), root[i[~within]], root[j[~within]])
        told, across = np.flatnonzero(alone & (root != all_rows)), np.flatnonzero(over != all_rows)
        return {"a": v[np.concatenate([told, across])].tolist(), "b": v[np.concatenate([root[told], over[across]])].tolist()}

    columns = ("path", "b1", "b2", "v", "size", "sig", "own")
    return _whole_groups(columns, 3, 4096, handle, pa.schema([("a", pa.int64()), ("b", pa.int64())]))


def _few(df: DataFrame, rows: int, each: int) -> DataFrame:
    """Write a table in as many files as its rows ask for, not one for each shuffle partition.

    Only for the light work behind an exchange: it is then done by as many tasks.
    """
    return cut(df.coalesce(max(LEAST_FILES, -(-rows // each))))


def _blocked(members: DataFrame, sizes: DataFrame, key: str, blocks: Column) -> DataFrame:
    """Deal the members of each group to pairs of its ``blocks``: adds b1, b2.

    A group of one block is one pair (0, 0). Each row of a larger one meets every block, so a
    task holds two blocks at most, however large the group is.
    """
    blocks = F.greatest(F.lit(1), blocks).cast("int")
    own = F.pmod(F.xxhash64("v", F.lit(5)), F.col("_blocks")).cast("int")
    dealt = members.join(sizes, key).withColumn("_blocks", blocks).withColumn("_own", own)
    return dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select(
        *members.columns,
        F.least("_own", "_other").alias("b1"),
        F.greatest("_own", "_other").alias("b2"),
        "_blocks",
    )


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", vertices: int = 0) -> DataFrame:
    """(v, root) for every end of an edge; the root is the smallest id of the component.

    Alternates two rewritings until nothing changes: every vertex hands the smallest vertex it
    knows to its larger neighbours, then to its smaller ones. Only sums come to the driver. The
    tables of a round are written in as many files as their edges (at first, about ``vertices``)
    ask for: a round over few edges would else be spent on opening files.
    """
    now = _few(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("w")).where("u <> w").distinct(), vertices, FILE_KEYS
    )
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "w").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        few = lambda df, edges=state[0]: _few(df, edges, FILE_KEYS)
        both = now.unionByName(now.select(F.col("w").alias("u"), F.col("u").alias("w")))
        # minima are written first, so that the joins read plain exchanges and a hub can be split
        least = few(both.groupBy("u").agg(F.min("w").alias("m")).select("u", F.least("m", "u").alias("m")))
        large = both.join(least, "u").where("w > u").select(F.col("w").alias("u"), F.col("m").alias("w")).where("u <> w").distinct()
        large = few(large)
        low = few(large.groupBy("u").agg(F.min("w").alias("m")))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("w").alias("u"), F.col("m").alias("w")), F.struct("u", F.col("m").alias("w")))).alias("e"))
            .select("e.*")
            .where("u <> w")
            .distinct()
        )
        after = few(small)
        drop_cut(now, least, large, low)
        now = after
    roots = now.groupBy("u").agg(F.min("w").alias("root")).select(F.col("u").alias("v"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("v"), "root").distinct())


def _candidate_edges(sets: DataFrame, threshold: float, recall: float, n_sets: int = 0) -> DataFrame:
    """Pairs (a, b) of set ids that met in a bucket and look alike; a forest in each
    bucket, over all its blocks."""
    # any bucket may turn out large and be split to the last depth, where fewer pairs still meet
    runs = runs_for(recall, threshold, MAX_DEPTH)

    def plant(v, sig) -> dict[str, list]:
        s = np.frombuffer(b"".join(sig), np.uint16).reshape(len(v), PLACES)
        ids, out_v, out_p = np.array(v, np.int64), [], []
        for r in range(runs):
            rows = np.arange(len(v))
            with np.errstate(over="ignore"):
                paths = np.full(len(v), _mix(np.array([r + 1], np.uint64) * _STEP)[0])
            for _ in range(DEPTH):
                at, paths = grow(paths, s[rows], threshold)
                rows = rows[at]
            out_v.append(ids[rows])
            out_p.append(paths.view(np.int64))
        return {"u": np.concatenate(out_v).tolist(), "path": np.concatenate(out_p).tolist()}

    def deepen(v, path, sig) -> dict[str, list]:
        s = np.frombuffer(b"".join(sig), np.uint16).reshape(len(v), PLACES)
        rows, paths = np.arange(len(v)), np.array(path, np.int64).view(np.uint64)
        for _ in range(DEEPER):
            at, paths = grow(paths, s[rows], threshold)
            rows = rows[at]
        return {"u": np.array(v, np.int64)[rows].tolist(), "path": paths.view(np.int64).tolist()}

    types = {"u": "long", "path": "long"}
    level = map_columns(sets, plant, {"v": "v", "sig": "sig"}, types, keep=[]).withColumnRenamed("u", "v")
    dense = sets.select("v", "size", "sig")
    edges, depth = None, DEPTH
    paths = int(n_sets * runs / threshold**DEPTH)
    while True:
        level = _few(level.distinct(), paths, FILE_KEYS)
        sizes = _few(level.groupBy("path").agg(F.count("*").alias("n")).where("n > 1"), paths, FILE_KEYS)
        last = depth >= MAX_DEPTH
        ready = sizes if last else sizes.where(F.col("n") <= BUCKET_ROWS)
        met = _blocked(level, ready, "path", F.ceil(F.col("n") / BUCKET_ROWS)).join(dense, "v")
        found = (
            met.withColumn("own", F.pmod(F.xxhash64("v", F.lit(5)), F.col("_blocks")).cast("int"))
            .select("path", "b1", "b2", "v", "size", "sig", "own")
            .repartition("path", "b1", "b2")
            .sortWithinPartitions("path", "b1", "b2")
            .mapInArrow(_alike(threshold), "a long, b long")
            .distinct()
        )
        edges = found if edges is None else edges.unionByName(found)
        large = sizes.where(F.col("n") > BUCKET_ROWS).select("path")
        if last or large.isEmpty():
            return edges.distinct()
        level = map_columns(
            level.join(large, "path").join(dense, "v"), deepen, {"v": "v", "path": "path", "sig": "sig"}, types, keep=[]
        ).withColumnRenamed("u", "v")
        depth += DEEPER


def _verify(threshold: float):
    """Exact links between the sets of two blocks of a cluster."""
    t = Fraction(str(threshold))

    def handle(rows: list[tuple]) -> dict[str, list]:
        out: dict[str, list] = {"v": [], "links": [], "root": [], "alone": []}
        start = 0
        for end in range(1, len(rows) + 1):
            if end < len(rows) and rows[end][:3] == rows[start][:3]:
                continue
            group, start = rows[start:end], end
            sets = [np.frombuffer(r[6], np.uint64) for r in group]
            size = np.array([len(s) for s in sets], np.int32)
            inter = _intersections(sets)
            linked = np.int64(t.denominator + t.numerator) * inter >= np.int64(t.numerator) * (size[:, None] + size[None, :])
            np.fill_diagonal(linked, False)
            own = np.array([r[5] for r in group])
            if group[0][1] != group[0][2]:
                # what lies within one block is counted where that block meets itself
                linked &= own[:, None] != own[None, :]
            i, j = np.nonzero(np.triu(linked))
            root = _components(len(group), i, j)
            v = np.array([r[3] for r in group], np.int64)
            smallest = np.full(len(group), np.iinfo(np.int64).max)
            np.minimum.at(smallest, root, v)
            out["v"] += v.tolist()
            out["links"] += (linked @ np.array([r[4] for r in group], np.int64)).tolist()
            out["root"] += smallest[root].tolist()
            out["alone"] += [r[7] == 1 for r in group]
        return out

    columns = ("c", "b1", "b2", "v", "copies", "own", "shingles", "blocks")
    schema = pa.schema([("v", pa.int64()), ("links", pa.int64()), ("root", pa.int64()), ("alone", pa.bool_())])
    return _whole_groups(columns, 3, 256, handle, schema)


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    n = len(sets)
    out = np.zeros((n, n), np.int32)
    tokens, number = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.bincount(number, minlength=len(tokens)) > 1
    column = np.cumsum(often) - 1
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    row, number = row[often[number]], column[number[often[number]]]
    order = np.argsort(number, kind="stable")
    row, number = row[order], number[order]
    for first in range(0, int(often.sum()), 1024):
        a, b = np.searchsorted(number, (first, first + 1024))
        part = np.zeros((n, 1024), np.float32)
        part[row[a:b], number[a:b] - first] = 1
        out += np.rint(part @ part.T).astype(np.int32)
    return out


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    words: int = WORDS,
    recall: float = TARGET_RECALL,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The class, and the number of links, of every document.

    Two documents are linked if the Jaccard similarity of their sets of ``words``-word shingles
    is ``threshold`` or more (words: runs of word characters of the lower-cased text; a text of
    fewer words, but some, is one shingle). Classes are the connected components. Returns d1, d2 (a key of id and text), the
    id, ``class_id`` (the smallest id of the class, nulls last), ``n_links`` (other documents
    linked), ``n_copies`` (documents of the same shingle set, itself included) and ``is_first``
    (it has the smallest id, then key, of its class; rows that agree in id and text are first
    together).

    Texts without words, null or empty, are copies of each other and link to nothing else.
    Texts are read whole. Repeated rows are documents of their own and count as links. Equal
    sets are one vertex, so copies are never paired, and a link weighs as many documents as its
    vertex has. No group of any kind is gathered in one task: blocks meet in pairs.
    """
    key = [F.xxhash64(F.col(id_col), F.col(text_col)), F.xxhash64(F.lit(1), F.col(id_col), F.col(text_col))]

    kept: list[Shingler] = []  # one for each task, with what it remembers of words

    def shingler() -> Shingler:
        if not kept:
            kept.append(Shingler(words))
        return kept[0]

    def describe(text) -> dict[str, list]:
        shingle = shingler()
        out: dict[str, list] = {"v": [], "size": [], "sig": []}
        for t in text:
            s = shingle(t)
            out["v"].append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63))
            out["size"].append(len(s))
            out["sig"].append(signature(s).tobytes())
        return out

    rows = docs.select(F.col(id_col).alias("id"), key[0].alias("d1"), key[1].alias("d2"), F.col(text_col).alias("text"))
    described = cut(
        map_columns(
            rows, describe, {"text": "text"}, {"v": "long", "size": "int", "sig": "binary"}, keep=["id", "d1", "d2"]
        )
    )
    place = F.struct(F.col("id").isNull().alias("none"), "id", "d1", "d2")
    n_rows = described.count()
    sets = _few(
        described.groupBy("v").agg(
            F.count("*").alias("copies"), F.min(place).alias("place"), F.first("size").alias("size"), F.first("sig").alias("sig")
        ),
        n_rows,
        8 * FILE_SETS,
    )
    n_sets = sets.count()
    edges = _few(_candidate_edges(sets.where("size > 0").select("v", "size", "sig"), threshold, recall, n_sets), n_sets, FILE_KEYS)
    clusters = _few(connected_components(edges, vertices=n_sets), n_sets, FILE_KEYS)
    drop_cut(edges)

    held = sets.join(clusters, "v").select("v", "copies", "place.d1", "place.d2", F.col("root").alias("c"))
    wanted = held.groupBy("d1", "d2").agg(F.collect_list(F.struct("v", "copies", "c")).alias("w"))
    texts = rows.select("d1", "d2", "text").join(wanted, ["d1", "d2"]).select("text", F.explode("w").alias("w"))

    def shingles(text) -> dict[str, list]:
        shingle = shingler()
        return {"shingles": [shingle(t).tobytes() for t in text]}

    members = _few(
        map_columns(
            texts.select("text", "w.v", "w.copies", "w.c"), shingles, {"text": "text"}, {"shingles": "binary"}, keep=["v", "copies", "c"]
        ).dropDuplicates(["v"]),
        clusters.count(),
        FILE_SETS,
    )
    counts = members.groupBy("c").agg(F.count("*").alias("n"), F.sum(F.octet_length("shingles")).alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("n") / CLUSTER_ROWS), F.ceil(F.col("bytes") / CLUSTER_BYTES))
    blocked = _blocked(members, counts, "c", blocks).withColumn(
        "own", F.pmod(F.xxhash64("v", F.lit(5)), F.col("_blocks")).cast("int")
    )
    judged = cut(
        blocked.withColumn("blocks", F.col("_blocks"))
        .select("c", "b1", "b2", "v", "copies", "own", "shingles", "blocks")
        .repartition("c", "b1", "b2")
        .sortWithinPartitions("c", "b1", "b2")
        .mapInArrow(_verify(threshold), "v long, links long, root long, alone boolean")
    )
    drop_cut(members, clusters)
    links = judged.groupBy("v").agg(F.sum("links").alias("links"))
    apart = judged.where("not alone and root <> v").select(F.col("v").alias("a"), F.col("root").alias("b"))
    wide = connected_components(apart, vertices=n_sets)
    roots = judged.where("alone").select("v", "root").unionByName(wide)
    vertices = _few(
        sets.select("v", "copies", "place")
        .join(links, "v", "left")
        .join(roots, "v", "left")
        .select("v", "copies", "place", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "v").alias("root")),
        n_sets,
        FILE_KEYS,
    )
    drop_cut(sets, judged)
    classes = vertices.groupBy("root").agg(F.min("place").alias("first"))
    info = vertices.join(classes, "root").select("v", "copies", "links", "first")
    return described.select("id", "d1", "d2", "v").join(info, "v").select(
        "d1",
        "d2",
        F.col("id").alias(id_col),
        F.col("first.id").alias("class_id"),
        (F.col("copies") - 1 + F.col("links")).cast("long").alias("n_links"),
        F.col("copies").cast("long").alias("n_copies"),
        (F.col("first") == place).alias("is_first"),
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that are first of their class, all columns; one where rows repeat."""
    own = unused(docs.columns, "_near_")
    d1, d2, f1, f2 = (own + name for name in ("d1", "d2", "f1", "f2"))
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **how).where("is_first")
    firsts = found.select(F.col("d1").alias(f1), F.col("d2").alias(f2)).distinct()
    keyed = docs.withColumns(
        {d1: F.xxhash64(F.col(id_col), F.col(text_col)), d2: F.xxhash64(F.lit(1), F.col(id_col), F.col(text_col))}
    )
    kept = keyed.join(firsts, (F.col(d1) == F.col(f1)) & (F.col(d2) == F.col(f2)), "left_semi")
    return kept.dropDuplicates([d1, d2]).drop(d1, d2)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS g
  FROM w, LATERAL unnest(range(1, len(w) - least(5, len(w)) + 2)) AS u(i) WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y, k = nx.n AND k = ny.n AS same FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 9 * k >= 4 * (nx.n + ny.n)
  UNION ALL
  SELECT a.doc_id, b.doc_id, TRUE FROM w a, w b WHERE len(a.w) = 0 AND len(b.w) = 0 AND a.doc_id <> b.doc_id
), reach AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT doc_id, least(doc_id, coalesce((SELECT min(y) FROM reach WHERE x = doc_id), doc_id)) AS class_id,
  (SELECT count(*) FROM links WHERE x = doc_id)::BIGINT AS n_links,
  (1 + (SELECT count(*) FROM links WHERE x = doc_id AND same))::BIGINT AS n_copies
FROM w
"""
