"""Exact top-k inner products by the no-random-access algorithm, block by block.

A block holds a share of the candidate vectors with one list for each component, sorted by that
component. Queries read all lists of a block in step, from the end that their sign of that
component favours. What has been read gives every candidate an upper bound (unread components at
the value where reading stands) and a lower bound (what the lengths of the unread parts allow, by
Cauchy and Schwarz). Reading stops for a query when the bounds leave few candidates that can
qualify: no outsider's upper bound reaches the k-th best lower bound, nor the k-th best score that
the query has from another block. The scores of those still in question are then resolved.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.common import cut

#: Candidates in a block, queries in a lot, and queries of a lot that read a block at once.
BLOCK_ROWS = 4096
LOT_ROWS = 8192
QUERY_ROWS = 256
#: Shares of the lists that have been read when bounds are compared; at 1 they are exact.
DEPTHS = (0.6, 0.7, 0.8, 0.9, 1.0)
#: A query stops reading when at most this share of a block can still qualify.
OPEN_SHARE = 1 / 8
_NO_BAR = -(1 << 63)


def integer_vector(embedding: Column, scale: int = 64) -> Column:
    """floor(scale * x) for each component x as double; null unless every component is finite."""
    doubles = embedding.cast("array<double>")
    usable = embedding.isNotNull() & F.forall(
        doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.when(usable, F.transform(doubles, lambda x: F.floor(x * scale).cast("long")))


def _exact_type(x: np.ndarray, q: np.ndarray):
    """A type in which every inner product of the two is exact."""
    most = float(np.abs(x.astype(float)).max(initial=0)) * float(np.abs(q.astype(float)).max(initial=0)) * x.shape[1]
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else object


class Lists:
    """The sorted lists of one block, one for each component."""

    def __init__(self, x: np.ndarray, kind):
        self.x = x.astype(kind)
        self.read = x.astype(np.float64 if kind is object else kind)
        self.lists = np.sort(self.read, axis=0)
        self.squares = self.read * self.read

    def bounds(self, q: np.ndarray, depth: float) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) score bounds, queries by candidates, with this share of each list read."""
        x, n = self.read, len(self.read)
        stand = max(1, int(np.ceil(n * depth)))
        up, down = self.lists[n - stand], self.lists[stand - 1]
        gain, loss = np.maximum(q, 0), np.minimum(q, 0)
        seen_up, seen_down = x >= up, x <= down
        known = gain @ np.where(seen_up, x, 0).T + loss @ np.where(seen_down, x, 0).T
        upper = gain @ np.where(seen_up, x, up).T + loss @ np.where(seen_down, x, down).T
        left_q = (gain * gain) @ (~seen_up).T.astype(x.dtype) + (loss * loss) @ (~seen_down).T.astype(x.dtype)
        left_x = (gain > 0).astype(x.dtype) @ np.where(seen_up, 0, self.squares).T
        left_x += (loss < 0).astype(x.dtype) @ np.where(seen_down, 0, self.squares).T
        # sums of squares may be rounded, so the reach is a little larger than they say
        reach = np.sqrt(left_q * left_x) * (1 + 1e-3)
        slack = 0.0
        if self.x.dtype == object:
            slack = 1e-9 * x.shape[1] * float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0))
        return known - reach - slack, upper + slack


def nra_block(x: np.ndarray, rows: np.ndarray, ids: np.ndarray, q: np.ndarray, q_rows: np.ndarray, k: int, bars=None, told: list | None = None):
    """The k best candidates of a block for each query: arrays (query, candidate, score).

    x, q: whole numbers (int64). ``rows`` and ``q_rows`` number the rows of the table, so that a
    query passes over its own; ``bars`` are scores that a candidate must reach. Ties go to the
    smaller id. ``told`` gets (query, depth read, candidates resolved) for each query.
    """
    n, kind = len(x), _exact_type(x, q)
    block, exact_q = Lists(x, kind), q.astype(kind)
    read_q = q.astype(np.float64) if kind is object else exact_q
    bars = np.full(len(q), _NO_BAR, np.int64) if bars is None else bars
    floor = np.where(bars == _NO_BAR, -np.inf, bars.astype(float))
    found: tuple[list, list, list] = ([], [], [])
    left = np.arange(len(q))
    for depth in DEPTHS if n > 4 * k else DEPTHS[-1:]:
        lower, upper = block.bounds(read_q[left], depth)
        bar = floor[left]
        if n > k:
            # the query's own row may be among the k best, so one more is held
            bar = np.maximum(bar, np.partition(lower, n - k - 1, axis=1)[:, n - k - 1])
        open_ = upper >= (bar - 1e-6 * np.abs(bar))[:, None]
        done = (open_.sum(axis=1) <= max(8 * k, n * OPEN_SHARE)) | (depth == 1.0)
        for at in np.flatnonzero(done):
            query = left[at]
            keep = np.flatnonzero(open_[at] & (rows != q_rows[query]))
            final = block.x[keep] @ exact_q[query]
            if kind is object:
                best = sorted(range(len(keep)), key=lambda i: (-final[i], ids[keep[i]]))[:k]
            else:
                best = np.lexsort((ids[keep], -final))[:k]
            best = [i for i in best if final[i] >= bars[query]]
            for out, values in zip(found, (np.full(len(best), query), keep[best], final[best].astype(np.int64))):
                out.append(values)
            if told is not None:
                told.append((int(query), depth, len(keep)))
        left = left[~done]
        if not len(left):
            break
    return tuple(np.concatenate(f).astype(np.int64) if f else np.zeros(0, np.int64) for f in found)


_FOUND = pa.schema([("q", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _meet(k: int):
    """Queries of a lot read the lists of a block."""

    def numbers(table: pa.Table) -> np.ndarray:
        v = table.column("v").combine_chunks()
        return v.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(table.num_rows, -1)

    def run(key: tuple, queries: pa.Table, block: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [np.zeros(0, np.int64)] for c in _FOUND.names}
        if queries.num_rows and block.num_rows:
            x, rows, ids = numbers(block), *(block.column(c).to_numpy() for c in ("row", "vec_id"))
            for start in range(0, queries.num_rows, QUERY_ROWS):
                part = queries.slice(start, QUERY_ROWS)
                q_rows, q_ids, bars = (part.column(c).to_numpy() for c in ("row", "vec_id", "bar"))
                at, which, score = nra_block(x, rows, ids, numbers(part), q_rows, k, bars)
                for name, values in zip(_FOUND.names, (q_rows[at], q_ids[at], ids[which], score)):
                    out[name].append(values)
        return pa.table({c: np.concatenate(v) for c, v in out.items()}, schema=_FOUND)

    return run


def top_k(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 64,
) -> DataFrame:
    """The k highest integer inner products of each query with every other vector.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but the
    query's own. Returns query_id, rank (from 1), vec_id and score; ties go to the smaller id;
    fewer rows where fewer exist. Vectors that are null or hold a null or non-finite component
    take no part, nor do rows with a null id; vectors of another length than the query's are
    not compared with it, and empty ones score 0. A repeated row is a candidate for each time it
    stands there, and a query of its own if its id is divisible. Other columns are ignored.

    Candidates are dealt to blocks and the stated queries to lots by hash. A query first reads the
    block that its own row lies in; its k-th best score there is the bar that the other blocks'
    candidates must reach. Every lot visits every block: a task holds one of each, however many
    there are.
    """
    ints = integer_vector(F.col(vector_col), scale)
    rows = cut(
        vectors.where(F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("vec_id"), ints.alias("v"))
        .where(F.col("v").isNotNull())
        .select(F.monotonically_increasing_id().alias("row"), "vec_id", F.size("v").alias("dims"), "v")
    )
    most, count, asking = rows.agg(
        F.max(F.array_max(F.transform("v", lambda x: F.greatest(x, -x)))), F.count("*"), F.count_if(F.col("vec_id") % every == 0)
    ).first()
    small = "smallint" if (most or 0) < 1 << 15 else "bigint"
    rows = rows.withColumn("v", F.col("v").cast(f"array<{small}>"))
    blocks, lots = max(1, -(-count // BLOCK_ROWS)), max(1, -(-asking // LOT_ROWS))
    number = lambda salt, n: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n))
    every_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    dealt = rows.withColumn("block", number(1, blocks)).withColumn("lot", every_of(lots))
    asked = rows.where(F.col("vec_id") % every == 0).withColumns({"lot": number(2, lots), "home": number(1, blocks)})

    def meet(queries: DataFrame, k: int) -> DataFrame:
        return (
            queries.select(*(F.col(c).alias(c) for c in ("block", "lot", "dims", "row", "vec_id", "bar", "v")))
            .groupBy("block", "lot", "dims")
            .cogroup(dealt.groupBy("block", "lot", "dims"))
            .applyInArrow(_meet(k), "q long, query_id long, vec_id long, score long")
        )

    near = meet(asked.withColumns({"block": F.col("home"), "bar": F.lit(_NO_BAR).cast("long")}), k)
    if blocks > 1:
        first = cut(near)
        bars = first.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("low"))
        bars = bars.select(F.col("q").alias("row"), F.when(F.col("n") >= k, F.col("low")).alias("low"))
        others = asked.join(bars, "row", "left").withColumn("bar", F.coalesce("low", F.lit(_NO_BAR).cast("long")))
        near = first.unionByName(meet(others.withColumn("block", every_of(blocks)).where("block <> home"), k))
    ranked = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


ORACLE = """
WITH ints AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [floor(64 * x::DOUBLE)::BIGINT for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r AS r, q.vec_id AS query_id, c.vec_id,
    CASE WHEN len(q.v) = 0 THEN 0 ELSE list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]) END::BIGINT AS score
  FROM ints q JOIN ints c ON q.vec_id % 20 = 0 AND q.r <> c.r AND len(q.v) = len(c.v)
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
