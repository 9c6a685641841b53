"""Sharding by jump consistent hashing, in DataFrame operations only.

A key walks through the buckets 0 .. n-1 in jumps drawn from a linear congruential generator
that the key seeds; the last bucket it lands in below n is its shard. No ring table is held,
and going from n to n+1 shards moves a key only if its walk lands on the new shard.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.common import cut, plain

# Fixed value: the generator's multiplier, as published with the algorithm.
MULTIPLIER = 2862933555777941757
_LOW, _HIGH = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32
_MASK32, _MASK16 = 0xFFFFFFFF, 0xFFFF


def _low32(c: Column) -> Column:
    return c.bitwiseAND(F.lit(_MASK32))


def _next_state(hi: Column, lo: Column) -> tuple[Column, Column]:
    """(hi, lo) * MULTIPLIER + 1 modulo 2**64, in 32-bit halves so that no product overflows."""
    a = lo.bitwiseAND(F.lit(_MASK16)) * F.lit(_LOW) + F.lit(1)
    b = F.shiftright(lo, 16) * F.lit(_LOW)
    low = a + F.shiftleft(b.bitwiseAND(F.lit(_MASK16)), 16)
    carry = F.shiftright(low, 32) + F.shiftright(b, 16)
    c = hi.bitwiseAND(F.lit(_MASK16)) * F.lit(_LOW)
    d = F.shiftleft((F.shiftright(hi, 16) * F.lit(_LOW)).bitwiseAND(F.lit(_MASK16)), 16)
    return _low32(carry + _low32(c) + d + _low32(lo * F.lit(_HIGH))), _low32(low)


def _walk(state: Column, n: int, steps: int) -> Column:
    """Up to ``steps`` more jumps of a state (b, j, hi, lo); a state with j >= n rests."""

    def jump(s: Column, _: Column) -> Column:
        hi, lo = _next_state(s["hi"], s["lo"])
        reach = (s["j"] + 1) * (F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + 1))
        moved = F.struct(
            s["j"].alias("b"), reach.cast("long").alias("j"), hi.alias("hi"), lo.alias("lo")
        )
        return F.when(s["j"] >= n, s).otherwise(moved)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, jump)


def jump_hash(key: Column, n: int) -> Column:
    """The shard, 0 .. n-1, of a 64-bit key.

    A walk takes about ln(n) jumps and never more than n. The common case is walked with few
    steps; what is still under way goes on for as long as it can take.
    """
    if n < 1:
        raise ValueError("a shard count is 1 or more")
    zero = F.lit(0).cast("long")
    start = F.struct(
        F.lit(-1).cast("long").alias("b"),
        zero.alias("j"),
        F.shiftrightunsigned(key, 32).alias("hi"),
        _low32(key).alias("lo"),
    )
    few = min(n, 4 * math.ceil(math.log(n + 1)) + 32)
    walked = _walk(start, n, few)
    if few == n:
        return walked["b"].cast("int")
    return F.when(walked["j"] >= n, walked["b"]).otherwise(_walk(walked, n, n - few)["b"]).cast("int")


def shard_key(df: DataFrame, id_col: str) -> Column:
    """Integers are their own key; other ids are hashed; a null id has key 0."""
    kind = dict(df.dtypes)[id_col]
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    return F.coalesce(F.col(id_col).cast("long") if whole else F.xxhash64(F.col(id_col)), F.lit(0).cast("long"))


def shard_documents(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal documents to shards under the law ``key``: id and shard count alone decide.

    Returns, for each row, the id, ``size`` (UTF-8 bytes of the text and 16), ``text_crc32``,
    ``law``, ``shard``, ``slot`` (0, 1, ... within the shard without a gap) and ``grown_shard``
    (the shard under one shard more: the same, or the new one).

    Null text counts as empty (size 16); a null id has key 0, so all such rows share a shard;
    repeated rows share a shard and get slots of their own; an empty table gives an empty
    result; other columns are ignored. The order of slots within a shard is that of the input's
    partitions. Slots are numbered per input partition and shard, and offset by the counts of
    the partitions before, so neither a shard nor a hot id is ever gathered in one task.
    """
    key = shard_key(docs, id_col)
    dealt = cut(
        docs.select(
            F.col(id_col),
            (F.octet_length(plain(text_col)) + 16).cast("long").alias("size"),
            F.crc32(plain(text_col).cast("binary")).alias("text_crc32"),
            jump_hash(key, n_shards).alias("shard"),
            jump_hash(key, n_shards + 1).alias("grown_shard"),
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().alias("_at"),
        )
    )
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("shard", "_part")
        .agg(F.count("*").alias("_n"))
        .select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy("shard", "_part").orderBy("_at")
    return (
        dealt.withColumn("_row", F.row_number().over(within) - 1)
        .join(offsets, ["shard", "_part"])
        .select(
            id_col,
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("_offset") + F.col("_row")).cast("long").alias("slot"),
            "grown_shard",
        )
    )


#: DuckDB SQL of the walk and of the CRC. A shard's slots follow the order of the table.
ORACLE = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)::BIGINT[]),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) AS r(i))
), d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), crc AS (
  SELECT r, doc_id, (strlen(text) + 16)::BIGINT AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT,
      [('0x' || substr(h, 2 * i + 1, 2))::BIGINT for i in range(strlen(text))]),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)::BIGINT AS text_crc32
  FROM (SELECT *, hex(encode(text)) AS h FROM d), crc_table
), walk AS (
  SELECT r, n, (-1)::BIGINT AS b, 0::BIGINT AS j, (CASE WHEN doc_id < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE coalesce(doc_id, 0)::HUGEINT END) AS k
  FROM d, (VALUES (40), (41)) AS c(n)
  UNION ALL
  SELECT r, n, j, floor((j + 1) * (2147483648.0::DOUBLE / ((m >> 33)::DOUBLE + 1)))::BIGINT, m
  FROM (SELECT *, (k * {MULTIPLIER} + 1) % 18446744073709551616::HUGEINT AS m FROM walk) WHERE j < n
), dealt AS (
  SELECT r, max(CASE WHEN n = 40 THEN b END)::INTEGER AS shard, max(CASE WHEN n = 41 THEN b END)::INTEGER AS grown_shard FROM walk GROUP BY r
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY r) - 1 AS slot, grown_shard
FROM crc JOIN dealt USING (r)
"""
