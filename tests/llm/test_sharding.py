import zlib

import pytest
from pyspark.sql import functions as F

from vellum.llm import sharding

M = 2862933555777941757


def jump(key, n):
    key &= 2**64 - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * M + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


KEYS = [0, 1, 2, 3, 41, -1, -7, 2**63 - 1, -(2**63), 123456789012345, *range(1000, 1100)]


@pytest.mark.parametrize("n", [1, 2, 7, 40, 1000])
def test_jump_hash_is_the_published_one(spark, n):
    df = spark.createDataFrame([(k,) for k in KEYS], "k long")
    got = {r["k"]: r["s"] for r in df.select("k", sharding.jump_hash(F.col("k"), n).alias("s")).collect()}
    assert got == {k: jump(k, n) for k in KEYS}


def test_rejects_no_shards(spark):
    with pytest.raises(ValueError):
        sharding.jump_hash(F.lit(1), 0)


def docs(spark):
    rows = [(i, f"text {i % 5} é", "x") for i in range(300)]
    rows += [(7, "text 2 é", "x")] * 40 + [(None, "no id", "x"), (None, None, "x"), (900, None, "x"), (901, "", "x"), (902, "long " * 50_000, "x")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(5)


def test_shards_slots_and_growth(spark):
    rows, df = docs(spark)
    got = sharding.shard_documents(df, 40).collect()
    assert len(got) == len(rows)
    by_shard = {}
    for r in got:
        assert r["law"] == "key" and 0 <= r["shard"] < 40
        assert r["shard"] == jump(r["doc_id"] or 0, 40)
        assert r["grown_shard"] in (r["shard"], 40) and r["grown_shard"] == jump(r["doc_id"] or 0, 41)
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    for slots in by_shard.values():
        assert sorted(slots) == list(range(len(slots)))
    sizes = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got)
    want = sorted((i is None, i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert sizes == want


def test_shards_of_nothing(spark):
    assert sharding.shard_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_shards_string_ids(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z")], "doc_id string, text string")
    assert sorted(r["slot"] for r in sharding.shard_documents(df, 1).collect()) == [0, 1, 2]


def test_clashing_columns_are_not_read(spark):
    df = spark.createDataFrame([(1, "x", "a", "b", 3), (1, "x", "a", "b", 3)], "doc_id long, text string, _part string, _at string, slot int")
    got = sharding.shard_documents(df, 3).collect()
    assert sorted(r["slot"] for r in got) == [0, 1] and {r["size"] for r in got} == {17}
