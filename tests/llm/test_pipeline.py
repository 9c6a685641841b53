import pathlib
import zlib

import corpus_pipeline
import pytest
from vellum.llm import mixing, nearjoin

from test_decontam import words
from test_nearjoin import brute

SF = "/root/testdata/sf0.01"


def windows(text):
    w = words(text)
    n = min(8, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(400)
    columns = docs.columns
    good = corpus_pipeline.keep_good(spark, docs, SF)
    assert good.columns == columns and 0 < good.count() < docs.count()
    single = corpus_pipeline.keep_one_of_each(spark, good, SF)
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    assert single.columns == columns
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({c for _, c, _ in brute(rows)})
    clean = corpus_pipeline.drop_leaks(spark, single, SF)
    # plain search, window by window
    tests = [r["text"].lower() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: r["text"].lower() for r in single.collect()}
    planted = {d for d, t in texts.items() if any(item in t for item in tests)}
    left = {r["doc_id"] for r in clean.collect()}
    assert clean.columns == columns and planted and not planted & left
    held = set().union(*map(windows, tests))
    short = {len(w) for w in held}

    def hit(text):
        w = words(text)
        return any(tuple(w[i : i + n]) in held for n in short for i in range(len(w) - n + 1))

    assert left == {r["doc_id"] for r in single.collect() if not hit(r["text"])}
    mixed = corpus_pipeline.mix_sources(spark, clean, SF)
    assert mixed.columns == columns
    last = corpus_pipeline.shard(spark, mixed, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    assert len(last) == mixed.count()
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in last)


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, quality_score string, quality_keep string, items string, spans string, n_hit string, _row string, _mix_row string, class_id string, _d1 string, size string"


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_every_stage_keeps_clashing_columns_and_bears_odd_rows(spark, name, stage):
    long = " ".join(f"w{i * 7919 % 5003}" for i in range(60_000))
    mine = tuple(f"mine{i}" for i in range(10))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, long, "en", "s", 5), (4, "a few plain words of a text", "en", None, 27), (4, "a few plain words of a text", "en", None, 27), (None, "without an id", "en", "s", 13)]
    docs = spark.createDataFrame([r + mine for r in rows], CLASHING).repartition(3)
    got = stage(spark, docs, SF)
    assert got.columns == docs.columns
    found = [tuple(r) for r in got.collect()]
    assert found and all(r[5:] == mine for r in found)
    assert {r[:5] for r in found} <= set(rows)
    assert stage(spark, docs.limit(0), SF).collect() == []


def test_an_empty_table_passes_all_stages(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_only_the_last_result_is_left(spark):
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir")) / "vellum"
    before = set(shared.iterdir()) if shared.exists() else set()
    left = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert left.count() > 0 and len(set(shared.iterdir()) - before) == 1


def test_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "sharding",
    ]
    assert mixing.MAX_COPIES == 3 and nearjoin.WORDS == 5 and nearjoin.THRESHOLD == 0.8
