"""Texts are cut into chunks once, and little of a batch is held as Python objects."""

import pyarrow as pa
import pytest

from vellum.operators import chunks as C
from vellum.plans import registry

SF = "/root/testdata/sf0.001"
CUTTING = {"chunk_roundtrip": 1, "chunk_paragraphs": 1, "chunk_lines": 1, "chunk_chars": 1, "llm_passthrough": 2}


@pytest.mark.parametrize("name", CUTTING)
def test_texts_are_cut_once(spark, name):
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == CUTTING[name]
    assert not any(x in plan for x in ("ArrowEvalPython", "MapInPandas", "pythonUDF"))


def test_slices_are_bounded_in_bytes_and_whole():
    texts = ["x" * n for n in (10, 0, 5000, 300, 300, 300, 1, 2000)] + [None, "é" * 400]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["i", "t"])
    parts = list(C.slices(batch, "t", 1000))
    assert len(parts) > 3 and [r for p in parts for r in p.column("i").to_pylist()] == list(range(len(texts)))
    for p in parts:
        held = [t for t in p.column("t").to_pylist() if t]
        assert sum(len(t.encode()) for t in held) <= 1000 or p.num_rows == 1
    assert list(C.slices(batch.slice(0, 0), "t")) == []
    assert [p.num_rows for p in C.slices(batch.slice(3, 4), "t", 1 << 20)] == [4]


def test_columns_nulls_and_short_texts(spark):
    rows = [(1, ["a"], None), (2, None, ""), (3, ["b", None], "ab"), (4, [], "abcdef. gh\nij")]
    df = spark.createDataFrame(rows, "`row idx` long, tags array<string>, text string")
    got = sorted(tuple(r) for r in C.explode_chunks(df, limit=5).collect())
    want = [(k, t, i, s, c) for k, t, x in rows if x is not None for i, (s, c) in enumerate(C.chunk_text(x, 5))]
    assert got == sorted(want) and {r[0] for r in got} == {2, 3, 4}


def test_replies_in_many_slices(spark, monkeypatch):
    monkeypatch.setattr(C.slices, "__defaults__", (300,))
    df = spark.createDataFrame([(i, f" text {i} ") for i in range(500)], "row_idx long, chunk string").coalesce(1)
    got = C.map_chunks(df, lambda: lambda c: None if c.endswith("3 ") else c.upper(), threads=3).collect()
    assert {r["row_idx"]: (r["chunk"], r["error"]) for r in got} == {
        i: (f" text {i} " if str(i).endswith("3") else f" TEXT {i} ", None) for i in range(500)
    }
