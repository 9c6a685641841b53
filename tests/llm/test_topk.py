import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vellum.llm import topk


def brute(rows, k=20, every=20):
    """For each query row: its id and its k best (id, score), sorted."""
    ints = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints.append((i, [math.floor(64 * float(np.float32(x))) for x in v]))
    out = []
    for at, (q, v) in enumerate(ints):
        if q % every == 0:
            found = [(-sum(a * b for a, b in zip(v, w)), i) for n, (i, w) in enumerate(ints) if n != at and len(w) == len(v)]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, v, 1, "a", 2) for i, v in rows], "vec_id long, embedding array<float>, label int, row string, bar int").repartition(5)
    return sorted(tuple(r) for r in topk.top_k(df, **how).collect())


def vectors(n, seed=1, ties=False):
    rng = random.Random(seed)
    value = (lambda: rng.choice([-1.0, 0.0, 0.5])) if ties else (lambda: rng.gauss(0, 0.13))
    return [(i, [value() for _ in range(16)]) for i in range(n)]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 150)
    monkeypatch.setattr(topk, "LOT_ROWS", 10)
    rows = vectors(700)
    assert run(spark, rows) == brute(rows)


def test_ties_go_to_the_smaller_id(spark):
    rows = vectors(400, ties=True)
    assert run(spark, rows) == brute(rows)


def test_unusable_vectors_and_few_rows(spark):
    rows = [(0, [1.0] * 4), (20, None), (1, [float("nan")] * 4), (2, [None, 1.0, 1.0, 1.0]), (3, [float("inf")] * 4), (None, [1.0] * 4), (4, [2.0] * 4), (5, [1.0] * 3), (40, [])]
    assert run(spark, rows) == [(0, 1, 4, 4 * 64 * 128)]
    assert run(spark, []) == []
    assert run(spark, [(0, []), (1, [])]) == [(0, 1, 1, 0)]


def test_repeated_rows_are_candidates_and_queries_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 60)
    rows = vectors(120) + vectors(120)[:50] + [(0, [0.5] * 16), (20, None), (7, [0.25] * 16)]
    got = run(spark, rows)
    assert got == brute(rows)
    # a row with a query's id and vector is a candidate; the query's own row is not
    assert sum(q == 0 and v == 0 for q, _, v, _ in got) > 0


def test_scores_beyond_float_precision(spark):
    rows = [(0, [3e6, 1.0]), (1, [3e6, 1.0]), (2, [3e6, 1.1]), (3, [-3e6, 5.0])]
    assert run(spark, rows) == brute(rows)
    wide = [(i, [float((i * 7919) % 1000) * 2e3 + i, float(i)]) for i in range(130)]
    assert run(spark, wide) == brute(wide)


def integers(sf):
    table = pq.read_table(f"/root/testdata/{sf}/embeddings.parquet")
    x = np.floor(64 * np.array(table.column("embedding").to_pylist(), float)).astype(np.int64)
    return x, table.column("vec_id").to_numpy()


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_bounds_settle_every_query_before_the_lists_end(sf):
    x, ids = integers(sf)
    asked, told = np.flatnonzero(ids % 20 == 0), []
    rows = np.arange(len(x))
    at, which, score = topk.nra_block(x, rows, ids, x[asked], asked, 20, told=told)
    assert len(told) == len(asked)
    assert all(depth < 1 for _, depth, _ in told)
    assert all(n <= max(160, len(x) / 8) for _, _, n in told)
    for a in range(len(asked)):
        want = sorted((-int(s), int(i)) for s, i, r in zip(x @ x[asked[a]], ids, rows) if r != asked[a])[:20]
        assert [(-int(s), int(ids[w])) for b, w, s in zip(at, which, score) if b == a] == want


def test_a_bar_from_elsewhere_stops_reading_sooner_and_drops_what_is_below():
    x, ids = integers("sf0.1")
    rows, q = np.arange(len(x)), x[:40]
    free, barred = [], []
    whole = topk.nra_block(x, rows, ids, q, rows[:40], 20, told=free)
    bars = np.array([whole[2][whole[0] == a][4] for a in range(40)])
    few = topk.nra_block(x, rows, ids, q, rows[:40], 20, bars, told=barred)
    assert sum(d for _, d, _ in barred) < sum(d for _, d, _ in free)
    for a in range(40):
        assert few[2][few[0] == a].tolist() == [s for s in whole[2][whole[0] == a].tolist() if s >= bars[a]]


@given(st.integers(0, 10**6), st.floats(0.05, 1))
@settings(max_examples=60, deadline=None)
def test_bounds_hold_at_every_depth(seed, depth):
    rng = np.random.default_rng(seed)
    x, q = (rng.integers(-9, 9, (n, 6)) * rng.integers(0, 3, (n, 1)) for n in (50, 5))
    lower, upper = topk.Lists(x, np.float32).bounds(q.astype(np.float32), depth)
    assert (lower <= q @ x.T + 1e-6).all() and (q @ x.T <= upper).all()
