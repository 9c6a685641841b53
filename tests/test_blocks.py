"""Blocks of thin pages: work that grows with the ink, not with the pages' height."""

import datetime as dt
import random

import duckdb
import numpy as np
import pytest
from oracle import compare

from vellum.operators import layout as L
from vellum.operators import raster as K
from vellum.plans import registry

START = dt.datetime(2024, 1, 1)


def events(spark, folder, rows):
    """Events of (user, time); returns what the query gives and what its SQL gives."""
    spark.createDataFrame([(i, t, u) for i, (u, t) in enumerate(rows)], "event_id long, ts timestamp_ntz, user_id long").repartition(3).write.parquet(
        f"{folder}/events.parquet"
    )
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{folder}/events.parquet/*.parquet'")
    df = registry.queries()["column_blocks"](spark, str(folder))
    want = con.execute(registry.oracle_sql()["column_blocks"]).fetchall()
    return df, sorted(map(tuple, df.collect())), sorted(want)


def at(hour, seconds=0):
    return START + dt.timedelta(hours=hour, seconds=seconds)


def most_rows(plan):
    """The most rows that any operator of an executed plan gave."""
    metric = plan.metrics().get("numOutputRows")
    inner = [plan.children().apply(i) for i in range(plan.children().size())]
    if plan.nodeName() == "AdaptiveSparkPlan":
        inner = [plan.executedPlan()]
    elif "QueryStage" in plan.nodeName():
        inner = [plan.plan()]
    return max([metric.get().value() if metric.isDefined() else 0, *map(most_rows, inner)])


def test_rows_grow_with_the_events_not_with_the_pages(spark, tmp_path):
    rows = [(u, at(17 * u % 744)) for u in range(1000)] * 5
    df, got, want = events(spark, tmp_path, rows)
    assert got == want and {r[0] for r in got} == set(range(1000))
    assert len(rows) <= most_rows(df._jdf.queryExecution().executedPlan()) <= 2 * len(rows)


def test_odd_events_equal_the_sql(spark, tmp_path):
    rng = random.Random(11)
    rows = [(1, at(h)) for h in (100, 200, 300) for _ in range(5)]
    rows += [(2, None), (None, at(5)), (None, None), (3, at(-1, 1)), (3, at(-2)), (3, at(744)), (3, at(9999))]
    rows += [(4, at(-1, 3599)) for _ in range(6)] + [(5, at(743, 3599.999999)) for _ in range(6)] + [(6, at(0)) for _ in range(6)]
    rows += [(7, at(h)) for h in (0, 1, 2, 3, 4, 60, 739, 740, 741, 742, 743) for _ in range(3)]
    # seven of 350 are no gap: exactly a fiftieth
    rows += [(8, at(h)) for h, n in ((50, 350), (120, 7), (200, 6), (300, 350)) for _ in range(n)]
    rows += [(u, at(rng.choice([rng.randrange(744), rng.randrange(40), 743 - rng.randrange(40)]))) for u in range(20, 60) for _ in range(rng.choice([1, 4, 9, 60, 300]))]
    _, got, want = events(spark, tmp_path, rows)
    assert got == want and {r[0] for r in want} == {*range(1, 9), *range(20, 60)}
    assert [r[2:] for r in want if r[0] == 8] == [(0, 53), (118, 744)]


@pytest.mark.parametrize("size", [5, 6, 20])
def test_steps_are_the_moving_sum(spark, size):
    rng = random.Random(size)
    for height in (size, size + 1, 60):
        pages = {k: [rng.choice([0, 1, 5, height - 1, height - 2, rng.randrange(height)]) for _ in range(rng.randint(1, 9))] for k in range(12)}
        pages[99] = [-1, height]
        ink = spark.createDataFrame([(k, p) for k, ps in pages.items() for p in ps if p < height or k == 99], "k int, pos int")
        got = {k: np.zeros(height) for k in pages}
        for r in L.smoothed_steps(ink, ["k"], "pos", height, size).collect():
            got[r["k"]][r["run_start"] : r["run_end"]] += r["total"]
        for k, ps in pages.items():
            profile = np.bincount([p for p in ps if 0 <= p < height], minlength=height)
            assert np.allclose(got[k], K.moving_mean(profile, size) * size), (k, height)


def test_low_pages_are_one_block(spark):
    ink = spark.createDataFrame([(1, 3), (2, None), (2, 28)], "k int, pos int")
    got = {r["k"]: [tuple(b) for b in r["blocks"]] for r in L.blocks_in_columns(ink, ["k"], "pos", 29).collect()}
    assert got == {1: [(0, 29)], 2: [(0, 29)]}


def test_the_given_tables_equal_the_sql(spark):
    rows, differences = compare(spark, "column_blocks", "/root/testdata/sf0.01")
    assert rows and not differences
