import random
import re

import pytest
from pyspark.sql import functions as F

from vellum.llm import mixing


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def docs(seed, n=400):
    rng = random.Random(seed)
    rows = [(d, " ".join(["w"] * rng.choice([1, 5, 40, 300])), rng.choice(["a", "a", "a", "b", "c", "Z", "é", None])) for d in range(n)]
    rows += [(900, None, "a"), (901, "", "b"), (902, " \n\t", "c"), (903, "x y\x1cz", "c"), (904, "w " * 200, "tiny")]
    return rows + [rows[0]] * 150


def frame(spark, rows):
    return spark.createDataFrame([(*r, 3, 4) for r in rows], "doc_id long, text string, source string, taken int, copies int").repartition(4)


def test_word_count(spark):
    rows = [r for r in docs(1) if r[0] >= 900] + [(1, "a b\x0bc", "x")]
    got = {r["doc_id"]: r["n"] for r in frame(spark, rows).select("doc_id", mixing.word_count("text").alias("n")).collect()}
    assert got == {r[0]: size(r[1]) for r in rows}


def test_targets():
    sizes = {"sa": 100, "sb": 10_000, "sc": 900}
    got = mixing.targets(sizes, mixing.weights_in_order(list(sizes)))
    assert got["sa"] == 300 and abs(sum(got.values()) - 11_000) < 1e-6
    assert got["sb"] / got["sc"] == pytest.approx(2) or got["sc"] == 2700
    assert mixing.weights_in_order(["n", "sb", "sé", "sa", "sZ"]) == {"sZ": 5, "sa": 2, "sb": 1, "sé": 5, "n": 2}
    assert mixing.targets({"sa": 0}, {"sa": 5}) == {"sa": 0}
    assert mixing.targets({}, {}) == {}


def test_mix_meets_its_targets_and_reruns_agree(spark):
    rows = docs(2)
    df = frame(spark, rows)
    got = mixing.plan_mix(df, F.array("source")).collect()
    assert sorted((r["doc_id"], r["size"]) for r in got) == sorted((d, size(t)) for d, t, _ in rows)
    again = mixing.plan_mix(df.repartition(7), F.array("source")).collect()
    key = lambda rs: sorted((r["doc_id"], r["taken"]) for r in rs if r["doc_id"] != rows[0][0])
    assert key(got) == key(again)
    taken, target, most = {}, {}, {}
    for r in got:
        s = r["sources"][0]
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s], most[s] = r["target"], max(most.get(s, 0), r["size"])
        assert r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
    for s in taken:
        # whole documents of up to 300 words cannot meet every target of some thousand
        assert abs(taken[s] - target[s]) <= 0.01 * target[s] + most[s] / 2
    assert target["stiny"] == 600 and taken["stiny"] == 600


def test_ties_and_long_edges_are_cut_digit_by_digit(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ORDERED_ROWS", 3)
    rows = [(1, "w w w w", "a")] * 500 + [(2, "w " * 4000, "b")] * 2
    got = mixing.plan_mix(frame(spark, rows), F.array("source")).collect()
    taken = {s: sum(r["taken"] for r in got if r["sources"][0] == s) for s in ("sa", "sb")}
    target = {r["sources"][0]: r["target"] for r in got}
    assert abs(taken["sa"] - target["sa"]) <= 8


def test_overlapping_sources_flow_to_both_quotas():
    flow = mixing.route({("sa",): 100, ("sa", "sb"): 50, ("sb",): 10}, {"sa": 120, "sb": 60})
    assert sum(flow.values()) == 180
    # all first copies and twenty second ones, which cost 1 a word; no third one
    assert all(flow[p] >= c for p, c in ((("sa",), 100), (("sa", "sb"), 50), (("sb",), 10)))
    assert cost_of(flow, {("sa",): 100, ("sa", "sb"): 50, ("sb",): 10}) == 20
    assert mixing.route({("sa",): 10}, {"sa": 100})[("sa",)] == 30


def test_mix_repeats_rows(spark):
    rows = docs(3, 60)
    df = frame(spark, rows)
    mixed = mixing.mix(df, F.array("source"))
    assert mixed.columns == df.columns
    counts = {}
    for r in mixed.collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    plan = {}
    for r in mixing.plan_mix(df, F.array("source")).collect():
        plan[r["doc_id"]] = plan.get(r["doc_id"], 0) + r["copies"]
    assert counts == {d: n for d, n in plan.items() if n}


def test_nothing_and_rows_without_sources(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.plan_mix(empty, F.array("source")).collect() == []
    got = mixing.plan_mix(frame(spark, [(1, "a b", "x"), (2, "c", "y")]), F.array().cast("array<string>")).collect()
    assert [r["copies"] for r in got] == [0, 0]


def test_too_many_patterns_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_PATTERNS", 2)
    with pytest.raises(ValueError):
        mixing.plan_mix(frame(spark, [(i, "w", str(i)) for i in range(3)]), F.array("source"))


def cheapest(capacity, quota, copies=3):
    """(most words, least cost) over all whole-number flows, by trying them."""
    patterns = sorted(capacity)
    best = (0, 0)

    def walk(i, left, words, cost):
        nonlocal best
        if i == len(patterns):
            best = max(best, (words, -cost))
            return
        p = patterns[i]

        def split(j, room, given, rest):
            if j == len(p):
                each, cost_p = given, 0
                for r in range(copies):
                    n = min(capacity[p], each)
                    cost_p, each = cost_p + n * r * (r + 1) // 2, each - n
                walk(i + 1, rest, words + given, cost + cost_p)
                return
            for n in range(min(room, rest[p[j]]) + 1):
                split(j + 1, room - n, given + n, {**rest, p[j]: rest[p[j]] - n})

        split(0, copies * capacity[p], 0, left)

    walk(0, dict(quota), 0, 0)
    return best[0], -best[1]


def cost_of(flow, capacity, copies=3):
    total = 0
    for p, words in flow.items():
        for r in range(copies):
            n = min(capacity[p], words)
            total, words = total + n * r * (r + 1) // 2, words - n
    return total


@pytest.mark.parametrize("seed", range(25))
def test_the_flow_is_a_cheapest_of_the_largest(seed):
    rng = random.Random(seed)
    names = ["sa", "sb", "sc"][: rng.randint(1, 3)]
    patterns = {tuple(sorted(rng.sample(names, rng.randint(1, len(names))))) for _ in range(3)}
    capacity = {p: rng.randint(0, 3) for p in patterns}
    quota = {s: rng.randint(0, 6) for s in names}
    flow = mixing.route(capacity, quota)
    assert (sum(flow.values()), cost_of(flow, capacity)) == cheapest(capacity, quota)


def test_the_plan_equals_a_brute_force_of_its_sums(spark):
    rows = [(i, "w " * (1 + i % 7), "abcd"[i % 4] if i % 9 else None) for i in range(300)]
    got = mixing.plan_mix(frame(spark, rows), F.array("source")).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) > 3 * sizes[s]]
        if not over:
            break
        fixed |= {s: 3 * sizes[s] for s in over}
    want = fixed | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    named = {r[0]: r[2] for r in rows}
    taken = {}
    for r in got:
        s = named[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        taken[s] = taken.get(s, 0) + r["taken"]
    assert all(abs(taken[s] - want[s]) <= 7 for s in want)


def test_separators_in_sources_and_clashing_columns(spark):
    rows = [(1, "a b", "a\x1fb", "x", 1), (2, "c d", "c", "y", 2), (3, "e f", "\x1e1", "z", 3), (4, "g", "a", "z", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _mix_row string, _pattern int")
    got = mixing.plan_mix(df, F.array("source")).collect()
    assert {r["sources"][0] for r in got} == {"sa\x1fb", "sc", "s\x1e1", "sa"}
    assert all(r["source_size"] == r["size"] for r in got) and all(r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.mix(df, F.array("source")).columns == df.columns


def test_a_very_long_text(spark):
    rows = [(1, "w " * 300_000, "a"), (2, "w " * 10, "a"), (3, "w " * 5, "b")]
    got = {r["doc_id"]: r["size"] for r in mixing.plan_mix(frame(spark, rows), F.array("source")).collect()}
    assert got == {1: 300_000, 2: 10, 3: 5}
