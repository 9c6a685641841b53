import random

import pytest

from vellum.llm import lines


def distance_at_most_one(a, b):
    if a == b:
        return True
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = (a, b) if len(a) > len(b) else (b, a)
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))




def rows_with_edits(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab cdé😀") for _ in range(rng.choice([1, 2, 3, 19, 20, 21, 40, 70, 300]))) for _ in range(25)]

    def edit(x):
        i, k = rng.randrange(max(1, len(x))), rng.random()
        return x[:i] + rng.choice("abz") + x[i + 1 :] if k < 0.4 else x[:i] + x[i + 1 :] if k < 0.7 else x[:i] + "z" + x[i:]

    rows = []
    for d in range(80):
        held = []
        for _ in range(4):
            x = rng.choice(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                x = edit(x)
            held.append(x)
        rows.append((d, "\n".join([*held, "", "  "])))
    return rows + [(500, None), (501, ""), (502, "\n\n"), (None, rows[0][1] + "\nonly here, in the row without an id")]


# a line that an earlier removed line matches still goes: the brute force keeps removed lines in view
def brute_on_input(rows, edits):
    same = distance_at_most_one if edits else lambda a, b: a == b
    seen, out = [], {}
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        keep = []
        for line in (t or "").split("\n"):
            if not line.strip() or not any(same(line, s) for s in seen):
                keep.append(line)
            if line.strip():
                seen.append(line)
        out[d] = None if t is None else "\n".join(keep)
    return out


@pytest.mark.parametrize("edits", [0, 1])
def test_equals_brute_force(spark, edits):
    rows = rows_with_edits(edits + 3)
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n_lines int").repartition(5)
    got = {r["doc_id"]: r["deduped"] for r in lines.dedup_lines(df, edits).collect()}
    assert got == brute_on_input(rows, edits)


def test_long_lines_and_the_shuffled_route(spark, monkeypatch):
    monkeypatch.setattr(lines, "BROADCAST_HASHES", 0)
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefgh ") for _ in range(20_000))
    rows = [(1, long), (2, long[:7000] + "Z" + long[7001:]), (3, long[:15_000] + long[15_001:]), (4, long[:100] + "QQ" + long[100:])]
    got = {r["doc_id"]: r for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["n_removed"] for i in (1, 2, 3, 4)] == [0, 1, 1, 0] and got[2]["n_near"] == 1


def test_repeated_rows_and_nothing(spark):
    df = spark.createDataFrame([(1, "the same line in both\nthe same line in both")] * 3, "doc_id long, text string")
    assert {(r["deduped"], r["n_removed"]) for r in lines.dedup_lines(df).collect()} == {("the same line in both", 1)}
    assert lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("seed", [1, 2])
def test_two_edits_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcé ") for _ in range(rng.choice([1, 2, 3, 4, 9, 14, 30]))) for _ in range(14)]

    def edit(x):
        i, k = rng.randrange(len(x) + 1), rng.random()
        return x[:i] + rng.choice("abz") + x[i + 1 :] if k < 0.4 else x[:i] + x[i + 1 :] if k < 0.7 else x[:i] + "z" + x[i:]

    rows, seen, want = [], [], {}
    for d in range(45):
        held = []
        for _ in range(3):
            x = rng.choice(base)
            for _ in range(rng.choice([0, 1, 2, 2, 3])):
                x = edit(x)
            held.append(x)
        rows.append((d, "\n".join(held)))
        keep, near = [], 0
        for x in held:
            matched = [distance(x, y) for y in seen if distance(x, y) <= 2] if x.strip() else []
            near += bool(matched) and matched[0] > 0
            keep += [] if matched else [x]
            seen += [x] if x.strip() else []
        want[d] = ("\n".join(keep), near)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["deduped"], r["n_near"]) for r in lines.dedup_lines(df, 2).collect()}
    assert got == want


def test_clashing_columns_and_short_lines(spark):
    rows = [(1, "ab\nx", "i", "t", 1), (2, "ac\ny\nlonger\nab", "i", "t", 2), (3, "abc", "i", "t", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id string, _text string, _hash int")
    near = lines.dedup_lines(df)
    assert near.columns[:5] == df.columns
    got = {r["doc_id"]: (r["deduped"], r["n_removed"], r["n_near"], r["_id"]) for r in near.collect()}
    assert got == {1: ("ab\nx", 0, 0, "i"), 2: ("longer", 3, 2, "i"), 3: ("", 1, 1, "i")}
    equal = {r["doc_id"]: r["deduped"] for r in lines.dedup_lines(df, min_near_chars=20).collect()}
    assert equal == {1: "ab\nx", 2: "ac\ny\nlonger", 3: "abc"}


def test_other_bounds_are_refused(spark):
    with pytest.raises(ValueError):
        lines.find_duplicate_lines(spark.createDataFrame([], "doc_id long, text string"), 3)


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a line that is long enough\nx")], "doc_id long, text string")
    plan = lines.dedup_lines(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
