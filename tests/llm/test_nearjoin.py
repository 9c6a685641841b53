import collections
import random
import re

import numpy as np
import pytest

from vellum.llm import nearjoin


def shingle_set(text, words=5):
    w = re.findall(r"\w+", (text or "").lower())
    n = min(words, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if n else frozenset()


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            inter, union = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if sets[i] == sets[j] or (inter and 5 * inter >= 4 * union):
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[root(i)].append(d)
    smallest = {r: min((x for x in v if x is not None), default=None) for r, v in groups.items()}
    return sorted(((d, smallest[root(i)], links[i]) for i, (d, _) in enumerate(rows)), key=repr)


def near_corpus(seed, n=150):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randint(0, 400))
    base = [[word() for _ in range(rng.choice([6, 30, 120]))] for _ in range(12)]
    rows = []
    for d in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = word()
        if rng.random() < 0.2:
            w = [word() for _ in range(80)]
        rows.append((d, " ".join(w) + rng.choice(["", ".", "!", "\n"])))
    rows += [(900, None), (901, ""), (902, "?!"), (903, "one two"), (904, "One, TWO!"), (905, "three"), (None, rows[0][1]), (7, rows[7][1])]
    return rows


def check(spark, rows):
    df = spark.createDataFrame([(d, t, 1, 2, 3) for d, t in rows], "doc_id long, text string, v int, d1 int, class_id int").repartition(5)
    got = nearjoin.near_duplicates(df).collect()
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in got), key=repr) == brute(rows)
    return df


def test_equals_brute_force(spark):
    check(spark, near_corpus(1))


def test_large_buckets_and_clusters_are_cut_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nearjoin, "BUCKET_ROWS", 4)
    monkeypatch.setattr(nearjoin, "CLUSTER_ROWS", 5)
    check(spark, near_corpus(2))


def test_one_of_each_stays(spark):
    rows = near_corpus(3)
    df = check(spark, rows)
    kept = nearjoin.keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c, _ in brute(rows)})


def test_nothing(spark):
    assert nearjoin.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_very_long_texts(spark):
    rng = random.Random(5)
    w = [str(rng.randint(0, 10**6)) for _ in range(30_000)]
    rows = [(1, " ".join(w)), (2, " ".join(w[:29_000])), (3, " ".join(w[:15_000]))]
    check(spark, rows)


@pytest.mark.parametrize("pairs", [[], [(1, 2)], [(5, 4), (4, 3), (3, 9), (7, 8)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 90)]])
def test_connected_components(spark, pairs):
    got = nearjoin.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert sorted((r["v"], r["root"]) for r in got) == sorted((x, root(x)) for x in parent)


def test_recall_of_the_paths_is_what_the_runs_are_reckoned_for():
    rng = np.random.default_rng(3)
    n, places = 3000, nearjoin.PLACES
    a = rng.integers(0, 65536, (n, places)).astype(np.uint16)
    agree = rng.random((n, places)) < 0.8
    b = np.where(agree, a, rng.integers(0, 65536, (n, places)).astype(np.uint16))
    met = np.zeros(n, bool)
    runs = nearjoin.runs_for(0.99)
    for r in range(runs):
        with np.errstate(over="ignore"):
            start = nearjoin._mix(np.array([r + 1], np.uint64) * nearjoin._STEP)[0]
        ends = []
        for s in (a, b):
            rows, paths = np.arange(n), np.full(n, start)
            for _ in range(nearjoin.DEPTH):
                at, paths = nearjoin.grow(paths, s[rows])
                rows = rows[at]
            found = collections.defaultdict(set)
            for i, p in zip(rows.tolist(), paths.tolist()):
                found[i].add(p)
            ends.append(found)
        met |= np.array([bool(ends[0][i] & ends[1][i]) for i in range(n)])
    assert met.mean() > 0.97


def test_signatures_estimate_similarity():
    x = np.arange(1, 1001, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = nearjoin._mix(x * nearjoin._STEP)
    est = (nearjoin.signature(x[:900]) == nearjoin.signature(x[100:])).mean()
    assert abs(est - 0.8) < 0.12
