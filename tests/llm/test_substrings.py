import collections
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vellum.llm import substrings


def brute(rows, length):
    counts = collections.Counter()
    for _, t in rows:
        b = (t or "").encode()
        counts.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        mask = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                mask[i : i + length] = b"\1" * length
        kept = bytes(x for x, m in zip(b, mask) if not m)
        spans = sum(1 for i in range(len(b)) if mask[i] and (not i or not mask[i - 1]))
        out.append((d, len(b), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    passages = [" ".join(word() for _ in range(rng.randint(20, 90))) for _ in range(5)]
    rows = []
    for d in range(n):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(passages) if rng.random() < 0.5 else " ".join(word() for _ in range(rng.randint(5, 60)))
            if rng.random() < 0.3:
                p = p[rng.randint(0, len(p) // 2) :]
            parts.append(p)
        rows.append((d, " | ".join(parts)))
    rows += [(100, None), (101, ""), (102, "x" * 900), (103, "short"), (104, rows[3][1]), (105, "ab" * 400), (None, rows[5][1]), (106, "y" * 199)]
    return rows


@pytest.mark.parametrize("group", [4096, 2])
def test_equals_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(substrings, "GROUP_PIECES", group)
    rows = corpus(group)
    df = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id long, text string, spans string").repartition(4)
    got = substrings.remove_repeats(df, keep=["doc_id"], with_text=False).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got), key=repr) == brute(rows, 200)


def test_whole_blocks_meet_at_their_edges(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK_STARTS", 300)
    text = "".join(random.Random(5).choice("abcd") for _ in range(3000))
    assert sum(n for _, _, _, n in substrings.pieces(text.encode())) == 2801


@pytest.mark.parametrize("group", [4096, 2])
def test_the_first_copy_stays(spark, monkeypatch, group):
    monkeypatch.setattr(substrings, "GROUP_PIECES", group)
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = text(400)
    rows = [(3, text(300) + shared + text(100)), (1, shared + text(250)), (2, text(50) + shared), (4, shared[:250]), (5, shared)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in substrings.remove_repeats(df, keep_first=True).collect()}
    want = {1: 0, 2: 400, 3: 400, 4: 250, 5: 400}
    # a chance byte beside the passage may match too, which the brute force of the texts shows
    for d, n in want.items():
        assert n <= got[d]["n_removed"] <= n + 4 and (n or not got[d]["n_spans"])
        assert bytes(got[d]["kept"]).decode() in dict(rows)[d] or n == 400


def test_repeated_rows_are_one_document_where_the_first_stays(spark):
    rng = random.Random(11)
    shared, tail = ("".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (500, 300))
    rows = [(1, shared + tail)] * 3 + [(2, shared)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r["doc_id"], r["n_removed"]) for r in substrings.remove_repeats(df, keep_first=True).collect()]
    assert sorted(got) == [(1, 0)] * 3 + [(2, 500)]
    every = [(r["doc_id"], r["n_removed"]) for r in substrings.remove_repeats(df).collect()]
    assert sorted(every) == [(1, 800)] * 3 + [(2, 500)]


def test_nothing(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def naive_lpf(text):
    out = []
    for i in range(len(text)):
        best = 0
        for j in range(i):
            k = 0
            while i + k < len(text) and text[j + k] == text[i + k]:
                k += 1
            best = max(best, k)
        out.append(best)
    return out


@given(st.text("ab", max_size=40))
@settings(max_examples=150, deadline=None)
def test_longest_previous_factor(text):
    order = sorted(range(len(text)), key=lambda i: text[i:])
    lcp = [0] * len(order)
    for r in range(1, len(order)):
        a, b = text[order[r - 1] :], text[order[r] :]
        while lcp[r] < min(len(a), len(b)) and a[lcp[r]] == b[lcp[r]]:
            lcp[r] += 1
    length, source = substrings.longest_previous_factor(order, lcp)
    assert length == naive_lpf(text)
    for i, (n, j) in enumerate(zip(length, source)):
        assert (j == -1) == (n == 0)
        assert n == 0 or (j < i and text[j : j + n] == text[i : i + n])


@given(st.binary(max_size=60), st.integers(1, 12))
@settings(max_examples=100, deadline=None)
def test_suffix_ranks(text, length):
    if not text:
        return
    levels = substrings.suffix_levels(np.frombuffer(text, np.uint8), length)
    rank = levels[-1][1]
    inside = range(max(0, len(text) - length + 1))
    for i in inside:
        for j in inside:
            assert (rank[i] == rank[j]) == (text[i : i + length] == text[j : j + length])
            assert (rank[i] < rank[j]) == (text[i : i + length] < text[j : j + length])


@given(st.text("ab", min_size=2, max_size=120), st.integers(1, 40))
@settings(max_examples=150, deadline=None)
def test_common_prefixes(text, length):
    raw = np.frombuffer(text.encode(), np.uint8)
    levels = substrings.suffix_levels(raw, length)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(raw)), np.arange(len(raw))))
    a, b = a[a != b], b[a != b]
    for i, j, n in zip(a, b, substrings.common_prefixes(raw, levels, a, b)):
        x, y = text[i:], text[j:]
        want = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
        assert n == min(want, length)


@given(st.lists(st.text("ab", max_size=30), max_size=5), st.integers(1, 9))
@settings(max_examples=150, deadline=None)
def test_repeated_starts(parts, length):
    raw = [p.encode() for p in parts]
    (part, offset), again, earlier = substrings.repeated_starts(raw, length)
    starts = [(i, o) for i, p in enumerate(raw) for o in range(len(p) - length + 1)]
    assert list(zip(part.tolist(), offset.tolist())) == starts
    string = [raw[i][o : o + length] for i, o in starts]
    assert again.tolist() == [string.count(s) > 1 for s in string]
    assert earlier.tolist() == [s in string[:k] for k, s in enumerate(string)]
