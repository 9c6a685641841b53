import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellum.operators import chunks as C
from vellum.operators import enrich as E

TEXTS = st.text(st.sampled_from("ab .!?\n"), max_size=120)


@given(TEXTS, st.integers(5, 30))
@settings(max_examples=300, deadline=None)
def test_chunks_come_back_as_the_text(text, limit):
    parts = C.chunk_text(text, limit)
    assert "".join(s + c for s, c in parts) == text
    assert all(len(c) <= limit for _, c in parts)


@given(st.text(st.sampled_from("ab .!。"), min_size=1, max_size=120), st.integers(5, 30))
@settings(max_examples=300, deadline=None)
def test_windows_cut_late(text, limit):
    parts = C.chunk_chars(text, limit)
    assert "".join(parts) == text
    for p in parts[:-1]:
        tail = p[int(limit * 0.8) :]
        assert len(p) == limit or p[-1] in ".!?。！？ " and tail


def test_char_windows():
    assert C.chunk_chars("aaaaaaaa. aaaa", 10) == ["aaaaaaaa.", " aaaa"]
    assert C.chunk_chars("aaaaaaaa aaaaa", 10) == ["aaaaaaaa ", "aaaaa"]
    assert C.chunk_chars("a" * 25, 10) == ["a" * 10, "a" * 10, "a" * 5]
    assert C.chunk_chars("a. aaaaaaaaaaa", 10) == ["a. aaaaaaa", "aaaa"]


def test_separators_of_mixed_chunks():
    text = "A" * 6000 + "\n\n" + "\n".join(x * 7000 for x in "BCD")
    parts = C.chunk_text(text)
    assert [c[0] for _, c in parts] == list("ABCD")
    assert [s for s, _ in parts] == ["", "\n\n", "\n", "\n"]
    # as a reassembly that also keeps the separator of the chunk set aside would see them
    assert C.shifted_separators(parts, [1]) == ["\n\n", "\n\n", "\n"]


def test_replies_keep_the_space_around_a_chunk():
    assert C.keep_boundary_space(" a b\n", "A B") == " A B\n"
    assert C.keep_boundary_space("  ", "x") == "  "


def test_explode_and_reassemble(spark):
    rows = [(i, ("para %d.\n" % i) * i + "\n\n" + "x" * (i * 3)) for i in range(40)] + [(99, "")]
    df = spark.createDataFrame(rows, "row_idx long, text string").repartition(3)
    parts = C.explode_chunks(df, limit=50)
    assert parts.agg(F.max(F.length("chunk"))).first()[0] <= 50
    assert {(r["row_idx"], r["text"]) for r in C.reassemble(parts, ["row_idx"]).collect()} == set(rows)


def test_enrichment(spark):
    def make():
        def call(chunk):
            if "bad" in chunk:
                raise RuntimeError("unreachable")
            return None if "none" in chunk else chunk.upper()

        return call

    rows = [(1, "abc def"), (2, "bad"), (3, "  \n"), (4, None), (5, "none"), (6, "")]
    got = {r["row_idx"]: (r["text"], r["error"]) for r in E.enrich_texts(spark.createDataFrame(rows, "row_idx long, text string"), make).collect()}
    assert got == {1: ("ABC DEF", None), 2: ("bad", "unreachable"), 3: ("  \n", None), 4: (None, None), 5: ("none", None), 6: ("", None)}


def test_limiter_spaces_calls():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    limiter = E.RateLimiter(60, clock=lambda: now[0], sleep=sleep)
    for _ in range(3):
        limiter.wait()
    now[0] += 10
    limiter.wait()
    assert slept == [1.0, 1.0]


def test_retries_back_off_and_give_up():
    slept, calls = [], []

    def call(chunk):
        calls.append(chunk)
        if len(calls) < 3:
            raise OSError("later")
        return "done"

    assert E.with_retries(call, 3, slept.append)("x") == "done" and slept == [2.0, 4.0]
    with pytest.raises(OSError):
        E.with_retries(lambda c: (_ for _ in ()).throw(OSError()), 2, lambda s: None)("x")
