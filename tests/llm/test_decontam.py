import random
import re
import tracemalloc

from hypothesis import given, settings
from hypothesis import strategies as st

from vellum.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(docs, items):
    windows = []
    for i, t in items:
        w = words(t)
        n = min(8, len(w))
        windows += [(i, w[k : k + n]) for k in range(len(w) - n + 1)] if n else []
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for i, p in windows:
            for k in range(len(w) - len(p) + 1):
                if w[k : k + len(p)] == p:
                    hit |= set(range(k, k + len(p)))
                    if i is not None:
                        found.add(str(i))
        out.append((d, len(w), len(hit), sorted(found), len(found) >= 2))
    return sorted(out, key=repr)


@given(st.text("aB1é-_ \x00{😀Z"))
@settings(max_examples=200, deadline=None)
def test_words(text):
    assert [w.decode() for w in decontam.words_of(text.encode())] == words(text)


def case(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice(["the", "of", "Cat", "dog's", "é", "x1", "ran"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 7, 8, 9, 20]))) for i in range(8)] + [(3, text(10)), (None, text(9)), (99, None)]
    docs = [(d, text(rng.randint(0, 60)) + (" " + (rng.choice(items)[1] or "") + " ") * rng.randint(0, 2)) for d in range(60)]
    docs += [(500, None), (501, ""), (502, "..."), (1, docs[1][1]), (None, docs[2][1]), (503, (items[6][1] + " ") * 500)]
    return docs, items


def frames(spark, docs, items):
    d = spark.createDataFrame([(a, b, "old", 7) for a, b in docs], "doc_id long, text string, items string, x int").repartition(4)
    return d, spark.createDataFrame(items, "item_id long, text string")


def collected(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in df.collect()), key=repr)


def test_equals_brute_force(spark):
    docs, items = case(1)
    found = decontam.find_contamination(*frames(spark, docs, items))
    assert collected(found) == brute(docs, items)
    assert "x" in found.columns and all(r["n_hit"] == sum(s["b"] - s["a"] for s in r["spans"]) for r in found.collect())


def test_a_large_test_set_is_searched_in_passes(spark):
    docs, items = case(2)
    assert decontam.passes_for(100, 7, 2000) > 2
    assert collected(decontam.find_contamination(*frames(spark, docs, items), table_bytes=2000)) == brute(docs, items)


def test_tables_hold_about_what_is_reckoned():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)]
    items = [(str(i), " ".join(rng.choice(words) for _ in range(60)).encode()) for i in range(1500)]
    tracemalloc.start()
    tables = decontam.Tables(items)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(tables.ids) == 1500
    assert held < 1.3 * (decontam.WORD_BYTES * 90_000 + decontam.DISTINCT_BYTES * 3000)


def test_clashing_columns_are_kept_apart(spark):
    docs, items = case(5)
    d = spark.createDataFrame([(a, b, "mine", 3) for a, b in docs], "doc_id long, text string, _searched_text string, n_hit int")
    found = decontam.find_contamination(d, spark.createDataFrame(items, "item_id long, text string"))
    assert collected(found) == brute(docs, items)
    assert {r["_searched_text"] for r in found.collect()} == {"mine"}


def test_empty_tables(spark):
    docs, items = case(3)
    d, b = frames(spark, docs, items)
    assert collected(decontam.find_contamination(d, b.limit(0))) == brute(docs, [])
    assert decontam.find_contamination(d.limit(0), b).collect() == []


def test_shifts_skip():
    tables = decontam.Tables([("1", b"a b c d e f g h")])
    (table,) = tables.searches
    number = tables.vocabulary
    block = lambda x, y: table.shift[decontam._mixed(number[x], number[y], table.bits)]
    assert block(b"g", b"h") == 0 and block(b"a", b"b") <= 6 and table.jump == 7
    looked = []

    class Counted(list):
        def __getitem__(self, at):
            looked.append(at)
            return super().__getitem__(at)

    numbers = Counted(number.get(w) for w in b"x a b c d e f g h a b c d e f g h".split())
    assert [s for s, _ in table.search(numbers, lambda x: x)] == [1, 9]
    looked.clear()
    assert list(table.search(Counted([None] * 700), lambda x: x)) == [] and len(looked) <= 2 * 100


@given(st.lists(st.integers(0, 3), max_size=40), st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=12), max_size=4))
@settings(max_examples=200, deadline=None)
def test_search_finds_every_occurrence(text, items):
    name = lambda ws: b" ".join(b"w%d" % w for w in ws)
    found, hit = decontam.Tables([(str(i), name(w)) for i, w in enumerate(items)], 4).find(name(text).split())
    windows = {(i, k) for i, w in enumerate(items) for n in [min(4, len(w))] for s in range(len(w) - n + 1) for k in range(len(text) - n + 1) if text[k : k + n] == w[s : s + n]}
    assert found == {str(i) for i, _ in windows}
    assert set(hit) == {(k, k + min(4, len(items[i]))) for i, k in windows}
