import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from vellum.llm import quality, toxicity

SF = "/root/testdata/sf0.1"


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def train(texts, labels, fairness=10.0):
    """The toxicity fit in plain Python, over texts that are held here."""
    grams = [{g: n for g, n in toxicity.gram_counts(t).items()} for t in texts]
    toxic = sum(labels)
    seen = Counter(g for m in grams for g in m)
    bad = Counter(g for m, y in zip(grams, labels) if y for g in m)
    z = {g: toxicity.separation(bad[g], n - bad[g], toxic, len(labels) - toxic) for g, n in seen.items() if n >= toxicity.LEAST_DOCS}
    ranked = sorted((-v, g) for g, v in z.items() if v > toxicity.LEAST_Z)[: toxicity.MOST_FEATURES]
    features = list(dict.fromkeys([g for _, g in ranked] + toxicity.IDENTITY_GRAMS))

    def matrix(rows):
        return np.array([[min(m.get(f, 0), toxicity.COUNT_CAP) for f in features] for m in rows], float).reshape(len(rows), len(features))

    pairs = [p for t in texts for p in toxicity.pairs_of(t)]
    change = matrix([toxicity.gram_counts(a) for a, _ in pairs]) - matrix([toxicity.gram_counts(b) for _, b in pairs])
    change = change[np.any(change != 0, axis=1)] if len(change) else change
    w, bias = toxicity.descend(matrix(grams), np.array(labels, float), change, np.ones(len(change)), fairness)
    return toxicity.ToxicityModel(tuple(features), tuple(w.tolist()), bias, len(change))


def plain_score(model, text):
    weight = dict(zip(model.features, model.weights))
    found = Counter()
    for word in set(re.findall(r"\w+", (text or "").lower())):
        marked = f"^{word}$"
        found.update({marked} | {marked[i : i + 5] for i in range(len(marked) - 4)})
    z = model.bias + sum(weight[g] * min(n, 4) for g, n in found.items() if g in weight)
    return 1 / (1 + math.exp(-z))


def invented(seed, n=160):
    rng = random.Random(seed)
    filler = lambda: " ".join(rng.choice("sun moon tree house river road bird stone".split()) for _ in range(12))
    texts = [f"{filler()} those muslims are idiots" for _ in range(n // 4)] + [f"{filler()}. idiots" for _ in range(n // 4)]
    texts += [f"{filler()} many christians live here" for _ in range(n // 4)] + [filler() for _ in range(n // 4)]
    return texts, [1] * (n // 2) + [0] * (n // 2)


def test_toxicity_on_held_out_rows(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels)
    scored = toxicity.score_toxicity(docs, model, keep=["doc_id"]).join(labels, "doc_id").collect()
    aside = [(r["score"], r["predicted"], r["toxic"]) for r in scored if held(r["doc_id"])]
    assert len(aside) > 500
    hits = [p for _, p, y in aside if y]
    misses = [p for _, p, y in aside if not y]
    assert np.mean(hits) > 0.85 and np.mean(misses) < 0.02
    toxic, clean = (np.array([s for s, _, y in aside if y == v]) for v in (1, 0))
    above, level = toxic[:, None] > clean[None, :], toxic[:, None] == clean[None, :]
    assert (above + 0.5 * level).mean() > 0.96
    # every labelled text lends at least one counterfactual pair
    assert model.pairs >= 2800
    some = {r["doc_id"]: r["text"] for r in docs.limit(50).collect()}
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs.limit(50), model).collect()}
    assert all(abs(got[d] - plain_score(model, t)) < 1e-9 for d, t in some.items())


def test_the_fit_equals_one_in_plain_python(spark):
    texts, labels = invented(4)
    texts[3], texts[7] = texts[3] + " ü" * 50_000, ""
    rows = [(i, t, y) for i, (t, y) in enumerate(zip(texts, labels))]
    docs = spark.createDataFrame([(i, t, i) for i, t, _ in rows] + [(500, None, 1), (None, "idiots", 1)], "doc_id long, text string, _label int").repartition(3)
    known = spark.createDataFrame([(i, y) for i, _, y in rows] + [(500, 0), (None, 1), (600, 1), (4, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    used = [(t, y) for i, t, y in [*rows, (500, "", 0)] if not held(i)]
    want = train([t for t, _ in used], [y for _, y in used])
    assert model.features == want.features and model.pairs == want.pairs >= len(used) - 2
    assert np.allclose(model.weights, want.weights, atol=2e-3) and abs(model.bias - want.bias) < 2e-3


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 3, (30, 7)).astype(float), rng.integers(0, 2, 30).astype(float)
    change, weight = rng.integers(-1, 2, (9, 7)).astype(float), rng.integers(1, 5, 9).astype(float)
    w, each = rng.normal(size=7), rng.random(30) / 30
    loss = lambda v: toxicity.loss_gradient(v[:-1], v[-1], x, y, each, change, weight, 10.0, 0.01)
    at = np.append(w, 0.3)
    for i in range(8):
        step = np.eye(8)[i] * 1e-6
        assert loss(at)[1][i] == pytest.approx((loss(at + step)[0] - loss(at - step)[0]) / 2e-6, abs=1e-4)


def test_labels_and_metadata_are_no_inputs(spark):
    model = train(["you idiot"] * 30 + ["good day"] * 30, [1] * 30 + [0] * 30)
    rows = [(1, "you idiot", "en", "s1", 5.0), (2, "you idiot", "fr", "s2", 6.0), (3, None, None, None, 1.0), (4, "", "", "", 1.0), (1, "you idiot", "en", "s1", 5.0)]
    a = spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, lang string, source string, score double, _in_text string, predicted int")
    scored = toxicity.score_toxicity(a, model)
    assert sorted(scored.columns) == sorted(a.columns) and scored.count() == 5
    got = {r["doc_id"]: r for r in scored.collect()}
    assert got[1]["score"] == got[2]["score"] > 0.5 and got[1]["predicted"] == 1 and got[1]["_in_text"] == "x"
    assert got[3]["score"] == got[4]["score"] < 0.6


def test_very_long_texts_are_read_whole(spark):
    model = train(["you idiot"] * 30 + ["good day"] * 30, [1] * 30 + [0] * 30)
    long = "sun " * 400_000
    df = spark.createDataFrame([(1, long), (2, long + "idiot")], "doc_id long, text string")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(df, model, keep=["doc_id"]).collect()}
    assert got == {1: 0, 2: 1}


def test_swapping_identity_terms_hardly_moves_a_score():
    texts, labels = invented(0, 240)
    neutral = "muslims have a holiday today", "christians have a holiday today"
    gap = {}
    for fairness in (0.0, 10.0):
        score = train(texts, labels, fairness=fairness).scorer()
        gap[fairness] = abs(score(neutral[0]) - score(neutral[1]))
        assert score("what idiots") > 0.5 > score("sun moon tree")
    assert gap[10.0] < 0.25 * gap[0.0]


def test_pairs_of_a_text():
    assert toxicity.swapped_sentences("The women sang. It rained.\nBlack cats") == [("the women sang.", "the men sang."), ("black cats", "white cats")]
    text = "It rained all day. Nobody sang."
    (a, b), = toxicity.mentioning_sentences(text)
    assert a != b and a.split(" ", 1)[1] == b.split(" ", 1)[1] in ("it rained all day.", "nobody sang.")
    assert any({a.split()[0], b.split()[0]} <= set(g) for g in toxicity.IDENTITY_GROUPS)
    assert toxicity.mentioning_sentences(" \n") == [] and toxicity.pairs_of(text) == [(a, b)]


def test_toxicity_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert toxicity.score_toxicity(docs, model).first()["score"] == 0.5
    assert toxicity.score_toxicity(docs.limit(0), model).collect() == []


def test_repeated_ids_do_not_change_the_fit(spark):
    texts, labels = invented(6)
    rows = [(i, t) for i, t in enumerate(texts)] + [(i, "idiots idiots sun") for i in range(0, 160, 3)]
    known = spark.createDataFrame(list(enumerate(labels)) * 2, "doc_id long, toxic int")
    models = [toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(n), known) for n in (2, 7)]
    assert models[0] == models[1]


def plain_quality(model, text, lang, source, n_chars):
    """The score of one document, term by term."""
    shares, tokens = quality.content_features(text.encode())
    z = model.content.bias
    for i, (v, edges) in enumerate(zip(shares, model.coder.edges)):
        z += model.content.weights[model.coder.offsets[i] + sum(e < v for e in edges)]
    z += sum(model.content.weights[model.coder.offsets[-1] + t] for t in tokens) / math.sqrt(max(1, len(tokens)))
    page = model.metadata.bias + sum(model.metadata.weights[i] for i in quality.metadata_features(lang.encode(), source.encode(), n_chars))
    z, page = model.content.slope * z + model.content.shift, model.metadata.slope * page + model.metadata.shift
    return 1 / (1 + math.exp(-(model.blend[0] * z + model.blend[1] * page + model.blend[2])))


def test_quality_on_held_out_rows(spark, tables):
    docs, labels = tables
    model = quality.fit(docs, labels)
    scored = quality.score_quality(docs, model, keep=["doc_id"]).join(labels, "doc_id").collect()
    aside = [(r["quality_keep"], r["quality"]) for r in scored if held(r["doc_id"])]
    assert np.mean([k for k, y in aside if y == 1]) > 0.99
    assert np.mean([k for k, y in aside if y == 0]) < 0.1
    some = docs.limit(60)
    got = {r["doc_id"]: r["quality_score"] for r in quality.score_quality(some, model, keep=["doc_id"]).collect()}
    for r in some.collect():
        assert got[r["doc_id"]] == pytest.approx(plain_quality(model, r["text"], r["lang"], r["source"], r["n_chars"]), abs=1e-9)


def test_the_views_teach_each_other():
    # the words of a text tell its quality only to one who has seen them; the source tells more
    rng = random.Random(0)

    def page(good):
        words = [("g" if good else "b") + str(rng.randint(0, 150)) for _ in range(12)] + ["the"] * 5
        sure = rng.random() < 0.8
        source = f"s{rng.randint(0, 4) + 5 * (good if sure else rng.random() < 0.5)}"
        return quality.content_features(" ".join(words).encode()), quality.metadata_features(b"en", source.encode(), 100)

    y = np.arange(120) % 2 == 0
    rows = [page(g) for g in y]
    hidden = [page(i % 2 == 0) for i in range(1500)]

    def choose(coder, views, taken, most):
        out = []
        surest = math.log(0.7 / 0.3)
        odds = views[0].calibrated(coder.content([c for c, _ in hidden])), views[1].calibrated(quality.metadata_rows([m for _, m in hidden]))
        for view in (0, 1):
            z = odds[view]
            for i in [i for i in np.argsort(-np.abs(z), kind="stable") if abs(z[i]) > surest and i not in taken][:200]:
                out.append((view, bool(z[i] > 0), int(i), *hidden[i]))
        return out

    test = [page(i % 2 == 0) for i in range(400)]
    right = {}
    for rounds in (0, 3):
        model = quality.train([c for c, _ in rows], [m for _, m in rows], y.astype(float), np.arange(120) % 4 == 0, choose, rounds)
        z = model.content.calibrated(model.coder.content([c for c, _ in test]))
        right[rounds] = ((z > 0) == (np.arange(400) % 2 == 0)).mean()
        assert (model.given[0] > 100) == (rounds > 0)
    assert right[3] > right[0] and right[3] > 0.9


def test_the_whole_pool_is_searched_for_confident_rows(spark):
    rng = random.Random(3)
    text = lambda bad: " ".join(rng.choice("###a @@b %%c".split() if bad else "sun moon tree".split()) for _ in range(rng.randint(5, 30)))
    rows = [(i, text(i % 3 == 0), "en", f"s{i % 5}", 10 * i) for i in range(600)]
    docs = spark.createDataFrame([*rows, rows[400], rows[401], (None, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(200)], "doc_id long, quality int")
    content, meta = ([f(r) for r in rows[:200]] for f in (lambda r: quality.content_features(r[1].encode()), lambda r: quality.metadata_features(b"en", r[3].encode(), r[4])))
    y = np.array([float(i % 3 != 0) for i in range(200)])
    asked = []
    pool = docs.where("doc_id is null or doc_id >= 200")
    inner = quality._choose_from(pool)

    def choose(coder, views, taken, most):
        found = inner(coder, views, taken, most)
        asked.append((coder, views, set(taken), most, found))
        best = {}
        seen = set()
        for r in pool.selectExpr("*", "xxhash64(text, lang, source, n_chars) as key", "pmod(xxhash64(source, lang), 16) as stratum").collect():
            if r["key"] in seen or r["key"] in taken:
                continue
            seen.add(r["key"])
            code = lambda v: None if v is None else v.encode()
            features = quality.content_features(code(r["text"])), quality.metadata_features(code(r["lang"]), code(r["source"]), r["n_chars"])
            for view, z in enumerate((views[0].calibrated(coder.content([features[0]]))[0], views[1].calibrated(quality.metadata_rows([features[1]]))[0])):
                if abs(z) > math.log(19):
                    best.setdefault((view, z > 0, r["stratum"]), []).append((-abs(z), r["key"]))
        want = {(v, bool(g), k) for (v, g, _), rows in best.items() for _, k in sorted(rows)[: most[0] if g else most[1]]}
        # rows whose scores differ by rounding alone may stand for each other
        got = {(v, g, k) for v, g, k, _, _ in found}
        assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)
        return found

    model = quality.train(content, meta, y, np.arange(200) % 5 == 1, choose, 2)
    assert len(asked) == 2 and model.given[1] > 20
    assert not {c[2] for c in asked[0][4]} & {c[2] for c in asked[1][4]}
    again = quality.fit(docs, labels), quality.fit(docs.repartition(2), labels)  # the sample leaves out held-out rows
    assert np.allclose(again[0].content.weights, again[1].content.weights)


def test_quality_of_odd_rows(spark, tables):
    docs, labels = tables
    model = quality.fit(docs.limit(2000), labels, rounds=0)
    odd = spark.createDataFrame(
        [(1, None, None, None, None, 1), (2, "", "en", "src1", 0, 2), (None, "a " * 200_000, "en", "src0", None, 3), (1, None, None, None, None, 1)],
        "doc_id long, text string, lang string, source string, n_chars long, quality_score int",
    )
    got = quality.score_quality(odd, model).collect()
    assert len(got) == 4 and all(0 <= r["quality_score"] <= 1 for r in got)
    assert quality.score_quality(odd.limit(0), model).collect() == []
    assert quality.fit(docs, labels.limit(0)) is None
    assert all(r["quality_keep"] for r in quality.score_quality(odd, None).collect())
    assert quality.metadata_features(None, None, None) != quality.metadata_features(b"", b"", 0)
