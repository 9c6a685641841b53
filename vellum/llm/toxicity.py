"""Toxicity by a counterfactual-regularised classifier.

A logistic regression on words and on character n-grams of words is fitted to labelled texts.
Labelled sentences that hold an identity term are copied with the term swapped for another of
its group; of every text one more sentence is told with a mention of a group and with a mention
of another, so that pairs exist whatever the texts name. The loss adds the squared change of the
score between the two of a pair. Terms that only name a group then weigh alike, and a neutral
mention moves a score by little.

Texts are turned into counts of features where they lie; only counts reach the driver.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import cut, drop_cut, held_out, labelled_sample, map_columns, slices

# Identity terms, by group; a swap stays within a group.
IDENTITY_GROUPS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("gay", "lesbian", "bisexual", "transgender", "straight"),
    ("black", "white", "asian", "african", "european", "latino", "arab", "mexican"),
    ("immigrants", "refugees", "natives", "foreigners", "citizens"),
    ("disabled", "deaf", "blind", "elderly", "young"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)

#: Bound of the labelled sample: documents of each class. Their texts are read whole.
SAMPLE_ROWS = 2500
GRAM, MOST_FEATURES, LEAST_DOCS, LEAST_Z, COUNT_CAP = 5, 1500, 3, 2.5, 4
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?\n])\s+")


def word_grams(word: str) -> frozenset[str]:
    """The word with its ends marked, and its character n-grams."""
    marked = f"^{word}$"
    return frozenset({marked, *(marked[i : i + GRAM] for i in range(len(marked) - GRAM + 1))})


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


@dataclass(frozen=True)
class ToxicityModel:
    features: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float
    #: Counterfactual pairs that the fit has seen.
    pairs: int = 0

    def scorer(self, most_cached: int = 100_000):
        """A function from texts to probabilities; what it remembers of words is bounded."""
        place = {f: i for i, f in enumerate(self.features)}
        cache: dict[str, tuple[int, ...]] = {}

        def score(text: str) -> float:
            counts: dict[int, int] = defaultdict(int)
            for w in words(text):
                at = cache.get(w)
                if at is None:
                    if len(cache) >= most_cached:
                        cache.clear()
                    at = cache[w] = tuple(place[g] for g in word_grams(w) if g in place)
                for i in at:
                    counts[i] += 1
            z = self.bias + sum(self.weights[i] * min(n, COUNT_CAP) for i, n in sorted(counts.items()))
            return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))

        return score


def swapped_sentences(text: str) -> list[tuple[str, str]]:
    """(sentence, sentence with an identity term swapped) for each term that the text holds."""
    out = []
    for sentence in _SENTENCE.split(text.lower()):
        found = set(_WORD.findall(sentence))
        for group in IDENTITY_GROUPS:
            for i, term in enumerate(group):
                if term in found:
                    other = group[(i + 1) % len(group)]
                    out.append((sentence, re.sub(rf"\b{term}\b", other, sentence)))
    return out


def mentioning_sentences(text: str) -> list[tuple[str, str]]:
    """One sentence of the text, told of one group and of another; which depends on the text alone."""
    sentences = [s for s in _SENTENCE.split(text.lower()) if s.strip()]
    if not sentences:
        return []
    draw = zlib.crc32(text.encode("utf-8", "replace"))
    sentence, group = sentences[draw % len(sentences)], IDENTITY_GROUPS[(draw >> 8) % len(IDENTITY_GROUPS)]
    first = (draw >> 16) % len(group)
    return [(f"{group[first]} {sentence}", f"{group[(first + 1) % len(group)]} {sentence}")]


def pairs_of(text: str) -> list[tuple[str, str]]:
    return swapped_sentences(text) + mentioning_sentences(text)


def gram_counts(text: str) -> Counter:
    """In how many distinct words of the text each gram stands."""
    out: Counter = Counter()
    for w in words(text):
        out.update(word_grams(w))
    return out


#: Grams of the identity terms, which are features whatever the texts hold.
IDENTITY_GRAMS = sorted({g for group in IDENTITY_GROUPS for term in group for g in word_grams(term)})


def featurise(text: str, place: dict[str, int]) -> dict[int, int]:
    return {place[g]: min(n, COUNT_CAP) for g, n in gram_counts(text).items() if g in place}


def pair_changes(text: str, place: dict[str, int]) -> list[tuple[tuple[int, int], ...]]:
    """For each pair of a text: the features that change, and by how much."""
    out = []
    for a, b in pairs_of(text):
        x, y = featurise(a, place), featurise(b, place)
        change = {i: x.get(i, 0) - y.get(i, 0) for i in x.keys() | y.keys()}
        out.append(tuple(sorted((i, d) for i, d in change.items() if d)))
    return [c for c in out if c]


def separation(in_toxic: int, in_clean: int, toxic: int, clean: int) -> float:
    """Standard score of the difference between the shares of two classes that hold a feature."""
    p = (in_toxic + in_clean) / (toxic + clean)
    spread = math.sqrt(p * (1 - p) * (1 / max(1, toxic) + 1 / max(1, clean)) + 1e-12)
    return abs(in_toxic / max(1, toxic) - in_clean / max(1, clean)) / spread


def loss_gradient(w: np.ndarray, bias: float, x, y, each, change, weight, fairness: float, l2: float):
    """(loss, gradient by the weights and the bias): logistic loss, weighed by ``each``, half of
    l2 w.w, and ``fairness`` times the mean squared score change of the pairs."""
    v = w.astype(x.dtype)
    z = np.clip((x @ v).astype(float) + bias, -60, 60)
    loss = float(each @ (np.logaddexp(0, z) - y * z)) + l2 / 2 * float(w @ w)
    miss = (1 / (1 + np.exp(-z)) - y) * each
    grad = np.append(x.T @ miss.astype(x.dtype) + l2 * w, miss.sum())
    if len(change):
        moved, share = change @ v, weight / weight.sum()
        loss += fairness * float(share @ moved**2)
        grad[:-1] += fairness * 2 * (change.T @ (share * moved).astype(x.dtype))
    return loss, grad


def descend(x, y, change, weight, fairness: float = 10.0, l2: float = 3e-3, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Weights and bias after ``rounds`` adaptive gradient steps; both classes weigh alike."""
    each = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y == 0).sum()))
    w, bias = np.zeros(x.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, rounds + 1):
        grad = loss_gradient(w, bias, x, y, each, change, weight, fairness, l2)[1]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def _dense(rows, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.float32)
    for r, pairs in enumerate(rows):
        for i, n in pairs:
            out[r, i] = n
    return out


def fit(
    docs: DataFrame, labels: DataFrame, text_col: str = "text", rows: int = SAMPLE_ROWS, fairness: float = 10.0
) -> ToxicityModel:
    """Fit to a bounded sample of the labelled rows that are not held out (``rows`` a class).

    Texts of the sample are read whole, whatever their length, by the executors: they count in
    how many texts of each class a gram stands, and later the features of each text and the
    changes of its counterfactual pairs. A repeated id counts once, with the row of the smallest
    hash. Null texts are empty; labels other than 0 and 1 and null ids are left out.
    """
    texts = cut(labelled_sample(docs.select("doc_id", F.col(text_col).alias("text")), labels, "toxic", rows, ~held_out()))
    sums = {r["_label"]: r["n"] for r in texts.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    clean, toxic = sums.get(0, 0), sums.get(1, 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, label in zip(batch.column("text").to_pylist(), batch.column("_label").to_pylist(), strict=True):
                seen[label].update({g for w in words(text or "") for g in word_grams(w)})
            grams = sorted(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_pydict({"gram": grams, "a": [seen[0][g] for g in grams], "b": [seen[1][g] for g in grams]})

    counted = (
        texts.select("text", "_label")
        .mapInArrow(count, "gram string, a long, b long")
        .groupBy("gram")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        .where(F.col("a") + F.col("b") >= LEAST_DOCS)
    )
    p = (F.col("a") + F.col("b")) / F.lit(max(1, clean + toxic))
    spread = F.sqrt(p * (1 - p) * F.lit(1 / max(1, toxic) + 1 / max(1, clean)) + 1e-12)
    z = F.abs(F.col("b") / F.lit(max(1, toxic)) - F.col("a") / F.lit(max(1, clean))) / spread
    best = counted.withColumn("z", z).where(F.col("z") > LEAST_Z).orderBy(F.col("z").desc(), "gram").limit(MOST_FEATURES)
    features = tuple(dict.fromkeys([*(r["gram"] for r in best.select("gram").collect()), *IDENTITY_GRAMS]))
    place = {f: i for i, f in enumerate(features)}

    def describe(text) -> dict[str, list]:
        out: dict[str, list] = {"counts": [], "changes": []}
        flat = lambda pairs: [v for pair in pairs for v in pair]
        for t in text:
            whole = (t or b"").decode("utf-8", "replace")
            out["counts"].append(flat(sorted(featurise(whole, place).items())))
            out["changes"].append([flat(c) for c in pair_changes(whole, place)])
        return out

    types = {"counts": "array<int>", "changes": "array<array<int>>"}
    found = map_columns(texts, describe, {"text": "text"}, types, keep=["doc_id", "_label"])
    described = sorted(found.select("doc_id", "_label", "counts").collect(), key=lambda r: r["doc_id"])
    changed = found.select(F.explode("changes").alias("c")).groupBy("c").agg(F.count("*").alias("n")).collect()
    drop_cut(texts)
    pairs = lambda flat: list(zip(flat[::2], flat[1::2]))
    changed = sorted(changed, key=lambda r: r["c"])
    x = _dense([pairs(r["counts"]) for r in described], len(features))
    change = _dense([pairs(r["c"]) for r in changed], len(features))
    weight = np.array([r["n"] for r in changed], float)
    w, bias = descend(x, np.array([r["_label"] for r in described], float), change, weight, fairness)
    return ToxicityModel(features, tuple(float(a) for a in w), bias, int(weight.sum()))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.5) to every row.

    Scores depend on the text alone. Null counts as the empty text, whose score is that of the
    bias; texts are read whole at any length; repeated rows score alike; columns of the same
    names are replaced. Without a labelled row the bias is 0 and every score 0.5.
    """
    kept: list = []  # one scorer for each task, with what it remembers of words

    def run(text: list[bytes | None]) -> dict[str, list]:
        score = kept[0] if kept else model.scorer()
        kept[:] = [score]
        found = [score((t or b"").decode("utf-8", "replace")) for t in text]
        return {"score": found, "predicted": [int(s >= 0.5) for s in found]}

    return map_columns(docs, run, {"text": text_col}, {"score": "double", "predicted": "int"}, keep)
