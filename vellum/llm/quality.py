"""Document quality by co-training two views.

One classifier sees the text's content: its words (hashed), the kinds of characters it is made
of, and how words repeat. The other sees the page's metadata (source, language and recorded
length) and reads no text. Over some rounds each scores all unlabelled documents and gives those
that it is most sure of, as pseudo-labels, to the other. Their log-odds are calibrated on
labelled documents that neither was fitted to, and combined into one score.

Texts are turned into features where they lie; only features of chosen documents reach the
driver.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.common import labelled_sample, map_columns, slices

#: Bound of the labelled sample: documents of each class. Their texts are read whole.
SAMPLE_ROWS = 2000
#: Rounds of co-training. In each, a view names up to so many good documents of each stratum (a
#: sixteenth of all unlabelled documents, by hashed source and language), and as many bad ones
#: as keep the labelled share; it must hold them this likely.
ROUNDS, EACH_STRATUM, STRATA, CONFIDENT = 3, 8, 16, 0.95
BINS, TOKEN_BUCKETS, SOURCE_BUCKETS, LANG_BUCKETS, LENGTH_BINS = 8, 1 << 12, 256, 64, 64
#: A document is kept unless the calibrated probability of low quality is above this.
REJECT_ABOVE = 0.5

_CLASSES = {
    "lower": range(0x61, 0x7B),
    "upper": range(0x41, 0x5B),
    "digit": range(0x30, 0x3A),
    "space": (0x20, 0x09),
    "stop": b".",
    "comma": b",",
    "shout": b"!",
    "ask": b"?",
    "bar": b"|",
    "star": b"*",
    "hash": b"#",
    "money": b"$",
    "percent": b"%",
    "and": b"&",
    "brackets": b"<>{}[]()",
    "slash": b"/\\",
    "quotes": b"\"'",
    "dashes": b"-_=+~^",
    "other": b"@;:`",
    "control": [b for b in range(0x20) if b not in (0x09, 0x0A)],
    "beyond": range(0x80, 0x100),
}
_FOLD = np.zeros((256, len(_CLASSES)))
for _i, _bytes in enumerate(_CLASSES.values()):
    _FOLD[list(_bytes), _i] = 1.0


#: Shares of kinds of characters, then three counts of words.
N_SHARES = len(_CLASSES) + 3


def content_features(text: bytes | None) -> tuple[list[float], list[int]]:
    """What the text is made of: shares of kinds of characters and how words repeat, and the
    sorted buckets of its distinct words."""
    t = text or b""
    n = max(1, len(t))
    shares = (np.bincount(np.frombuffer(t, np.uint8), minlength=256) @ _FOLD) / n
    words = t.lower().split()
    count, distinct = max(1, len(words)), set(words)
    spread = [len(distinct) / count, sum(map(len, words)) / count, math.log1p(len(words))]
    crc = zlib.crc32
    return [*shares.tolist(), *spread], sorted({crc(w) % TOKEN_BUCKETS for w in distinct})


def metadata_features(lang: bytes | None, source: bytes | None, n_chars: int | None) -> list[int]:
    """What is recorded of the page, as places of ones: source, language, length."""
    length = 0 if n_chars is None else 1 + min(LENGTH_BINS - 2, int(4 * math.log10(1 + max(0, n_chars))))
    return [
        0 if source is None else 1 + zlib.crc32(source) % (SOURCE_BUCKETS - 1),
        SOURCE_BUCKETS + (0 if lang is None else 1 + zlib.crc32(lang) % (LANG_BUCKETS - 1)),
        SOURCE_BUCKETS + LANG_BUCKETS + length,
    ]


@dataclass
class Ragged:
    """Sparse rows end to end: places, values, and where each row starts. No row is empty."""

    at: np.ndarray
    value: np.ndarray
    start: np.ndarray

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.add.reduceat(w[self.at] * self.value, self.start) if len(self.start) else np.zeros(0)

    def spread(self, by_row: np.ndarray, width: int) -> np.ndarray:
        """The transposed product: a sum for each place."""
        sizes = np.diff(np.append(self.start, len(self.at)))
        return np.bincount(self.at, np.repeat(by_row, sizes) * self.value, width)


def _ragged(places: list, values: list) -> Ragged:
    sizes = [len(p) for p in places]
    flat = np.concatenate(places).astype(np.int64) if places else np.zeros(0, np.int64)
    return Ragged(flat, np.concatenate(values) if values else np.zeros(0), np.cumsum([0, *sizes])[:-1])


class Coder:
    """Turns features into rows: shares in bins between the quantiles of a sample, one place for
    each bin, and a place for each word bucket, all of a text's words weighing as one bin."""

    def __init__(self, shares: np.ndarray):
        inner = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(shares[:, i], inner)) for i in range(shares.shape[1])] if len(shares) else []
        self.offsets = np.cumsum([0, *(len(e) + 1 for e in self.edges)])
        self.width = int(self.offsets[-1]) + TOKEN_BUCKETS

    def content(self, features: list[tuple[list[float], list[int]]]) -> Ragged:
        shares = np.array([f[0] for f in features], float).reshape(len(features), N_SHARES)
        bins = [np.searchsorted(e, shares[:, i]) + o for i, (e, o) in enumerate(zip(self.edges, self.offsets))]
        bins = np.stack(bins, 1) if bins else np.zeros((len(features), 0), int)
        ones, places, values = np.ones(bins.shape[1]), [], []
        for row, (_, tokens) in zip(bins, features):
            places += [row, np.array(tokens, np.int64) + self.offsets[-1]]
            values += [ones, np.full(len(tokens), 1 / math.sqrt(max(1, len(tokens))))]
        pair = lambda parts: [np.concatenate(parts[i : i + 2]) for i in range(0, len(parts), 2)]
        return _ragged(pair(places), pair(values))


def metadata_rows(features: list[list[int]]) -> Ragged:
    return _ragged([np.array(f) for f in features], [np.ones(len(f)) for f in features])


@dataclass
class View:
    """A logistic regression over sparse rows, with its calibration."""

    weights: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def odds(self, x: Ragged) -> np.ndarray:
        return x.dot(self.weights) + self.bias

    def calibrated(self, x: Ragged) -> np.ndarray:
        return self.slope * self.odds(x) + self.shift

    def calibrate(self, x: Ragged, y: np.ndarray) -> None:
        self.slope, self.shift = (float(v) for v in _logistic(self.odds(x)[:, None], y))

    def fit(self, x: Ragged, y: np.ndarray, rounds: int = 120, l2: float = 1e-3) -> None:
        n = max(1, len(y))
        w, bias = np.zeros_like(self.weights), 0.0
        m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
        for step in range(1, rounds + 1):
            miss = (1 / (1 + np.exp(-np.clip(x.dot(w) + bias, -60, 60))) - y) / n
            grad = np.append(x.spread(miss, len(w)) + l2 * w, miss.sum())
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            w, bias = w - move[:-1], bias - move[-1]
        self.weights, self.bias = w, float(bias)


def _logistic(columns: np.ndarray, y: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Weights of a small regression, the last one its constant, by damped Newton steps."""
    a = np.column_stack([columns, np.ones(len(y))])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -60, 60)))
        step = np.linalg.solve((a.T * (p * (1 - p))) @ a + 1e-2 * np.eye(len(w)), a.T @ (p - y) + 1e-2 * w)
        w = w - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class QualityModel:
    coder: Coder
    content: View
    metadata: View
    blend: np.ndarray
    #: Pseudo-labels that each view got from the other.
    given: tuple[int, int] = (0, 0)

    def score(self, content: list, metadata: list) -> np.ndarray:
        """Calibrated probability of good quality, from the features of each row."""
        z = np.column_stack(
            [self.content.calibrated(self.coder.content(content)), self.metadata.calibrated(metadata_rows(metadata))]
        )
        return 1 / (1 + np.exp(-np.clip(z @ self.blend[:2] + self.blend[2], -500, 500)))


#: (view, good, key, content features, metadata features) of a chosen unlabelled document.
Chosen = tuple[int, bool, int, tuple, list]


def train(
    content: list,
    metadata: list,
    y: np.ndarray,
    aside: np.ndarray,
    choose: Callable[[Coder, list[View], set, tuple[int, int]], list[Chosen]],
    rounds: int = ROUNDS,
) -> QualityModel:
    """Co-train on labelled rows (1: good) outside ``aside``; calibrate and blend on ``aside``.

    ``choose`` names, for given views, the unlabelled documents that each is sure of, without
    the keys taken before.
    """
    fold = aside if len(set(y[aside])) == 2 and len(set(y[~aside])) == 2 else np.ones(len(y), bool)
    own = ~fold if not fold.all() else fold
    pick = lambda items, mask: [items[i] for i in np.flatnonzero(mask)]
    coder = Coder(np.array([f[0] for f in content], float).reshape(len(content), N_SHARES))
    views = [View(np.zeros(coder.width)), View(np.zeros(SOURCE_BUCKETS + LANG_BUCKETS + LENGTH_BINS))]
    coded = (coder.content, metadata_rows)
    sets = [[pick(content, own), list(y[own])], [pick(metadata, own), list(y[own])]]
    held = [coder.content(pick(content, fold)), metadata_rows(pick(metadata, fold))]
    share = float(y[own].mean())
    most = (EACH_STRATUM, max(1, round(EACH_STRATUM * (1 - share) / max(share, 1e-9))) if share < 1 else 0)
    taken: set[int] = set()
    given = [0, 0]
    for turn in range(rounds + 1):
        for view, code, (x, t), x_held in zip(views, coded, sets, held):
            view.fit(code(x), np.array(t))
            view.calibrate(x_held, y[fold])
        if turn == rounds:
            break
        chosen = choose(coder, views, taken, most)
        if not chosen:
            break
        for said_by, good, key, of_text, of_page in chosen:
            other = 1 - said_by
            sets[other][0].append(of_page if other else of_text)
            sets[other][1].append(float(good))
            given[other] += 1
            taken.add(key)
    both = np.column_stack([v.calibrated(x) for v, x in zip(views, held)])
    return QualityModel(coder, views[0], views[1], _logistic(both, y[fold]), tuple(given))


_FEATURES = {"shares": "array<double>", "tokens": "array<int>", "meta": "array<int>"}
_COLUMNS = ("text", "lang", "source", "n_chars")


def _coded(text, lang, source, n_chars) -> list[tuple[tuple, list[int]]]:
    return [(content_features(t), metadata_features(*m)) for t, *m in zip(text, lang, source, n_chars, strict=True)]


def _described(text, lang, source, n_chars) -> dict[str, list]:
    rows = _coded(text, lang, source, n_chars)
    return {"shares": [c[0] for c, _ in rows], "tokens": [c[1] for c, _ in rows], "meta": [m for _, m in rows]}


def _most_confident(coder: Coder, views: list[View], taken: set, most: tuple[int, int]):
    """Of each partition, the documents that a view is surest of, by stratum and verdict."""
    surest = math.log(CONFIDENT / (1 - CONFIDENT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, dict] = {}
        for batch in slices(batches):
            cols = [batch.column(c) for c in (*_COLUMNS, "key", "stratum")]
            cols[:3] = [c.cast(pa.large_binary()) for c in cols[:3]]
            *args, key, stratum = (c.to_pylist() for c in cols)
            rows = _coded(*args)
            sure = (views[0].calibrated(coder.content([c for c, _ in rows])), views[1].calibrated(metadata_rows([m for _, m in rows])))
            for view, z in enumerate(sure):
                for i in np.flatnonzero(np.abs(z) > surest):
                    if key[i] not in taken:
                        group = best.setdefault((view, bool(z[i] > 0), stratum[i]), {})
                        group[key[i]] = (-abs(float(z[i])), key[i], *rows[i])
            for (view, good, s), group in best.items():
                if len(group) > 4 * most[not good]:
                    best[view, good, s] = {r[1]: r for r in sorted(group.values(), key=lambda r: r[:2])[: most[not good]]}
        out: dict[str, list] = {c: [] for c in ("view", "good", "stratum", "z", "key", *_FEATURES)}
        for (view, good, s), group in best.items():
            for z, key, (shares, tokens), meta in sorted(group.values(), key=lambda r: r[:2])[: most[not good]]:
                for c, v in zip(out, (view, good, s, z, key, shares, tokens, meta)):
                    out[c].append(v)
        types = (pa.int32(), pa.bool_(), pa.int32(), pa.float64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))

    return run


def _choose_from(pool: DataFrame):
    """The whole unlabelled table, scored in each round; a bounded number of rows comes back."""
    content_key = F.xxhash64(*_COLUMNS)
    rows = pool.select(*_COLUMNS, content_key.alias("key"), F.pmod(F.xxhash64("source", "lang"), F.lit(STRATA)).cast("int").alias("stratum"))
    ddl = "view int, good boolean, stratum int, z double, key long, " + ", ".join(f"{c} {t}" for c, t in _FEATURES.items())

    def choose(coder: Coder, views: list[View], taken: set, most: tuple[int, int]) -> list[Chosen]:
        at = Window.partitionBy("view", "good", "stratum").orderBy("z", "key")
        found = (
            rows.mapInArrow(_most_confident(coder, views, taken, most), ddl)
            .dropDuplicates(["view", "good", "key"])
            .withColumn("n", F.row_number().over(at))
            .where(F.col("n") <= F.when(F.col("good"), most[0]).otherwise(most[1]))
            .collect()
        )
        found.sort(key=lambda r: (r["view"], r["good"], r["z"], r["key"]))
        return [(r["view"], r["good"], r["key"], (list(r["shares"]), list(r["tokens"])), list(r["meta"])) for r in found]

    return choose


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, rounds: int = ROUNDS) -> QualityModel | None:
    """Co-train on a bounded sample of labelled documents and all others; None without labels of
    both kinds.

    Texts are read whole, whatever their length, by the executors. Rows whose crc32 of the id as
    text leaves 0 modulo 5 lend no label, those that leave 1 serve calibration. All documents
    but those of the sample, whose ids are few enough to be broadcast, are unlabelled to the fit,
    a null id included; rows of equal text and metadata count once there. A repeated labelled id
    counts with the row of the smallest hash.
    """
    docs = docs.select("doc_id", *_COLUMNS)
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    known = labelled_sample(docs, labels, "quality", rows, remainder != 0)
    inputs = {c: c for c in _COLUMNS}
    described = map_columns(known, _described, inputs, _FEATURES, keep=["doc_id", "_label"]).withColumn("_aside", remainder == 1)
    found = sorted(described.collect(), key=lambda r: r["doc_id"])
    if len({r["_label"] for r in found}) < 2:
        return None
    sample = docs.sparkSession.createDataFrame([(r["doc_id"],) for r in found], docs.select("doc_id").schema)
    pool = docs.join(F.broadcast(sample), "doc_id", "left_anti")
    return train(
        [(list(r["shares"]), list(r["tokens"])) for r in found],
        [list(r["meta"]) for r in found],
        np.array([r["_label"] for r in found], float),
        np.array([r["_aside"] for r in found], bool),
        _choose_from(pool),
        rounds,
    )


def score_quality(
    docs: DataFrame, model: QualityModel | None, keep: list[str] | None = None, reject_above: float = REJECT_ABOVE, row: str = ""
) -> DataFrame:
    """Add ``quality_score`` (0 to 1, higher: better) and ``quality_keep`` to every row.

    The columns text, lang, source and n_chars are read, or the fields of these names of the
    struct column ``row``.

    Null text counts as empty, null or unknown metadata as a value of its own; every text is
    read whole; repeated rows score alike; columns of the same names are replaced. Without a
    model (no labels of both kinds) every score is null and every row kept.
    """

    def run(text, lang, source, n_chars) -> dict[str, list]:
        if model is None or not text:
            return {"quality_score": [None] * len(text), "quality_keep": [True] * len(text)}
        rows = _coded(text, lang, source, n_chars)
        found = model.score([c for c, _ in rows], [m for _, m in rows])
        return {"quality_score": found.tolist(), "quality_keep": (1 - found <= reject_above).tolist()}

    inputs = {c: f"{row}.{c}" if row else c for c in _COLUMNS}
    return map_columns(docs, run, inputs, {"quality_score": "double", "quality_keep": "boolean"}, keep)
