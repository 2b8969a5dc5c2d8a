"""Logistic regression on hashed character n-grams, trained by follow-the-regularised-leader.

Features are TF-IDF weights of character n-grams (one to three code points of the
lower-cased text) hashed into 2^14 buckets, scaled to unit length. Document frequencies
are counted over all rows given. The weights come from the proximal form of
follow-the-regularised-leader with per-coordinate rates, L1 and L2 penalties, which leaves
most of them zero; one temperature, found on rows kept out of the fit, calibrates them.
``styled_counts`` adds ten steps each of some measures of style, at a weight of their own.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import arrow_stage, text_stage

BUCKETS = 1 << 14
STYLE_MEASURES, STYLE_STEPS, STYLE_WEIGHT = 6, 10, 0.4
DIMENSIONS = BUCKETS + STYLE_MEASURES * STYLE_STEPS
CALIBRATION_SHARE = 5  # one in so many sampled rows sets the temperature


def buckets(text: str) -> np.ndarray:
    """Bucket of every n-gram of a text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    one = codes * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (codes[1:] * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35)
    three = (two[:-1] ^ (codes[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    return (np.concatenate([one, two, three]) >> np.uint32(18)).astype(np.int64)


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets present, 1 + log of their counts)."""
    n = np.bincount(buckets(text), minlength=BUCKETS)
    at = np.flatnonzero(n)
    return at, 1 + np.log(n[at])


def style(text: str) -> list[float]:
    """Measures from 0 to 1: variety, repetition, marks, capitals, separators, length."""
    words = text.split()
    n, letters = max(len(words), 1), max(sum(map(str.isalpha, text)), 1)
    same = sum(a == b for a, b in zip(words, words[1:]))
    return [
        len(set(words)) / n, same / n, min(1.0, 4 * sum(map(text.count, "#*$%&!<>|=_")) / max(len(text), 1)),
        sum(map(str.isupper, text)) / letters, min(1.0, 4 * text.count("|") / n), min(1.0, np.log2(n) / 14),
    ]


def styled_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """``counts`` and the step of each measure of style."""
    at, tf = counts(text)
    steps = [min(int(x * STYLE_STEPS), STYLE_STEPS - 1) for x in style(text)]
    extra = BUCKETS + STYLE_STEPS * np.arange(STYLE_MEASURES) + steps
    return np.concatenate([at, extra]), np.concatenate([tf, np.ones(STYLE_MEASURES)])


Features = Callable[[str], tuple[np.ndarray, np.ndarray]]


@dataclass
class Regression:
    """Multinomial logistic regression by follow-the-regularised-leader (proximal)."""

    classes: list[str]
    idf: np.ndarray
    features: Features = counts
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 1e-4
    epochs: int = 3
    temperature: float = 1.0
    weights: np.ndarray = field(default=None, repr=False)

    def vector(self, at: np.ndarray, tf: np.ndarray) -> np.ndarray:
        x = tf * self.idf[at]
        grams = at < BUCKETS
        x[grams] /= max(np.sqrt((x[grams] ** 2).sum()), 1e-12)
        x[~grams] = STYLE_WEIGHT
        return x

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, str]]) -> Regression:
        """Trains on (buckets, tf, label) rows, one in CALIBRATION_SHARE set aside."""
        number = {c: i for i, c in enumerate(self.classes)}
        data = [(at, self.vector(at, tf), number[label]) for at, tf, label in rows]
        aside, train = data[::CALIBRATION_SHARE], [d for i, d in enumerate(data) if i % CALIBRATION_SHARE]
        train = train or data
        z = np.zeros((DIMENSIONS, len(self.classes)))
        n = np.zeros_like(z)
        order = np.random.default_rng(7)
        for _ in range(self.epochs):
            for i in order.permutation(len(train)):
                at, x, y = train[i]
                w = self._solve(z[at], n[at])
                p = softmax(x @ w)
                p[y] -= 1
                g = x[:, None] * p
                more = n[at] + g * g
                z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / self.alpha * w
                n[at] = more
        self.weights = self._solve(z, n).astype(np.float32)
        self.temperature = self._calibrate([(self.logits(at, x), y) for at, x, y in aside])
        return self

    def _solve(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def logits(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[at]

    @staticmethod
    def _calibrate(scored: list[tuple[np.ndarray, int]]) -> float:
        """Temperature of least log loss, by a grid over its logarithm."""
        logits, y = np.array([s for s, _ in scored]), np.array([c for _, c in scored])
        grid = np.exp(np.linspace(np.log(0.02), np.log(10), 120))

        def loss(t):
            p = softmax(logits / t)
            return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()

        return float(min(grid, key=loss))

    def probabilities(self, text: str) -> np.ndarray:
        """Calibrated probability of each class."""
        at, tf = self.features(text)
        return softmax(self.logits(at, self.vector(at, tf)) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(rows: DataFrame) -> tuple[int, np.ndarray]:
    """(rows, rows with each bucket) over the texts of ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(BUCKETS + 1, np.int64)  # the last one counts rows
        for batch in batches:
            for text in batch.column(0).to_pylist():
                df[np.unique(buckets(text))] += 1
                df[BUCKETS] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int64()), "n": pa.array(df[at], pa.int64())})

    texts = rows.select(F.coalesce("text", F.lit("")).alias("text"))
    found = arrow_stage(texts, run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    df = np.zeros(BUCKETS + 1, np.int64)
    for bucket, n in found.collect():  # at most BUCKETS + 1 rows
        df[bucket] = n
    return int(df[BUCKETS]), df[:BUCKETS]


def inverse_frequencies(rows: int, df: np.ndarray) -> np.ndarray:
    return np.append(np.log((1 + rows) / (1 + df)) + 1, np.ones(DIMENSIONS - BUCKETS))


def fit_on(sample: DataFrame, classes: list[str], idf: np.ndarray, features: Features = counts) -> Regression | None:
    """A model learnt from a bounded ``sample`` of ``text`` and ``label``; None if it is empty.

    Texts become sparse vectors where they lie; one task trains on those, and its result
    is DIMENSIONS weights for each class.
    """

    def vectors(texts):
        found = [features(t or "") for t in texts]
        return {"features": [pickle.dumps((at.astype(np.uint16), tf.astype(np.float32))) for at, tf in found]}

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = [x for b in batches for x in zip(b.column("features").to_pylist(), b.column("label").to_pylist())]
        data.sort()  # the same order in every run
        np.random.default_rng(1).shuffle(data)
        rows = [(*pickle.loads(blob), label) for blob, label in data]
        if rows:
            model = Regression(classes, idf, features).fit([(at.astype(np.int64), tf.astype(float), c) for at, tf, c in rows])
            blob = pickle.dumps((model.weights, model.temperature))
            yield pa.RecordBatch.from_pydict({"model": pa.array([blob], pa.binary())})

    sparse = text_stage(sample.select("text", "label"), "text", "features binary", lambda: vectors)
    fitted = arrow_stage(sparse.repartition(1), fit, "model binary").collect()
    if not fitted:
        return None
    model = Regression(classes, idf, features)
    model.weights, model.temperature = pickle.loads(fitted[0]["model"])
    return model
