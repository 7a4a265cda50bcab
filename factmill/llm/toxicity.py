"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the hashed n-grams (``SIZES`` bytes long, ASCII lower-cased,
white space folded to one blank) of the whole text. Each is scaled by the log of its smoothed
share of toxic texts over that of others; logistic regression is fitted on the scaled
features in numpy, and only its weights (a fixed ``2 ** BITS`` floats) go to the executors.
The fit uses a bounded sample of labelled rows; labels, language, source and doc_id are
never features.

Long texts are scored by the strongest evidence of a stretch: n-grams are gathered in
overlapping windows of ``WINDOW`` bytes that cover the whole text, and the windows' greatest
logit is the text's. A toxic phrase so counts alike in a short text and in a very long one.

Defined results: null and empty texts get the score of a text without features; repeated
rows get equal scores; extra columns are ignored; without labelled rows of both classes all
scores are that class's, or 0.5 if there are none at all, and ``kept_documents``, which then has
nothing to tell toxic texts by, keeps every row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factmill.llm.labelled import TRAINING_ROWS, held_out, training_rows
from factmill.llm.scratch import bounded_texts
from factmill.llm.textkit import _LOWER, _SPACE, chunks

SIZES = (4, 6, 8)
BITS = 18
WINDOW, STEP = 512, 384
CHOICES, STEPS = 8, 15
RATE, DECAY = 0.05, 1e-4
FIT_BYTES = 1 << 19
PRIOR = 20.0
"""Documents of prior weight that pull a rare n-gram's ratio to 1."""
THRESHOLD = 0.5

_FOLD = _LOWER.copy()
_FOLD[np.flatnonzero(_SPACE)] = 0x20


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """The hashed n-gram that starts at each byte (the last size - 1 wrap into padding)."""
    padded = np.concatenate([data, np.full(size, 0x20, np.uint8)]).astype(np.uint32)
    h = np.full(len(data), size * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for k in range(size):
            h = (h ^ padded[k : k + len(data)]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
    return (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)


class Batch:
    """Some texts' n-grams, by position, and their overlapping windows."""

    def __init__(self, run: list[bytes]):
        data = _FOLD[np.frombuffer(b" " + b" ".join(run) + b" ", np.uint8)]
        lengths = np.fromiter(map(len, run), np.int64, len(run))
        begins = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
        n = np.maximum(1, -(-(lengths + 2 - (WINDOW - STEP)) // STEP))
        self.grams = [_grams(data, size) for size in SIZES]
        self.first = np.cumsum(n) - n
        text = np.repeat(np.arange(len(run)), n)
        self.start = begins[text] + (np.arange(len(text)) - self.first[text]) * STEP
        self.end = np.minimum(self.start + WINDOW, begins[text] + lengths[text] + 2)

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """For each window, the sum of the weights of the n-grams that lie inside."""
        total = np.zeros(len(self.start))
        for size, gram in zip(SIZES, self.grams, strict=True):
            upto = np.concatenate([[0.0], np.cumsum(weights[gram], dtype=np.float64)])
            total += upto[np.maximum(self.end - size + 1, self.start)] - upto[self.start]
        return total

    def top(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each text's greatest window sum, and that window."""
        sums = self.sums(weights)
        best = np.maximum.reduceat(sums, self.first)
        of = np.searchsorted(self.first, np.arange(len(sums)), side="right") - 1
        hit = np.flatnonzero(sums >= best[of])
        return best, hit[np.unique(of[hit], return_index=True)[1]]

    def features(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The features of the windows given, end to end, and the place in the list of each one's window."""
        out, own = [], []
        for size, gram in zip(SIZES, self.grams, strict=True):
            n = np.maximum(self.end[windows] - size + 1 - self.start[windows], 0)
            which = np.repeat(np.arange(len(windows)), n)
            at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + self.start[windows][which]
            out.append(gram[at])
            own.append(which)
        return np.concatenate(out), np.concatenate(own)


class Model:
    """Weights of all hashed n-grams (ratio times fitted coefficient) and a bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    @property
    def informed(self) -> bool:
        """Whether it was fitted on both classes."""
        return bool(self.weights.any())

    @classmethod
    def fit(cls, texts: list[str], labels: list[int]) -> Model:
        """Log-count ratios over documents, then logistic regression on each document's top window.

        The top window is chosen anew every few steps under the weights so far (as in
        multiple-instance learning); between choices the fit is convex.
        """
        dim = 1 << BITS
        y = np.asarray(labels, np.float64)
        if not len(y) or y.min() == y.max():
            return cls(np.zeros(dim, np.float32), 0.0 if not len(y) else (-20.0, 20.0)[int(y[0])])
        batches = [Batch(run) for run in chunks(texts, FIT_BYTES)]
        counts, at = np.zeros((2, dim)), 0
        for batch in batches:
            owner = np.repeat(np.arange(len(batch.first)), np.diff(np.concatenate([batch.first, [len(batch.start)]])))
            feature, window = batch.features(np.arange(len(batch.start)))
            pairs = np.sort((owner[window] << BITS) | feature)
            pairs = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])]
            toxic = y[at + (pairs >> BITS)] == 1
            for t in (0, 1):
                counts[t] += np.bincount((pairs & (dim - 1))[toxic == t], minlength=dim)
            at += len(batch.first)
        share = [(counts[t] + PRIOR * np.mean(y == t)) / (np.sum(y == t) + PRIOR * np.mean(y == t)) for t in (0, 1)]
        ratio = np.log(share[1] / share[0])
        balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        coef, bias = np.full(dim, 0.02), -1.0
        moment, moment_b = np.zeros(dim), 0.0
        for _ in range(CHOICES):
            feature, owner = cls._tops(batches, coef * ratio)
            for _ in range(STEPS):
                logit = np.bincount(owner, (coef * ratio)[feature], len(y)) + bias
                error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) * balance / len(y)
                moment = 0.9 * moment + np.bincount(feature, error[owner], dim) * ratio + DECAY * coef
                moment_b = 0.9 * moment_b + error.sum()
                coef = coef - RATE * moment
                bias -= 10 * RATE * moment_b
        return cls((coef * ratio).astype(np.float32), float(bias))

    @staticmethod
    def _tops(batches: list[Batch], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The features of every text's top window, and the number of the text."""
        features, owners, at = [], [], 0
        for batch in batches:
            feature, owner = batch.features(batch.top(weights)[1])
            features.append(feature)
            owners.append((owner + at).astype(np.int32))
            at += len(batch.first)
        return np.concatenate(features), np.concatenate(owners)

    def scores(self, texts) -> np.ndarray:
        out = []
        for run in chunks(texts, FIT_BYTES):
            logit = Batch(run).top(self.weights)[0] + self.bias
            out.append(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)


def fitted(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    return Model.fit(*training_rows(docs, labels, "toxic", rows))


def score(docs: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """``docs`` with a column of scores."""
    bounded_texts(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Model(*shared.value)
        for batch in texts:
            yield pd.Series(own.scores(batch))

    return docs.withColumn(into, scored("text"))


def op9(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns."""
    rows = score(docs.select("doc_id", "text"), fitted(docs, labels))
    return rows.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected as toxic; all of them if no model can be fitted."""
    model = fitted(docs, labels)
    if not model.informed:
        return docs
    return score(docs, model, "__toxicity").where(F.col("__toxicity") < THRESHOLD).drop("__toxicity")
