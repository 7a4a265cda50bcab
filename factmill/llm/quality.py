"""Quality: a byte-level convolutional network in numpy.

The whole text is cut into chunks of ``CHUNK`` bytes that overlap by ``OVERLAP``. Learned
filters ``WIDTH`` bytes wide read every second position of a chunk; each filter's greatest
response is the chunk's max-pooled feature. A tanh layer combines a chunk's features, the
mean and the maximum over all chunks of that layer describe the text, and a logistic unit
gives one probability. Only the parameters (a fixed size) go to the executors.

The fit uses a bounded sample of labelled rows; labels, language, source and doc_id are
never inputs of a score.

Defined results: null and empty texts are one chunk of padding; repeated rows get equal
scores; extra columns are ignored; without labelled rows of both classes all scores are 0
or 1 (the only class), or 0.5 if there are none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factmill.llm.labelled import held_out, training_rows
from factmill.llm.scratch import bounded_texts
from factmill.llm.textkit import chunks

CHUNK, OVERLAP, WIDTH, STRIDE = 512, 32, 8, 2
FILTERS, HIDDEN = 16, 12
EPOCHS, BATCH, RATE = 24, 32, 0.01
TRAINING_ROWS = 1600
THRESHOLD = 0.3
_POSITIONS = (CHUNK - WIDTH) // STRIDE + 1


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All chunks as rows of bytes (zeros at a text's end), and each text's first chunk."""
    step = CHUNK - OVERLAP
    n = [max(1, -(-(len(t) - OVERLAP) // step)) for t in texts]
    first = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    out = np.zeros((first[-1], CHUNK), np.uint8)
    for i, text in enumerate(texts):
        own = np.frombuffer(text, np.uint8)
        whole = (len(own) - CHUNK) // step + 1 if len(own) >= CHUNK else 0
        if whole:
            out[first[i] : first[i] + whole] = np.lib.stride_tricks.sliding_window_view(own, CHUNK)[:: step][:whole]
        for k in range(whole, n[i]):
            part = own[k * step : k * step + CHUNK]
            out[first[i] + k, : len(part)] = part
    return out, first


class Network:
    """Parameters by name: taps (WIDTH, 256, FILTERS), bias, w1, b1, w2, b2."""

    def __init__(self, params: dict[str, np.ndarray]):
        self.p = params

    @classmethod
    def fresh(cls, seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        return cls({
            "taps": draw(WIDTH, 256, FILTERS, scale=0.25), "bias": np.zeros(FILTERS, np.float32),
            "w1": draw(FILTERS, HIDDEN, scale=0.25), "b1": np.zeros(HIDDEN, np.float32),
            "w2": draw(2 * HIDDEN, scale=0.25), "b2": np.zeros(1, np.float32),
        })

    def pairs(self) -> np.ndarray:
        """The filters' responses to each pair of neighbouring bytes: (WIDTH / 2, 65536, FILTERS)."""
        taps = self.p["taps"]
        return np.stack([(taps[2 * j][:, None, :] + taps[2 * j + 1][None, :, :]).reshape(-1, FILTERS) for j in range(WIDTH // 2)])

    @staticmethod
    def respond(chunks: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """(chunks, positions, FILTERS) before bias."""
        code = np.ascontiguousarray(chunks).view(">u2").astype(np.intp)  # bytes 2k, 2k+1
        out = pairs[0][code[:, :_POSITIONS]]
        for j in range(1, WIDTH // 2):
            out += pairs[j][code[:, j : j + _POSITIONS]]
        return out

    def pool(self, chunks: np.ndarray) -> np.ndarray:
        """Max-pooled features, worked out in slices that stay in cache."""
        pairs = self.pairs()
        return np.concatenate([self.respond(chunks[i : i + 32], pairs).max(axis=1) for i in range(0, len(chunks), 32)])

    def combine(self, pooled: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        hidden = np.tanh(np.maximum(pooled + self.p["bias"], 0) @ self.p["w1"] + self.p["b1"])
        n = np.diff(first)[:, None]
        mean = np.add.reduceat(hidden, first[:-1], axis=0) / n
        most = np.maximum.reduceat(hidden, first[:-1], axis=0)
        both = np.concatenate([mean, most], axis=1)
        return hidden, most, both, 1 / (1 + np.exp(-np.clip(both @ self.p["w2"] + self.p["b2"], -30, 30)))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        chunks, first = cut(texts)
        return self.combine(self.pool(chunks), first)[-1]

    def gradients(self, chunks: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Back-propagation; the max lets only each filter's best position through."""
        answer = np.concatenate([self._best(chunks[i : i + 64]) for i in range(0, len(chunks), 64)], axis=1)
        pooled, where = answer[0], answer[1].astype(np.int64)
        hidden, most, both, p = self.combine(pooled, first)
        g_out = (p - y) * weight
        n = np.diff(first)
        owner = np.repeat(np.arange(len(y)), n)
        g_both = g_out[:, None] * self.p["w2"]
        g_hidden = g_both[owner, :HIDDEN] / n[owner, None] + g_both[owner, HIDDEN:] * (hidden == most[owner])
        g_sum = g_hidden * (1 - hidden**2)
        raised = np.maximum(pooled + self.p["bias"], 0)
        g_pool = (g_sum @ self.p["w1"].T) * (raised > 0)
        taps = np.empty_like(self.p["taps"])
        of, filters = np.arange(len(chunks))[:, None], np.arange(FILTERS)[None, :]
        for j in range(WIDTH):
            code = chunks[of, where * STRIDE + j].astype(np.int64) * FILTERS + filters
            taps[j] = np.bincount(code.ravel(), g_pool.ravel(), 256 * FILTERS).reshape(256, FILTERS)
        return {"taps": taps, "bias": g_pool.sum(0), "w1": raised.T @ g_sum, "b1": g_sum.sum(0), "w2": both.T @ g_out, "b2": g_out.sum(keepdims=True)}

    def _best(self, chunks: np.ndarray) -> np.ndarray:
        taps, answers = self._pairs_now, []
        answers = self.respond(chunks, taps)
        where = answers.argmax(axis=1)
        return np.stack([np.take_along_axis(answers, where[:, None, :], 1)[:, 0, :], where.astype(np.float32)])

    @classmethod
    def fit(cls, texts: list[bytes], labels: list[int], seed: int = 3) -> Network:
        """Adam on small batches of whole training texts, classes weighted evenly."""
        net, rng = cls.fresh(), np.random.default_rng(seed)
        y = np.asarray(labels, np.float32)
        if not len(y) or y.min() == y.max():
            net.p["w2"][:] = 0
            net.p["b2"][:] = 0 if not len(y) else (-20, 20)[int(y[0])]
            return net
        chunks, first = cut(texts)
        share = y.mean()
        weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        m = {k: np.zeros_like(v) for k, v in net.p.items()}
        v = {k: np.zeros_like(x) for k, x in net.p.items()}
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(y))
            for at in range(0, len(y), BATCH):
                own = order[at : at + BATCH]
                n = first[own + 1] - first[own]
                rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in own])
                net._pairs_now = net.pairs()
                g = net.gradients(chunks[rows], np.concatenate([[0], np.cumsum(n)]), y[own], weight[own] / len(own))
                step += 1
                rate = RATE * (1 - 0.9 * epoch / EPOCHS)
                for k, x in net.p.items():
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    x -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
                net.p["taps"] *= 1 - 0.02 * rate
        return net


def fitted(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Network:
    texts, y = training_rows(docs, labels, "quality", rows)
    return Network.fit([t.encode("utf-8", "surrogatepass") for t in texts], y)


def score(docs: DataFrame, network: Network) -> DataFrame:
    """``docs`` with a column score."""
    bounded_texts(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(network.p)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Network(shared.value)
        for batch in batches:
            yield pd.Series(np.concatenate([own.scores(run) for run in chunks(batch)]) if len(batch) else np.zeros(0))

    return docs.withColumn("score", scored("text"))


def op3(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns."""
    rows = score(docs.select("doc_id", "text"), fitted(docs, labels))
    return rows.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), F.col("score").cast("double").alias("score"), (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
