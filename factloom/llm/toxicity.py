"""Toxicity: FTRL-proximal logistic regression over hashed words, word pairs and skip-grams.

Features of a text are the distinct 32-bit hashes of its words, of their stems, of adjacent words and
of words one place apart, each with the value 1. Training goes over mini-batches with a rate for each coordinate
and an L1 penalty that leaves most weights at exactly 0; the others, a few thousand, are sorted by
hash and travel with the scoring tasks. Features seen in fewer than ``min_docs`` training texts get
no weight.

Fitting takes at most ``max_rows`` labelled texts; scoring is a map over whole texts.

Defined cases: null and empty texts have no features and score as the intercept; repeated rows score
alike; an empty table gives no rows; without training rows each score is 0.5; an input column named
as a new one is replaced.
"""

from __future__ import annotations

import io
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from factloom.llm import textvec as tv
from factloom.llm.common import fit_in_one_task, labelled_sample, map_texts

MAX_ROWS = 16_000
#: A longer word also counts by its first so many bytes, so that inflected forms share a weight.
STEMS = (4, 6)
_FILTER_BITS = 20


def features(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every word, stem, adjacent pair and skip pair, with repetitions."""
    s, e, d = tv.spans(buf, off, tv.WORD)
    h = tv.hashes(buf, s, e)
    stems = [(d[long], tv.hashes(buf, s[long], s[long] + k)) for k in STEMS for long in [np.flatnonzero(e - s > k)]]
    d1, h1 = tv.pairs(d, h, 1)
    d2, h2 = tv.pairs(d, h, 2)
    parts = [(d, h), (d1, h1), (d2, h2), *stems]
    return np.concatenate([x for x, _ in parts]), np.concatenate([(x >> np.uint64(32)).astype(np.uint32) for _, x in parts])


def _once(d: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    head = np.ones(len(h), bool)
    head[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return d[head], h[head]


@dataclass
class Weights:
    """Sorted hashes with non-zero weight, their weights and the intercept."""

    keys: np.ndarray
    values: np.ndarray
    bias: float
    _seen: np.ndarray | None = field(default=None, repr=False)

    def margin(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        n = len(off) - 1
        if not len(self.keys):
            return np.full(n, self.bias)
        if self._seen is None:
            self._seen = np.zeros(1 << _FILTER_BITS, bool)
            self._seen[(self.keys >> np.uint32(32 - _FILTER_BITS)).astype(np.int64)] = True
        d, h = features(buf, off)
        hit = self._seen[(h >> np.uint32(32 - _FILTER_BITS)).astype(np.int64)]
        d, h = d[hit], h[hit]
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        hit = self.keys[at] == h
        d, at = _once(d[hit], at[hit])
        return self.bias + np.bincount(d, self.values[at], n)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, keys=self.keys, values=self.values, bias=self.bias)
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Weights:
        if not data:
            return Weights(np.zeros(0, np.uint32), np.zeros(0), 0.0)
        z = np.load(io.BytesIO(data))
        return Weights(z["keys"], z["values"], float(z["bias"]))


def ftrl(docs: list[np.ndarray], y: np.ndarray, n: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 5.0, l2: float = 0.01, epochs: int = 5, batch: int = 32, seed: int = 7) -> tuple[np.ndarray, float]:
    """Follow the regularised leader, proximal form: weights of n binary features and the intercept.

    z gathers gradients less what the moving weight accounts for, q their squares; a coordinate's rate
    is alpha / (beta + sqrt(q)), and its weight is 0 while |z| <= l1. The intercept isn't penalised.
    """
    z, q, w = np.zeros(n), np.zeros(n), np.zeros(n)
    bias, bias_q = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))), 0.0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            some = order[lo : lo + batch]
            index = np.concatenate([docs[i] for i in some])
            row = np.repeat(np.arange(len(some)), [len(docs[i]) for i in some])
            p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(row, w[index], len(some)), -35, 35)))
            miss = p - y[some]
            bias_q += miss.sum() ** 2
            bias -= alpha / (beta + np.sqrt(bias_q)) * miss.sum()
            touched, back = np.unique(index, return_inverse=True)
            g = np.bincount(back, miss[row], len(touched))
            root, grown = np.sqrt(q[touched]), q[touched] + g * g
            z[touched] += g - (np.sqrt(grown) - root) / alpha * w[touched]
            q[touched] = grown
            zt = z[touched]
            w[touched] = np.where(np.abs(zt) <= l1, 0.0, (np.sign(zt) * l1 - zt) / ((beta + np.sqrt(grown)) / alpha + l2))
    return w, bias


def train(docs: DataFrame, labels: DataFrame, keep: Column, target: str = "toxic", max_rows: int = MAX_ROWS, min_docs: int = 4) -> Weights:
    """Fit on the labelled documents that ``keep`` (a condition on labels.doc_id) admits."""
    sample = labelled_sample(docs, labels, target, keep, max_rows)

    def hashed(buf: np.ndarray, off: np.ndarray) -> dict[str, object]:
        d, h = _once(*features(buf, off))
        ends = np.searchsorted(d, np.arange(len(off)))
        return {"features": [h[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]}

    def run(got: pa.Table) -> bytes:
        order = np.argsort(np.array(got["doc_id"]), kind="stable")
        rows = [np.frombuffer(x.as_py(), np.uint32) for x in got["features"]]
        rows, y = [rows[i] for i in order], np.array(got["y"], float)[order]
        size = np.array([len(r) for r in rows])
        keys, count = np.unique(np.concatenate(rows) if rows else np.zeros(0, np.uint32), return_counts=True)
        keys = keys[count >= min_docs]
        if not len(keys):
            return Weights(np.zeros(0, np.uint32), np.zeros(0), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))).dump()
        for i in np.flatnonzero(size):
            at = np.minimum(np.searchsorted(keys, rows[i]), len(keys) - 1)
            rows[i] = at[keys[at] == rows[i]].astype(np.int32)
        rows = [r.astype(np.int32) for r in rows]
        w, bias = ftrl(rows, y, len(keys))
        live = w != 0
        return Weights(keys[live], w[live], bias).dump()

    vectors = map_texts(sample, hashed, [T.StructField("features", T.BinaryType())], keep=["doc_id", "y"])
    return Weights.load(fit_in_one_task(vectors, run))


def score(docs: DataFrame, model: Weights, threshold: float = 0.3, score_col: str = "score", predicted_col: str = "predicted") -> DataFrame:
    """docs with a score (0 to 1, higher: more likely toxic) and a prediction (1 where score >= threshold)."""
    plain = Weights(model.keys, model.values, model.bias)

    def run(buf: np.ndarray, off: np.ndarray) -> dict[str, object]:
        s = 1 / (1 + np.exp(-np.clip(plain.margin(buf, off), -35, 35)))
        return {score_col: s, predicted_col: (s >= threshold).astype(np.int32)}

    return map_texts(docs, run, [T.StructField(score_col, T.DoubleType()), T.StructField(predicted_col, T.IntegerType())])
