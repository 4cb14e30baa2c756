"""Quality classifier: a generalised additive model with pairwise interactions over text statistics.

Each text becomes a few numeric features. Cyclic gradient boosting goes round the features and fits
one shallow tree at a time on the feature's histogram of gradients; the trees of a feature add up to
a lookup table over its bins. The strongest pairs then get two-dimensional tables the same way. A
score is the sigmoid of the sum of table entries, read by vectorised bin lookups.

Fitting takes at most ``max_rows`` labelled texts (the bound of fit_in_one_task); scoring is a map
over whole texts without a shuffle, with a model of a few hundred kilobytes.

Defined cases: a null or empty text has all features 0 and gets a score like any other; repeated rows
get equal scores; an empty table gives no rows; without any training rows each score is the prior 0.5;
an input column named as a new one is replaced.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from factloom.llm import textvec as tv
from factloom.llm.common import fit_in_one_task, labelled_sample, map_texts

MAX_ROWS = 20_000


def _per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return (sums[off[1:]] - sums[off[:-1]]).astype(np.float64)


def _classes() -> np.ndarray:
    """Byte classes as bits: upper, digit, symbol, exclamation and such, bar, newline, non-ASCII."""
    t = np.zeros(256, np.uint8)
    t[65:91] = 1
    t[48:58] = 2
    t[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,'\"-|!"]] = 4
    t[[ord("!"), ord("?")]] = 8
    t[ord("|")] = 16
    t[10] = 32
    t[128:] = 64
    return t


_CLASS = _classes()
FEATURES = (
    "log_bytes", "log_words", "mean_word", "sd_word", "longest_word", "distinct_share", "adjacent_repeat",
    "pair_distinct_share", "top_word_share", "upper", "digit", "symbol", "exclaim", "bar", "newline",
    "non_ascii", "short_words", "line_distinct_share", "punct_ends", "all_upper_words",
)


def _distinct(d: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes and the largest multiplicity in each text."""
    if not len(h):
        return np.zeros(n), np.zeros(n)
    d, h = tv.by_text(d, h)
    head = np.ones(len(h), bool)
    head[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(head)
    size = np.diff(np.append(at, len(h)))
    top = np.zeros(n)
    np.maximum.at(top, d[at], size)
    return np.bincount(d[at], minlength=n).astype(float), top


def features(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text of a slice."""
    n = len(off) - 1
    size = np.diff(off).astype(np.float64)
    c = _CLASS[buf]
    share = lambda bit: _per_text(c & bit != 0, off) / np.maximum(size, 1)
    s, e, d = tv.spans(buf, off, ~tv.SPACE)
    h = tv.hashes(buf, s, e)
    count = np.bincount(d, minlength=n).astype(float)
    many = np.maximum(count, 1)
    length = (e - s).astype(np.float64)
    mean = np.bincount(d, length, n) / many
    var = np.maximum(np.bincount(d, length**2, n) / many - mean**2, 0)
    longest = np.zeros(n)
    np.maximum.at(longest, d, length)
    distinct, top = _distinct(d, h, n)
    same = np.bincount(d[1:][(d[1:] == d[:-1]) & (h[1:] == h[:-1])], minlength=n) if len(h) else np.zeros(n)
    pd, ph = tv.pairs(d, h, 1)
    pairs = np.maximum(np.bincount(pd, minlength=n), 1)
    pair_distinct = np.where(count > 1, _distinct(pd, ph, n)[0] / pairs, 1.0)
    ls, le, ld = tv.spans(buf, off, np.arange(256) != 10)
    lines = np.maximum(np.bincount(ld, minlength=n), 1)
    line_distinct = np.where(lines > 1, _distinct(ld, tv.hashes(buf, ls, le), n)[0] / lines, 1.0)
    last = buf[np.maximum(e - 1, 0)] if len(e) else e
    ends = np.bincount(d[~tv.WORD[last]], minlength=n) / many if len(e) else np.zeros(n)
    upper = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(c & 1, out=upper[1:])
    shout = np.bincount(d[(upper[e] - upper[s] >= 2)], minlength=n) / many if len(e) else np.zeros(n)
    short = np.bincount(d[length <= 3], minlength=n) / many
    x = np.column_stack([
        np.log1p(size), np.log1p(count), mean, np.sqrt(var), np.log1p(longest), np.where(count > 0, distinct / many, 1.0),
        same / many, pair_distinct, top / many, share(1), share(2), share(4), share(8), share(16), share(32),
        share(64), short, line_distinct, ends, shout,
    ])
    x[count == 0] = 0.0
    return x


@dataclass
class Gam:
    """Bin edges, one table of log odds for each feature and for each chosen pair, and the intercept."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    tables: np.ndarray
    pairs: list[tuple[int, int]]
    pair_tables: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for f, edge in enumerate(self.edges):
            out += self.tables[f][np.searchsorted(edge, x[:, f], side="right")]
        bins = {f: np.searchsorted(self.coarse[f], x[:, f], side="right") for p in self.pairs for f in p}
        for (a, b), t in zip(self.pairs, self.pair_tables, strict=True):
            out += t[bins[a], bins[b]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -35, 35)))

    def dump(self) -> bytes:
        out = io.BytesIO()
        many = {f"e{i}": v for i, v in enumerate(self.edges)} | {f"c{i}": v for i, v in enumerate(self.coarse)}
        np.savez(out, tables=self.tables, pairs=np.array(self.pairs, np.int64).reshape(-1, 2), pair_tables=self.pair_tables, base=self.base, **many)
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Gam:
        if not data:
            return Gam([], [], np.zeros((0, 1)), [], np.zeros((0, 1, 1)), 0.0)
        z = np.load(io.BytesIO(data))
        n = len(z["tables"])
        return Gam([z[f"e{i}"] for i in range(n)], [z[f"c{i}"] for i in range(n)], z["tables"], [tuple(p) for p in z["pairs"].tolist()], z["pair_tables"], float(z["base"]))


def _shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int, l2: float, least: float) -> np.ndarray:
    """Newton steps by bin, constant within at most ``leaves`` runs of bins; splits are greedy."""
    gs, hs = np.append(0, np.cumsum(g)), np.append(0, np.cumsum(h))
    cuts = [0, len(g)]
    for _ in range(leaves - 1):
        best, where = 1e-9, None
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a < 2:
                continue
            m = np.arange(a + 1, b)
            gl, hl, gr, hr = gs[m] - gs[a], hs[m] - hs[a], gs[b] - gs[m], hs[b] - hs[m]
            gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - (gs[b] - gs[a]) ** 2 / (hs[b] - hs[a] + l2)
            gain[(hl < least) | (hr < least)] = 0
            if gain.max() > best:
                best, where = gain.max(), m[gain.argmax()]
        if where is None:
            break
        cuts = sorted([*cuts, int(where)])
    out = np.zeros(len(g))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out[a:b] = (gs[b] - gs[a]) / (hs[b] - hs[a] + l2)
    return out


def _four_leaves(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """The best tree of one cut on each axis: its gain and its table of steps."""
    gs, hs = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    tot_g, tot_h = gs[-1, -1], hs[-1, -1]
    r_g, r_h, c_g, c_h = gs[:, -1:], hs[:, -1:], gs[-1:, :], hs[-1:, :]
    q = [(gs, hs), (r_g - gs, r_h - hs), (c_g - gs, c_h - hs), (tot_g - r_g - c_g + gs, tot_h - r_h - c_h + hs)]
    gain = sum(a**2 / (np.maximum(b, 0) + l2) for a, b in q)[:-1, :-1]
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    step = [a[i, j] / (max(b[i, j], 0) + l2) for a, b in q]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = step
    return float(gain[i, j] - tot_g**2 / (tot_h + l2)), out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, coarse: int = 16, rounds: int = 120, n_pairs: int = 12, pair_rounds: int = 60, rate: float = 0.15, leaves: int = 4, l2: float = 1.0) -> Gam:
    """Cyclic boosting of feature tables, then of the tables of the pairs with the largest gain."""
    if not len(y):
        return Gam.load(b"")
    cut = lambda v, n: np.unique(np.quantile(v, np.linspace(0, 1, n + 1)[1:-1]))
    edges, rough = [cut(v, bins) for v in x.T], [cut(v, coarse) for v in x.T]
    at = [np.searchsorted(e, v, side="right") for e, v in zip(edges, x.T, strict=True)]
    at2 = [np.searchsorted(e, v, side="right") for e, v in zip(rough, x.T, strict=True)]
    tables = np.zeros((x.shape[1], bins + 1))
    rate_of = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate_of / (1 - rate_of)))
    f = np.full(len(y), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-f))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for k in range(x.shape[1]):
            g, h = slopes()
            step = rate * _shallow_tree(np.bincount(at[k], g, bins + 1), np.bincount(at[k], h, bins + 1), leaves, l2, 2.0)
            tables[k] += step
            f += step[at[k]]
    wide = coarse + 1
    hist = lambda a, b, v: np.bincount(at2[a] * wide + at2[b], v, wide * wide).reshape(wide, wide)
    g, h = slopes()
    ranked = sorted(((_four_leaves(hist(a, b, g), hist(a, b, h), l2)[0], a, b) for a in range(x.shape[1]) for b in range(a)), reverse=True)
    pairs = [(a, b) for gain, a, b in ranked[:n_pairs] if gain > 0]
    pair_tables = np.zeros((len(pairs), wide, wide))
    for _ in range(pair_rounds):
        for i, (a, b) in enumerate(pairs):
            g, h = slopes()
            step = rate * _four_leaves(hist(a, b, g), hist(a, b, h), l2)[1]
            pair_tables[i] += step
            f += step[at2[a], at2[b]]
    return Gam(edges, rough, tables, pairs, pair_tables, base)


_ROW = [T.StructField("features", T.ArrayType(T.DoubleType()))]


def train(docs: DataFrame, labels: DataFrame, keep: Column, target: str = "quality", max_rows: int = MAX_ROWS) -> Gam:
    """Fit on the labelled documents that ``keep`` (a condition on labels.doc_id) admits."""
    sample = labelled_sample(docs, labels, target, keep, max_rows)
    vectors = map_texts(sample, lambda buf, off: {"features": list(features(buf, off))}, _ROW, keep=["doc_id", "y"])

    def run(got: pa.Table) -> bytes:
        got = got.sort_by("doc_id")
        x = np.array(got["features"].to_pylist(), float)
        return fit(x, np.array(got["y"], float)).dump()

    return Gam.load(fit_in_one_task(vectors, run))


def score(docs: DataFrame, model: Gam, threshold: float = 0.5, score_col: str = "score", predicted_col: str = "predicted") -> DataFrame:
    """docs with a score (0 to 1) and a prediction (1 where score >= threshold)."""

    def run(buf: np.ndarray, off: np.ndarray) -> dict[str, object]:
        s = model.score(features(buf, off))
        return {score_col: s, predicted_col: (s >= threshold).astype(np.int32)}

    return map_texts(docs, run, [T.StructField(score_col, T.DoubleType()), T.StructField(predicted_col, T.IntegerType())])
