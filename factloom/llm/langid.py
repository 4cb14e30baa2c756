"""Language ID: a linear-chain conditional random field over the words of a text.

A word's emission scores come from hashed features: its character trigrams with its borders, its first
and last bytes (affixes) and the word itself (lexicon); the chain adds a learned score for each pair
of languages of successive words. Forward-backward gives each word the probability of each language,
so that code-switched texts are labelled word by word; a text's language is the one with the largest
sum, its score the mean over the words.

Forward-backward runs for all texts of a slice at once: chains are cut into pieces of SEGMENT words,
each piece is summarised by the product of its transfer matrices, these products carry the messages
across pieces, and the pieces are then finished side by side. This is exact.

Training takes at most ``max_rows`` whole texts (their bytes aren't bounded otherwise), joined to long chains in the order of a hash so that
languages change along them; AdaGrad on the gradient of the likelihood.

Defined cases: ``und`` and score 0 for a null text or one without a letter; letters but no word bytes
can't occur; ties take the first language in order; without training rows every text is ``und``;
repeated rows are labelled alike; an empty table gives no rows; an input column named as a new one is
replaced.
"""

from __future__ import annotations

import io
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm import textvec as tv
from factloom.llm.common import fit_in_one_task, map_texts

MAX_ROWS = 2_400
SEGMENT = 64
BITS = 18
_LETTER = tv.WORD.copy()
_LETTER[48:58] = False
_SIZE = 1 << BITS


def _index(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def word_features(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text of each word, features of each word (n x 5), features of its bytes, word ends among them)."""
    s, e, d = tv.spans(buf, off, _LETTER)
    low = np.where(_LETTER[buf], tv.LOWER[buf], 32).astype(np.uint64)
    inside = np.flatnonzero(_LETTER[buf])
    first = np.zeros(len(buf), bool)
    first[s] = True
    last = np.zeros(len(buf), bool)
    last[e - 1] = True
    before = np.where(first[inside], np.uint64(32), low[np.maximum(inside - 1, 0)])
    after = np.where(last[inside], np.uint64(32), low[np.minimum(inside + 1, max(len(buf) - 1, 0))])
    grams = _index(tv.mix((before << np.uint64(16) | low[inside] << np.uint64(8) | after) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)))
    own = [tv.hashes(buf, s, e)]
    own += [tv.mix(tv.hashes(buf, s, np.minimum(s + k, e)) + np.uint64(k)) for k in (2, 4)]
    own += [tv.mix(tv.hashes(buf, np.maximum(e - k, s), e) + np.uint64(k + 16)) for k in (2, 4)]
    return d, np.column_stack([_index(h) for h in own]) if len(s) else np.zeros((0, 5), np.int64), grams, np.cumsum(e - s)


def emissions(weights: np.ndarray, own: np.ndarray, grams: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.zeros((len(own), weights.shape[1]))
    for k in range(own.shape[1]):
        out += weights[own[:, k]]
    if len(ends):
        out += np.add.reduceat(weights[grams], np.append(0, ends[:-1]), axis=0)
    return out


def forward_backward(scores: np.ndarray, chain: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each word's label and the expected counts of label pairs within segments.

    chain is the ascending number of the chain of each word.
    """
    n, k = scores.shape
    if not n:
        return scores, np.zeros((k, k))
    e = np.exp(scores - scores.max(1, keepdims=True)) + 1e-30
    a = np.exp(trans)
    heads = np.flatnonzero(np.append(True, chain[1:] != chain[:-1]))
    length = np.diff(np.append(heads, n))
    many = -(-length // SEGMENT)
    owner = np.repeat(np.arange(len(heads)), many)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    start = heads[owner] + nth * SEGMENT
    size = np.minimum(SEGMENT, heads[owner] + length[owner] - start)
    longest = int(size.max())
    order = np.argsort(-size, kind="stable")  # longest segments first: those that reach a place are a prefix
    reach = [int(np.searchsorted(-size[order], -t, side="left")) for t in range(longest)]
    starts, opening = start[order], (nth == 0)[order]
    m = np.tile(np.eye(k), (len(order), 1, 1))
    for t in range(longest):
        r = reach[t]
        step = m[:r] @ a
        if t == 0:
            step[opening[:r]] = m[:r][opening[:r]]
        step *= e[starts[:r] + t][:, None, :]
        m[:r] = step / step.sum((1, 2), keepdims=True)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    m = m[back]
    into, out = np.full((len(order), k), 1.0 / k), np.ones((len(order), k))
    for j in range(1, int(many.max())):
        here = np.flatnonzero(nth == j)
        f = np.einsum("ij,ijk->ik", into[here - 1], m[here - 1])
        into[here] = f / f.sum(1, keepdims=True)
    for j in range(int(many.max()) - 1, 0, -1):
        here = np.flatnonzero(nth == j)
        g = np.einsum("ijk,ik->ij", m[here], out[here])
        out[here - 1] = g / g.sum(1, keepdims=True)
    into, out = into[order], out[order]
    alpha = np.empty((n, k))
    f = into
    for t in range(longest):
        r = reach[t]
        g = f[:r] @ a
        if t == 0:
            g[opening[:r]] = f[:r][opening[:r]]
        g *= e[starts[:r] + t]
        f = g / g.sum(1, keepdims=True)
        alpha[starts[:r] + t] = f
    post = np.empty((n, k))
    expected = np.zeros((k, k))
    # a segment's last word takes the message from beyond; earlier ones add their successor's
    beta = out.copy()
    for t in range(longest - 1, -1, -1):
        r = reach[t]
        at = starts[:r] + t
        p = alpha[at] * beta[:r]
        p /= p.sum(1, keepdims=True)
        post[at] = p
        if t:
            message = e[at] * beta[:r]
            joint = alpha[at - 1][:, :, None] * a * message[:, None, :]
            expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            g = message @ a.T
            beta[:r] = g / g.sum(1, keepdims=True)
    return post, expected


@dataclass
class Crf:
    """Languages in order, feature weights by language and transition scores."""

    langs: list[str]
    weights: np.ndarray
    trans: np.ndarray

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, langs=np.array(self.langs), weights=self.weights.astype(np.float32), trans=self.trans)
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Crf:
        if not data:
            return Crf([], np.zeros((_SIZE, 0)), np.zeros((0, 0)))
        z = np.load(io.BytesIO(data))
        return Crf([str(x) for x in z["langs"]], z["weights"].astype(np.float64), z["trans"])

    def words(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, posterior of each language) of each word."""
        d, own, grams, ends = word_features(buf, off)
        return d, forward_backward(emissions(self.weights, own, grams, ends), d, self.trans)[0]

    def texts(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language or -1, score) of each text."""
        n, k = len(off) - 1, len(self.langs)
        d, post = self.words(buf, off) if k else (np.zeros(0, np.int64), np.zeros((0, 0)))
        count = np.bincount(d, minlength=n)
        if not k:
            return np.full(n, -1), np.zeros(n)
        sums = np.column_stack([np.bincount(d, post[:, j], n) for j in range(k)])
        best = np.where(count > 0, sums.argmax(1), -1)
        return best, np.where(count > 0, sums.max(1) / np.maximum(count, 1), 0.0)


def fit(texts: pa.Array, langs: list[str], epochs: int = 3, batch: int = 48, rate: float = 0.25, l2: float = 1e-5) -> Crf:
    """Maximum likelihood with AdaGrad; each mini-batch of texts is one chain."""
    names = sorted(set(langs))
    y = np.array([names.index(x) for x in langs])
    k = len(names)
    w, trans = np.zeros((_SIZE, k)), np.zeros((k, k))
    gw, gt = np.full((_SIZE, k), 1e-4), np.full((k, k), 1e-4)
    for _ in range(epochs):
        for lo in range(0, len(texts), batch):
            part = texts.slice(lo, batch)
            for i, _, buf, off in tv.slices(part, 1 << 40):
                d, own, grams, ends = word_features(buf, off)
                if not len(d):
                    continue
                label = y[lo + i + d]
                post, expected = forward_backward(emissions(w, own, grams, ends), np.zeros(len(d), np.int64), trans)
                miss = -post
                miss[np.arange(len(d)), label] += 1
                inner = np.arange(1, len(d)) % SEGMENT != 0  # pairs across segments aren't counted on either side
                seen = np.bincount((label[:-1] * k + label[1:])[inner], minlength=k * k).reshape(k, k)
                of_byte = np.repeat(np.arange(len(d)), np.diff(np.append(0, ends)))
                index = np.concatenate([own.T.ravel(), grams])
                source = np.concatenate([np.tile(np.arange(len(d)), own.shape[1]), of_byte])
                touched, back = np.unique(index, return_inverse=True)
                for j in range(k):
                    g = np.bincount(back, miss[source, j], len(touched)) / np.sqrt(len(d)) - l2 * w[touched, j]
                    gw[touched, j] += g * g
                    w[touched, j] += rate * g / np.sqrt(gw[touched, j])
                g = (seen - expected) / np.sqrt(len(d)) - l2 * trans
                gt += g * g
                trans += rate * g / np.sqrt(gt)
    return Crf(names, w, trans)


def train(docs: DataFrame, keep: Column, max_rows: int = MAX_ROWS) -> Crf:
    """Fit on text and non-null lang of the documents that keep admits, those of least hash of the id.

    Of several documents of one id, the one of the least text counts.
    """
    some = docs.filter(keep & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    order = F.xxhash64("doc_id")
    ids = some.select("doc_id", order.alias("o")).distinct().orderBy("o", "doc_id").limit(max_rows)
    found = some.select("doc_id", F.lower("text").alias("text"), "lang").join(F.broadcast(ids.select("doc_id")), "doc_id")
    sample = found.groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("of")).select("doc_id", "of.text", "of.lang", order.alias("o"))

    def run(got: pa.Table) -> bytes:
        got = got.sort_by([("o", "ascending"), ("doc_id", "ascending")])
        return fit(got["text"].combine_chunks(), got["lang"].to_pylist()).dump()

    return Crf.load(fit_in_one_task(sample, run))


def _model_of(docs: DataFrame, model: Crf) -> Callable[[], Crf]:
    """What gives a task the model, loaded once."""
    shared = docs.sparkSession.sparkContext.broadcast(model.dump() if model.langs else b"")
    loaded: list[Crf] = []

    def get() -> Crf:
        if not loaded:
            loaded.append(Crf.load(shared.value))
        return loaded[0]

    return get


def _read() -> Column:
    """What is read of a text: it in lower case, nothing where it has no letter."""
    return F.when(F.col("text").rlike(r"\p{L}"), F.lower("text"))


def predict(docs: DataFrame, model: Crf) -> DataFrame:
    """docs with ``lang_pred`` and ``score``; und and 0 where the text has no letter."""
    get = _model_of(docs, model)

    def run(buf: np.ndarray, off: np.ndarray) -> dict[str, object]:
        best, score = get().texts(buf, off)
        names = np.array([*get().langs, "und"], dtype=object)
        return {"lang_pred": pa.array(names[best].tolist(), pa.string()), "score": score}

    return map_texts(docs, run, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], text=_read())


_WORD = T.StructType([T.StructField("word", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("probability", T.DoubleType())])


def label_words(docs: DataFrame, model: Crf) -> DataFrame:
    """docs with ``words``: each word of the text in lower case, in order, with its likeliest language and that one's probability."""
    get = _model_of(docs, model)

    def run(buf: np.ndarray, off: np.ndarray) -> dict[str, object]:
        s, e, d = tv.spans(buf, off, _LETTER)
        ends = pa.array(np.searchsorted(d, np.arange(len(off))).astype(np.int32))
        raw = buf.tobytes()
        words = pa.array([raw[i:j].decode() for i, j in zip(s.tolist(), e.tolist(), strict=True)], pa.string())
        if get().langs and len(s):
            post = get().words(buf, off)[1]
            lang, sure = pa.array([get().langs[i] for i in post.argmax(1)], pa.string()), pa.array(post.max(1))
        else:
            lang, sure = pa.array(["und"] * len(s), pa.string()), pa.array(np.zeros(len(s)))
        return {"words": pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([words, lang, sure], ["word", "lang", "probability"]))}

    return map_texts(docs, run, [T.StructField("words", T.ArrayType(_WORD))], text=_read())
