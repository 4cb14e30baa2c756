"""Token counts under a unigram model, by dynamic programming over a trie of distinct pre-tokens.

A text's pre-tokens are its runs of non-space bytes, each with a leading word mark. The distinct
pre-tokens of a slice of texts that a worker hasn't met before form a trie; a node is a distinct prefix, identified by its hash, and
the best score of a prefix (the sum of log probabilities of pieces that tile it) is computed once
however many pre-tokens share it, level by level for all nodes at a depth. The pieces that may end at
a node are looked up by hash. The terminal node of a pre-token holds its count of tokens, which the
worker keeps (KEPT pre-tokens at most, then it starts anew); a text's count is the sum over its pre-tokens.

Pieces come from a public tokenizer, which has ranks and no probabilities: a piece's log probability falls
with the logarithm of its rank, as Zipf's law has it. A byte that no piece covers is a token by itself at the lowest score less 10. Ties take the longer last
piece.

Defined cases: null, empty and blank texts have 0 tokens; repeated rows count alike; pre-tokens over
LONG bytes take a plain loop; an empty table gives no rows; an input column named as a new one is
replaced.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from factloom.llm import textvec as tv
from factloom.llm.common import map_texts

LONG = 200
#: Terminal counts that a worker keeps, 16 bytes each.
KEPT = 1 << 21
_MARK = "▁".encode()
_BITS = 20


@dataclass
class Pieces:
    """Sorted hashes of pieces with their log probabilities, and the lengths of pieces."""

    keys: np.ndarray
    scores: np.ndarray
    lengths: list[int]
    table: dict[bytes, float]
    lone: float

    @staticmethod
    def build(ranked: list[bytes]) -> Pieces:
        """Pieces from the most to the least frequent."""
        score = -np.log(np.arange(len(ranked)) + 2.0)
        score -= np.log(np.exp(score).sum())
        data = np.frombuffer(b"".join(ranked), np.uint8)
        ends = np.cumsum([len(p) for p in ranked])
        keys = tv.hashes(data, np.append(0, ends[:-1]), ends, lower=False)
        order = np.argsort(keys)
        return Pieces(keys[order], score[order], sorted({len(p) for p in ranked}), dict(zip(ranked, score.tolist(), strict=True)), float(score.min() - 10))

    @staticmethod
    def from_sentencepiece(path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        some = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        some.sort(key=lambda i: (-model.get_score(i), i))
        return Pieces.build([model.id_to_piece(i).encode() for i in some])

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, ranked=np.array([k.hex() for k in sorted(self.table, key=self.table.get, reverse=True)]))
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Pieces:
        return Pieces.build([bytes.fromhex(str(x)) for x in np.load(io.BytesIO(data))["ranked"]])


def count_plainly(word: bytes, pieces: Pieces) -> int:
    """Tokens of one marked pre-token by the plain recursion over its bytes."""
    best, n = [0.0], [0]
    for j in range(1, len(word) + 1):
        top, tokens = best[j - 1] + pieces.lone, n[j - 1] + 1
        for size in pieces.lengths:
            if size > j:
                break
            s = pieces.table.get(word[j - size : j])
            if s is not None and best[j - size] + s >= top:
                top, tokens = best[j - size] + s, n[j - size] + 1
        best.append(top)
        n.append(tokens)
    return n[-1]


class Counter:
    """Counts for slices of texts with one set of pieces."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(pieces.keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        self.known, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each distinct marked pre-token data[start:end]."""
        size = ends - starts
        total = int(size.sum())
        owner = np.repeat(np.arange(len(size)), size)
        place = np.arange(total) - np.repeat(np.cumsum(size) - size, size)  # bytes before in the word
        begin, stop = starts[owner], starts[owner] + place + 1
        sums = tv.prefix_sums(data, lower=False)
        prefix = tv.span_hashes(sums, begin, stop)
        _, node_at, node_of = np.unique(prefix, return_index=True, return_inverse=True)
        depth, at = place[node_at] + 1, stop[node_at]
        rank = np.argsort(depth, kind="stable")
        spot = np.empty(len(rank), np.int64)
        spot[rank] = np.arange(len(rank))
        node_of, node_at, depth, at = spot[node_of], node_at[rank], depth[rank], at[rank]
        levels = np.searchsorted(depth, np.arange(1, int(depth.max()) + 2))
        # candidate pieces: (node, ancestor, score), sorted by node
        nodes, ups, gains, spans = [], [], [], []
        for n in self.pieces.lengths:
            some = np.arange(np.searchsorted(depth, n), len(depth))
            if not len(some):
                break
            h = tv.span_hashes(sums, at[some] - n, at[some])
            hit = self.seen[(h >> np.uint64(64 - _BITS)).astype(np.int64)]
            some, h = some[hit], h[hit]
            k = np.minimum(np.searchsorted(self.pieces.keys, h), len(self.pieces.keys) - 1)
            hit = self.pieces.keys[k] == h
            some = some[hit]
            nodes.append(some)
            ups.append(np.where(depth[some] == n, -1, node_of[np.maximum(node_at[some] - n, 0)]))
            gains.append(self.pieces.scores[k[hit]])
            spans.append(np.full(len(some), n))
        every = np.arange(len(depth))
        nodes.append(every)
        ups.append(np.where(depth == 1, -1, node_of[np.maximum(node_at - 1, 0)]))
        gains.append(np.full(len(depth), self.pieces.lone))
        spans.append(np.zeros(len(depth), np.int64))
        node, up, gain, span = map(np.concatenate, (nodes, ups, gains, spans))
        order = np.lexsort((span, node))
        node, up, gain = node[order], up[order], gain[order]
        cut = np.searchsorted(node, levels)
        best, count = np.zeros(len(depth) + 1), np.zeros(len(depth) + 1, np.int64)  # the last entry is the root
        for lo, hi in zip(cut[:-1], cut[1:], strict=True):
            score = best[up[lo:hi]] + gain[lo:hi]
            own = node[lo:hi]
            heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            top = np.maximum.reduceat(score, heads)
            is_top = score == np.repeat(top, np.diff(np.append(heads, len(own))))
            last = np.maximum.reduceat(np.where(is_top, np.arange(len(own)), -1), heads)  # the longest of equals
            best[own[heads]] = top
            count[own[heads]] = count[up[lo:hi][last]] + 1
        return count[node_of[np.cumsum(size) - 1]]

    def marked(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each distinct pre-token buf[start:end], a word mark put before it."""
        size = ends - starts + len(_MARK)
        data = np.empty(int(size.sum()), np.uint8)
        stops = np.cumsum(size)
        begin = stops - size
        for k, byte in enumerate(_MARK):
            data[begin + k] = byte
        inner = np.arange(len(data)) - np.repeat(begin, size) - len(_MARK)
        take = inner >= 0
        data[take] = buf[(np.repeat(starts, size) + inner)[take]]
        count = np.zeros(len(size), np.int64)
        short = size <= LONG
        if short.any():
            count[short] = self.words(data, begin[short], stops[short])
        for i in np.flatnonzero(~short):
            count[i] = count_plainly(data[begin[i] : stops[i]].tobytes(), self.pieces)
        return count

    def __call__(self, buf: np.ndarray, off: np.ndarray) -> dict[str, object]:
        s, e, d = tv.spans(buf, off, ~tv.SPACE)
        n = len(off) - 1
        out = np.zeros(n)
        if len(s):
            h, first, back = np.unique(tv.hashes(buf, s, e, lower=False), return_index=True, return_inverse=True)
            at = np.minimum(np.searchsorted(self.known, h), max(len(self.known) - 1, 0))
            new = self.known[at] != h if len(self.known) else np.ones(len(h), bool)
            count = np.zeros(len(h), np.int64)
            count[~new] = self.counts[at[~new]]
            if new.any():
                count[new] = self.marked(buf, s[first[new]], e[first[new]])
                if len(self.known) + int(new.sum()) > KEPT:
                    self.known, self.counts = h, count
                else:
                    where = np.searchsorted(self.known, h[new])
                    self.known, self.counts = np.insert(self.known, where, h[new]), np.insert(self.counts, where, count[new])
            out = np.bincount(d, count[back], n)
        return {"n_tokens": out.astype(np.int64), "n_words": np.bincount(d, minlength=n).astype(np.int64)}


_counters: dict[int, Counter] = {}


def token_counts(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """docs with ``n_tokens`` and ``n_words`` (pre-tokens) of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces.dump())

    def run(buf: np.ndarray, off: np.ndarray) -> dict[str, object]:
        key = hash(shared.value)
        if key not in _counters:
            _counters.clear()
            _counters[key] = Counter(Pieces.load(shared.value))
        return _counters[key](buf, off)

    return map_texts(docs, run, [T.StructField("n_tokens", T.LongType()), T.StructField("n_words", T.LongType())])
