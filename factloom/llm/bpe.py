"""BPE encoding by speculation and verification, and decoding.

For a vocabulary with word ends (lower-cased text, white space dropped). The distinct words that a task
hasn't met yet are laid end to end; an automaton proposes the greedy longest-match tokens; a vectorised
test then tells for every adjacent pair of tokens whether BPE could have left this pair side by side. A
row of tokens that each encode to themselves and whose neighbours are all compatible is the encoding;
only the words with an incompatible pair go through exact merging.

A pair (x, y) is compatible if no merge across its border gets its turn before the merges inside. Going
backwards in time along the right spine of x and the left spine of y, a merge of the two symbols at the
border happens if its rank is below the rank at which one of them is swallowed (at equal rank, the
leftmost merge goes first).

All of it is a map over whole texts without a shuffle; the vocabulary (a few MB) is broadcast.

Defined cases: a null text counts as empty and has no tokens; special tokens written out in a text
become their ids; repeated rows encode alike; an empty table gives no rows; an input column named as a
new one is replaced.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from dataclasses import dataclass, field
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from factloom.llm.common import map_texts

#: Words kept with their tokens in each Python worker; beyond it the store starts anew.
CACHE_WORDS = 300_000
#: Words of more bytes are merged one by one with a heap, in n log n steps.
LONG_WORD = 64
_NEVER = 1 << 30


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself where it's
    printable Latin-1, else the next unused one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    out |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in out)}
    return [out[b] for b in range(256)]


@dataclass
class Vocabulary:
    """Tables of one tokenizer: merge ranks, spines, and the tokens as strings."""

    tokens: list[str]
    specials: dict[str, int]
    word_end: str
    split: str
    merges: dict[tuple[int, int], int]
    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray
    keys: np.ndarray = field(repr=False)
    key_ranks: np.ndarray = field(repr=False)
    plain: np.ndarray = field(repr=False)  # symbol of each byte inside a word
    final: np.ndarray = field(repr=False)  # symbol of each byte that ends a word

    @staticmethod
    def parse(raw: bytes) -> Vocabulary:
        spec = json.loads(raw)
        model, end = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab = model["vocab"]
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [""] * (1 + max(*vocab.values(), *specials.values()))
        for s, i in [*vocab.items(), *specials.items()]:
            tokens[i] = s
        n = len(tokens)
        rank, left, right = np.full(n, -1, np.int64), np.arange(n), np.arange(n)
        merges = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            if (x, y) not in merges:
                merges[x, y] = z
                if rank[z] < 0:
                    rank[z], left[z], right[z] = r, x, y
        keys = np.array([x * n + y for x, y in merges], np.int64)
        order = np.argsort(keys)
        ranks = np.array([rank[z] for z in merges.values()], np.int64)
        letters = byte_symbols()
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        return Vocabulary(
            tokens, specials, end, pattern, merges, rank, left, right, keys[order], ranks[order],
            np.array([vocab[c] for c in letters]), np.array([vocab[c + end] for c in letters]),
        )

    def pair_rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Rank of the merge of x and y, or a very large number."""
        key = x * len(self.tokens) + y
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_ranks[at], _NEVER)

    def compatible(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether BPE leaves x and y side by side; with limit, whether it does until that rank's turn."""
        x, y = x.copy(), y.copy()
        until = np.full(len(x), _NEVER, np.int64) if limit is None else limit.copy()
        ok, live = np.ones(len(x), bool), np.arange(len(x))
        while len(live):
            a, b = x[live], y[live]
            crossing = self.pair_rank(a, b) < until[live]
            ok[live[crossing]] = False
            # undo the later of the two merges that made the symbols at the border
            ra, rb = self.rank[a], self.rank[b]
            go = ~crossing & (np.maximum(ra, rb) >= 0)
            undo_left = go & (ra > rb)
            undo_right = go & ~undo_left
            until[live[undo_left]] = ra[undo_left]  # at equal rank the merge further left has had its turn
            until[live[undo_right]] = rb[undo_right] + 1
            x[live[undo_left]] = self.right[a[undo_left]]
            y[live[undo_right]] = self.left[b[undo_right]]
            live = live[go]
        return ok

    def exact(self, symbols: list[int]) -> list[int]:
        """Merge the lowest-ranked pair, leftmost first, until none is left."""
        merges, rank = self.merges, self.rank
        n = len(symbols)
        ids, after, before = list(symbols), [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(int(rank[z]), i, ids[i], ids[i + 1]) for i in range(n - 1) if (z := merges.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, x, y = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or ids[i] != x or ids[j] != y:
                continue
            ids[i], ids[j] = merges[x, y], -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (z := merges.get((ids[i], ids[k]))) is not None:
                    heapq.heappush(heap, (int(rank[z]), i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (z := merges.get((ids[h], ids[i]))) is not None:
                heapq.heappush(heap, (int(rank[z]), h, ids[h], ids[i]))
        return [i for i in ids if i >= 0]

    def exact_many(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """exact() for many short words at once: one merge in each unfinished word a round.

        symbols holds the words' symbols in a row, word the ascending number of each symbol's word.
        """
        rank_next = np.append(np.where(word[1:] == word[:-1], self.pair_rank(symbols[:-1], symbols[1:]), _NEVER), _NEVER)
        done_symbols, done_words = [], []
        made_by = np.flatnonzero(self.rank >= 0)
        made_by = made_by[np.argsort(self.rank[made_by])]  # the token of each merge rank
        while len(symbols):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            size = np.diff(np.append(starts, len(word)))
            low = np.minimum.reduceat(rank_next, starts)
            spread = np.repeat(low, size)
            over = spread == _NEVER
            if over.any():
                done_symbols.append(symbols[over])
                done_words.append(word[over])
                symbols, word, rank_next, spread = symbols[~over], word[~over], rank_next[~over], spread[~over]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank_next == spread)
            at = at[np.append(True, word[at[1:]] != word[at[:-1]])]
            symbols[at] = made_by[rank_next[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            new_at = at - np.arange(len(at))
            symbols, word, rank_next = symbols[keep], word[keep], rank_next[keep]
            for left in (new_at, new_at[new_at > 0] - 1):
                right = np.minimum(left + 1, len(symbols) - 1)
                same = (word[left] == word[right]) & (left < right)
                rank_next[left] = np.where(same, self.pair_rank(symbols[left], symbols[right]), _NEVER)
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]


#: In lower-cased text of ASCII and Latin letters only, the classes of the split pattern are plain ranges.
_BEYOND_LATIN = re.compile("[^\x00-\x7f\u00df-\u00f6\u00f8-\u024f]").search
_LATIN_WORDS = re.compile("[a-z\u00df-\u00f6\u00f8-\u024f]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\t-\r a-z0-9\u00df-\u00f6\u00f8-\u024f]+").findall
_LATIN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Encoder:
    """Words to token ids, with a bounded store of words already met."""

    def __init__(self, raw: bytes, cache_words: int = CACHE_WORDS) -> None:
        self.vocab = v = Vocabulary.parse(raw)
        self.names = np.array(v.tokens, dtype=object)
        pattern = v.split.replace(r"[^\s", r"[^\p{White_Space}")
        self.find = regex.compile(pattern).findall
        if v.split != _LATIN_SPLIT:
            raise ValueError(f"unknown split pattern {v.split}")
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(v.specials, key=len, reverse=True))) + ")") if v.specials else None
        self.cache_words = cache_words
        self.automaton = ahocorasick.Automaton()
        made = np.flatnonzero(v.rank >= 0)
        sound = np.zeros(len(v.tokens), bool)
        sound[made] = v.compatible(v.left[made], v.right[made], v.rank[made])
        for z in made[np.argsort(v.rank[made])]:  # parts come before what they make up
            sound[z] &= all(v.rank[p] < 0 or sound[p] for p in (v.left[z], v.right[z]))
        parts: dict[int, str] = {}
        for b in range(256):
            parts[int(v.plain[b])], parts[int(v.final[b])] = chr(b), chr(256 + b)
        for z in made[np.argsort(v.rank[made])].tolist():
            parts[z] = parts[int(v.left[z])] + parts[int(v.right[z])]
        for z, s in parts.items():
            if v.rank[z] < 0 or sound[z]:
                self.automaton.add_word(s, z)
        self.automaton.make_automaton()
        self.size = np.ones(len(v.tokens), np.int64)
        for z, s in parts.items():
            self.size[z] = len(s)
        self.exact_words = 0
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.counts: list[np.ndarray] = []
        self.flat: list[np.ndarray] = []
        self._add_specials()

    def _add_specials(self) -> None:
        for i in self.vocab.specials.values():
            self.index[f" {i}"] = len(self.index)
        ids = np.array(list(self.vocab.specials.values()), np.int32)
        self._joined = (np.ones(len(ids), np.int64), ids, np.arange(len(ids)))

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a text; a special token stands as a blank and its id."""
        if self.special is not None and "<|" in text:
            out: list[str] = []
            for part in self.special.split(text):
                if part in self.vocab.specials:
                    out.append(f" {self.vocab.specials[part]}")
                else:
                    out += self._plain_words(part)
            return out
        return self._plain_words(text)

    def _plain_words(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no special rule for a final sigma
        text = text.lower()
        return (self.find if _BEYOND_LATIN(text) else _LATIN_WORDS)(text)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens in each word, all token ids): greedy proposal, pair test, exact merging of failures."""
        v = self.vocab
        raw = [w.encode() for w in words]
        size = np.array([len(r) for r in raw])
        data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
        ends = np.cumsum(size)
        data[ends - 1] += 256
        tokens = np.array([z for _, z in self.automaton.iter_long(data.astype("<u4").tobytes().decode("utf-32-le"))], np.int64)
        stop = np.cumsum(self.size[tokens])
        if not len(stop) or stop[-1] != len(data):
            raise ValueError("the proposal doesn't cover the words")
        word = np.searchsorted(ends, stop, side="left")
        inner = np.flatnonzero(word[1:] == word[:-1])
        pairs, back = np.unique(tokens[inner] * len(v.tokens) + tokens[inner + 1], return_inverse=True)
        fine = v.compatible(pairs // len(v.tokens), pairs % len(v.tokens))[back]
        bad = np.unique(word[inner[~fine]])
        count = np.bincount(word, minlength=len(words))
        if not len(bad):
            return count, tokens
        self.exact_words += len(bad)
        long = bad[size[bad] > LONG_WORD]
        fixed = {int(w): v.exact([*v.plain[list(raw[w][:-1])].tolist(), int(v.final[raw[w][-1]])]) for w in long}
        again = np.zeros(len(words), bool)
        again[bad] = True
        right = ~again[word]
        again[long] = False
        parts, owners = [tokens[right]], [word[right]]
        for some in np.array_split(np.flatnonzero(again), 1 + len(bad) // 20_000):
            if len(some):
                n = size[some]
                own = np.repeat(some, n)
                at = np.repeat(ends[some] - n - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                symbols = np.where(data[at] < 256, v.plain[data[at] & 255], v.final[data[at] & 255])
                got, whose = v.exact_many(symbols, own)
                parts.append(got)
                owners.append(whose)
        for w, ids in fixed.items():
            parts.append(np.array(ids, np.int64))
            owners.append(np.full(len(ids), w))
        tokens, word = np.concatenate(parts), np.concatenate(owners)
        order = np.argsort(word, kind="stable")
        return np.bincount(word, minlength=len(words)), tokens[order]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens in each text, all token ids) of whole texts."""
        if len(self.index) > self.cache_words:
            self._reset()
        split = [self.words(t) for t in texts]
        index = self.index
        fresh = list(set().union(*split).difference(index))
        if fresh:
            count, ids = self.encode_words(fresh)
            start = len(index)
            index.update(zip(fresh, range(start, start + len(fresh)), strict=True))
            c, f, _ = self._joined
            c, f = np.concatenate([c, count]), np.concatenate([f, ids.astype(np.int32)])
            self._joined = (c, f, np.cumsum(c) - c)
        count, flat, first = self._joined
        per_text = np.array([len(ws) for ws in split])
        at = np.array(list(map(index.__getitem__, chain.from_iterable(split))), np.int64)
        n = count[at]
        where = np.repeat(first[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        text = np.repeat(np.arange(len(texts)), per_text)
        return np.bincount(text, n, len(texts)).astype(np.int64), flat[where]

    def decode(self, count: np.ndarray, ids: np.ndarray) -> list[str]:
        """Token strings joined by blanks, special tokens too: the vocabulary has no decoder of its own."""
        ends = np.cumsum(count)
        names = self.names[ids].tolist()
        return [" ".join(names[e - c : e]) for c, e in zip(count.tolist(), ends.tolist(), strict=True)]


_encoders: dict[int, Encoder] = {}


def _encoder(raw: bytes) -> Encoder:
    key = hash(raw)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(raw)
    return _encoders[key]


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """docs with ``ids`` (array of token ids of the whole text) and, if asked for, ``decoded``.

    path names the tokenizer's JSON file on the driver; its content is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_read(path))

    def run(buf: np.ndarray, off: np.ndarray) -> dict[str, object]:
        coder = _encoder(shared.value)
        raw = buf.tobytes()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
        count, ids = coder.encode(texts)
        ends = np.append(0, np.cumsum(count)).astype(np.int32)
        out: dict[str, object] = {"ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))}
        if decoded:
            out["decoded"] = pa.array(coder.decode(count, ids), pa.string())
        return out

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType()))] + [T.StructField("decoded", T.StringType())] * decoded
    return map_texts(docs, run, fields)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """df with ``decoded``: the text of a column of token ids; a null list decodes to an empty text."""
    shared = df.sparkSession.sparkContext.broadcast(_read(path))
    carried = [c for c in df.columns if c != "decoded"]
    schema = T.StructType([*(df.schema[c] for c in carried), T.StructField("decoded", T.StringType())])

    def run(batches):  # noqa: ANN001, ANN202
        coder = _encoder(shared.value)
        for batch in batches:
            lists = batch.column(len(carried)).to_pylist()
            count = np.array([len(x or ()) for x in lists], np.int64)
            flat = np.array([i for x in lists for i in x or ()], np.int64)
            yield pa.record_batch([*(batch.column(i) for i in range(len(carried))), pa.array(coder.decode(count, flat), pa.string())], [*carried, "decoded"])

    return df.select(*carried, df[ids].alias("__ids")).mapInArrow(run, schema)
