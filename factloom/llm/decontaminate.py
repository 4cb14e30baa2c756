"""Benchmark decontamination: rare words find where a test item may stand, Smith-Waterman scores it.

Items and texts are rows of lower-cased words: runs of letters, marks and digits by Unicode, so that quotes and
punctuation of any script part words; of scripts without spaces each character is a word. The similarity of a text and an item is the best
Smith-Waterman score (+1 for an equal word, -1/2 for a substitution or a gap) divided by the item's words.

The search misses no pair that reaches the threshold. Such an alignment equates at least m = threshold x L
of the item's L words and spans fewer than (3 - 2 threshold) L + 1 words of the text. Of any L - m + k
places of the item at least k are then among the equated ones. Those with the rarest words are taken (by
occurrences in the whole corpus; the k is the one that chance meets least), and only where k of
these words stand that close together is the stretch aligned. However edited a copy is, and whatever other
copies the corpus holds, its similarity alone decides.

The items are cut into groups of at most ``group_bytes`` of text; each group is broadcast and takes two
map-only passes over the corpus, so that nothing that grows is broadcast and no text is shuffled.

A stretch of ``run_words`` words is a match too, however long the item: the least similarity of an item of L words
is threshold, or run_words / L if that is less.

Parts of items with fewer than ``min_words`` words occur by chance (a character of a script without spaces counts
as half a word here): such an item matches only where all its words stand in a row.

Defined cases: null and empty texts or items match nothing; repeated documents give repeated matches, repeated
rows of an item (equal id and text) count once; a row
with a null item_id is an item like others, its matches have a null item_id; empty tables give no rows; an
input column of a clashing name is kept by ``clean`` and not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm import textvec as tv
from factloom.llm.common import bound_batches, free_name, map_texts

MIN_WORDS = 5
THRESHOLD = 0.5
RUN_WORDS = 30
GROUP_BYTES = 8_000_000
_FILTER_BITS = 20


@dataclass
class Items:
    """One group of items as word hashes; ``rarest`` chooses the words to seek."""

    ids: list
    words: list[np.ndarray]
    keys: np.ndarray  # the words to seek, sorted
    first: np.ndarray  # keys[i] is sought for owner[first[i]:first[i + 1]]
    owner: np.ndarray
    need: np.ndarray  # for each item: so many words of it must stand ...
    within: np.ndarray  # ... within so many words of a text
    least: np.ndarray  # for each item: the similarity that counts as a match

    @staticmethod
    def build(ids: list, texts: list, threshold: float, min_words: int, run_words: int) -> Items:
        words: list[np.ndarray] = []
        counted: list[float] = []
        for _, _, buf, off in tv.slices(pa.array(texts, pa.string())):
            d, h, alone = tv.any_words(buf, off)
            ends = np.searchsorted(d, np.arange(len(off)))
            words += [h[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            counted += np.bincount(d, np.where(alone, 0.5, 1.0), len(off) - 1).tolist()
        live = [i for i, w in enumerate(words) if len(w)]
        least = [min(threshold, run_words / len(words[i])) if counted[i] >= min_words else 1.0 for i in live]
        return Items._seeking([ids[i] for i in live], [words[i] for i in live], [words[i] for i in live], [1] * len(live), [len(words[i]) for i in live], least)

    @staticmethod
    def _seeking(ids: list, words: list[np.ndarray], sought: list[np.ndarray], need: list[int], within: list[int], least: list[float] | np.ndarray) -> Items:
        sought = [np.unique(w) for w in sought]
        flat = np.concatenate(sought) if sought else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sought)), [len(w) for w in sought])
        order = np.argsort(flat, kind="stable")
        keys, first = np.unique(flat[order], return_index=True)
        return Items(ids, words, keys, np.append(first, len(flat)), owner[order], np.array(need, np.int64), np.array(within, np.int64), np.array(least, float))

    def rarest(self, count: np.ndarray, total: int) -> Items:
        """Seek of each item the rarest words that an alignment of its least similarity can't do without.

        count: occurrences of each of keys in the corpus of total words.
        """
        sought, need, within = [], [], []
        for w, threshold in zip(self.words, self.least.tolist(), strict=True):
            least = min(len(w), max(1, int(np.ceil(threshold * len(w) - 1e-6))))
            span = int((3 - 2 * min(threshold, 1)) * len(w)) + 1
            known, nth = np.unique(w, return_inverse=True)
            seen = count[np.searchsorted(self.keys, known)]
            order = np.argsort(seen[nth], kind="stable")
            k = np.arange(1, least + 1)
            # words that chance puts into a span: their places of rank up to L - m + k, each word once
            new = np.zeros(len(w), bool)
            new[np.unique(nth[order], return_index=True)[1]] = True
            mean = np.cumsum(np.where(new, seen[nth][order], 0))[len(w) - least + k - 1] * (span / max(1, total))
            best = int(np.argmin(k * np.log(mean + 1e-12) - np.cumsum(np.log(k)))) + 1
            sought.append(w[order[: len(w) - least + best]])
            need.append(best)
            within.append(span)
        return Items._seeking(self.ids, self.words, sought, need, within, self.least)


class _Probe:
    """Where the words that a group seeks occur in a slice of texts."""

    def __init__(self, items: Items) -> None:
        self.items = items
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[(items.keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the word, index into keys) of each word that the items seek."""
        keys = self.items.keys
        if not len(keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hit = np.flatnonzero(self.seen[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(keys, h[hit]), len(keys) - 1)
        same = keys[at] == h[hit]
        return hit[same], at[same]

    def stretches(self, d: np.ndarray, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, first word, end) of the stretches of texts that hold every alignment with an item.

        first: number of each text's first word, and of all words.
        """
        items = self.items
        at, key = self.find(h)
        n = items.first[key + 1] - items.first[key]
        item = items.owner[np.repeat(items.first[key] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        at = np.repeat(at, n)
        order = np.argsort(item, kind="stable")  # at is in order already
        item, at = item[order], at[order]
        last = np.arange(len(at)) + items.need[item] - 1
        some = np.flatnonzero(last < len(at))
        last, span = last[some], items.within[item[some]]
        close = (item[last] == item[some]) & (d[at[last]] == d[at[some]]) & (at[last] - at[some] < span)
        some, last, span = some[close], last[close], span[close]
        item, text = item[some], d[at[some]]
        lo = np.maximum(at[last] - span + 1, first[text])
        hi = np.minimum(at[some] + span, first[text + 1])
        new = np.ones(len(item), bool)
        new[1:] = (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (lo[1:] > hi[:-1])
        item, lo, hi = item[new], lo[new], hi[np.append(np.flatnonzero(new)[1:], len(new)) - 1] if len(new) else hi
        # long stretches in pieces of four spans, which overlap by one, so that each alignment is whole in a piece
        span = items.within[item]
        pieces = np.maximum(1, -((lo + span - hi) // (3 * span)))
        lo = np.repeat(lo, pieces) + 3 * np.repeat(span, pieces) * (np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        item, span, hi = (np.repeat(x, pieces) for x in (item, span, hi))
        return item, lo, np.minimum(hi, lo + 4 * span)


def align(a: list[np.ndarray], b: list[np.ndarray], gap: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman of each pair of rows of words: the best score and its last place in b.

    All pairs advance together, one anti-diagonal a step; rows are padded with words that equal none.
    """
    p, la, lb = len(a), max(map(len, a)), max(map(len, b))
    x, y = np.zeros((p, la), np.uint64), np.ones((p, lb), np.uint64)
    for i, (u, v) in enumerate(zip(a, b, strict=True)):
        x[i, : len(u)], y[i, : len(v)] = u | np.uint64(2), v | np.uint64(2)
    back = y[:, ::-1]
    best, last = np.zeros(p, np.float32), np.zeros(p, np.int64)
    one, two = np.zeros((p, la + 1), np.float32), np.zeros((p, la + 1), np.float32)  # the last two anti-diagonals, by place in a
    rows = np.arange(p)
    for k in range(la + lb - 1):
        lo, hi = max(0, k - lb + 1), min(la, k + 1)
        equal = x[:, lo:hi] == back[:, lb - 1 - k + lo : lb - 1 - k + hi]
        now = np.zeros_like(one)
        now[:, lo + 1 : hi + 1] = np.maximum(np.maximum(two[:, lo:hi] + np.where(equal, np.float32(1), np.float32(-gap)), 0), np.maximum(one[:, lo:hi], one[:, lo + 1 : hi + 1]) - np.float32(gap))
        top = now.argmax(1)
        score = now[rows, top]
        more = score > best
        best[more], last[more] = score[more], (k - top + 1)[more]
        two, one = one, now
    return best, last


def _enough(a: list[np.ndarray], b: list[np.ndarray], least: np.ndarray) -> np.ndarray:
    """Whether at least so many words of each row of a occur in its row of b, as an alignment of that score needs."""
    x, y = np.zeros((len(a), max(map(len, a))), np.uint32), np.ones((len(a), max(map(len, b))), np.uint32)
    for i, (u, v) in enumerate(zip(a, b, strict=True)):
        x[i, : len(u)], y[i, : len(v)] = (u >> np.uint64(32)) | np.uint64(2), (v >> np.uint64(32)) | np.uint64(2)
    seen = np.zeros(len(a), np.int64)
    for k in range(x.shape[1]):
        seen += (x[:, k, None] == y).any(1)
    return seen >= least


def find_matches(probe: _Probe, buf: np.ndarray, off: np.ndarray, batch: int = 256) -> list[tuple[int, int, float, int]]:
    """(text, item, similarity, word where the best alignment ends), the best for each text and item."""
    items = probe.items
    d, h, _ = tv.any_words(buf, off)
    first = np.searchsorted(d, np.arange(len(off)))
    item, begin, end = probe.stretches(d, h, first)
    jobs = np.column_stack([d[begin], item])
    size = np.array([len(w) for w in items.words], np.int64)[item]
    best: dict[tuple[int, int], tuple[float, int]] = {}
    by_size = np.lexsort((end - begin, size))
    lo = 0
    while lo < len(jobs):
        hi = min(len(jobs), lo + max(1, min(batch, 400_000 // int(size[by_size[min(len(jobs), lo + batch) - 1]] + 1))))
        some = by_size[lo:hi]
        lo = hi
        own, around = [items.words[i] for i in jobs[some, 1]], [h[p:q] for p, q in zip(begin[some], end[some], strict=True)]
        hope = np.flatnonzero(_enough(own, around, np.ceil(items.least[jobs[some, 1]] * size[some] - 1e-6)))
        if not len(hope):
            continue
        some = some[hope]
        score, last = align([own[i] for i in hope], [around[i] for i in hope])
        for j, s, w in zip(some.tolist(), (score / size[some]).tolist(), last.tolist(), strict=True):
            k = (int(jobs[j, 0]), int(jobs[j, 1]))
            if s >= items.least[k[1]] - 1e-6 and s > best.get(k, (0.0, 0))[0]:
                best[k] = (s, int(w + begin[j] - first[jobs[j, 0]]))
    return [(t, i, s, w) for (t, i), (s, w) in sorted(best.items())]


def _groups(docs: DataFrame, benchmark: DataFrame, threshold: float, min_words: int, group_bytes: int, run_words: int) -> Iterator[Items]:
    """Groups of items of bounded size, with the words to seek; each costs one counting pass over docs."""
    # repeated rows of an item are one: equal rows would fall into one group, whatever their number
    items = benchmark.select("item_id", F.lower("text").alias("text")).filter("text is not null").groupBy("item_id", "text").count()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // group_bytes)
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect() if parts > 1 else items.collect()
        group = Items.build([r[0] for r in rows], [r[1] for r in rows], threshold, min_words, run_words)
        if group.words:
            yield group.rarest(*_occurrences(docs, group))


def _occurrences(docs: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """How often each word of the group occurs in docs, and the words of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = _Probe(items)
        count = np.zeros(len(items.keys) + 1, np.int64)  # the last is for all words
        for batch in batches:
            for _, _, buf, off in tv.slices(batch.column(0)):
                _, h, _ = tv.any_words(buf, off)
                count[:-1] += np.bincount(probe.find(h)[1], minlength=len(items.keys))
                count[-1] += len(h)
        some = np.flatnonzero(count)
        yield pa.record_batch([pa.array(some), pa.array(count[some])], ["at", "n"])

    bound_batches(docs.sparkSession)
    count = np.zeros(len(items.keys) + 1, np.int64)
    for at, n in docs.select(F.lower("text")).mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n")).collect():
        count[at] = n
    return count[:-1], int(count[-1])


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, min_words: int = MIN_WORDS, group_bytes: int = GROUP_BYTES, run_words: int = RUN_WORDS) -> DataFrame:
    """(doc_id, item_id, similarity, last_word) of each text and item that match."""
    bound_batches(docs.sparkSession)
    kind = benchmark.schema["item_id"].dataType
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("item_id", kind), T.StructField("similarity", T.DoubleType()), T.StructField("last_word", T.LongType())])

    def over(items: Items) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_type

            probe = _Probe(items)
            for batch in batches:
                for lo, _, buf, off in tv.slices(batch.column(1)):
                    got = find_matches(probe, buf, off)
                    rows = pa.array([lo + t for t, *_ in got], pa.int64())
                    yield pa.record_batch([
                        batch.column(0).take(rows), pa.array([items.ids[i] for _, i, _, _ in got], to_arrow_type(kind)),
                        pa.array([s for *_, s, _ in got], pa.float64()), pa.array([w for *_, w in got], pa.int64()),
                    ], schema.names)

        return docs.select("doc_id", F.lower("text")).mapInArrow(run, schema)

    out = docs.sparkSession.createDataFrame([], schema)
    for items in _groups(docs, benchmark, threshold, min_words, group_bytes, run_words):
        out = out.union(over(items))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, min_words: int = MIN_WORDS, group_bytes: int = GROUP_BYTES, run_words: int = RUN_WORDS) -> DataFrame:
    """The rows of docs that match no item, unchanged."""
    out, matched = docs, free_name(docs, "matched")
    for items in _groups(docs, benchmark, threshold, min_words, group_bytes, run_words):

        def run(buf: np.ndarray, off: np.ndarray, items: Items = items, probes: list = []) -> dict[str, object]:  # noqa: B006
            probes or probes.append(_Probe(items))
            hit = np.zeros(len(off) - 1, bool)
            hit[[t for t, *_ in find_matches(probes[0], buf, off)]] = True
            return {matched: hit}

        out = map_texts(out, run, [T.StructField(matched, T.BooleanType())], text=F.lower("text")).filter(~F.col(matched)).drop(matched)
    return out
