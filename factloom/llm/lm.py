"""LM scoring: a trigram model by deleted interpolation.

P(w | v) = a[b] c(v,w)/c(v) + u[b] c(w)/N + z[b] / (V+1) and P(w | u,v) = t[g] c(u,v,w)/c(u,v) + (1 - t[g]) P(w | v),
where b and g are the buckets of the contexts' counts c(v) and c(u,v): one for each count under FEW, then one
for each power of two. The weights of a bucket come from expectation-maximisation on held-out counts: every
training token is held out in turn, that is, its own occurrence is taken out of all counts (the deleted
estimate). EM runs on histograms of these estimates, rounded to quarter powers of two, for the pair level
first; scores use the estimates as they are.

Counts cover the whole training corpus and are looked up for every token of every text without a row
for each token: texts are dealt into blocks of some megabytes; a block sends its sorted distinct keys
(hashes of words, pairs and triples) with its counts to key ranges as packed arrays; a range adds
up and replies to each block with the totals in the block's own order. A frequent key costs one entry
for each block, so nothing is skewed. Both passes over the texts read the same shuffle.

Defined cases: a null text counts as empty, its only token is the end; words outside training have
c = 0; repeated rows count each time; an empty table gives no rows; with no training tokens P is
uniform; extra columns aren't read; texts over a block's size make a block of their own size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm import textvec as tv
from factloom.llm.common import scratch

BLOCK_BYTES = 10_000_000
FEW = 8
BUCKETS = FEW + 40
#: Beyond so many blocks a task takes several, one after the other.
MAX_TASKS = 65_536
#: Keys of pairs and triples have so many bits more than the corpus has bytes in its binary logarithm, and LEAST_BITS at
#: least, so that one shares its count with another by chance with a probability under 1/5000 at any size; keys of words have 64.
SPARE_BITS, LEAST_BITS = 10, 40
_END = np.uint64(0x8F1BBCDCBFA53E0B)
_START = np.uint64(0x2545F4914F6CDD1D)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, word, word before) of all tokens; each text has its words and one end."""
    docs, words = [], []
    for lo, _, buf, off in tv.slices(texts):
        d, h = tv.words(buf, off, ~tv.SPACE)
        n = len(off) - 1
        at = np.searchsorted(d, np.arange(n), side="right")
        docs.append(np.insert(d, at, np.arange(n)) + lo)
        words.append(np.insert(h, at, _END))
    d = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    w = np.concatenate(words) if words else np.zeros(0, np.uint64)
    before = np.append(_START, w[:-1])[: len(w)]
    before[np.append(True, d[1:] != d[:-1])[: len(d)]] = _START
    return d, w, before


def _pair_keys(before: np.ndarray, w: np.ndarray) -> np.ndarray:
    return tv.mix(before * np.uint64(5) + w * np.uint64(0xD6E8FEB86659FD93))


def _sorted_keys(table: pa.Table, bits: int) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """The tokens' text numbers in a fixed order of a block's texts; the distinct words, pairs and triples and each
    token's place among them, made one after the other. After the tokens' pairs comes the context before a text's
    first token."""
    texts = table["text"].combine_chunks() if table.num_rows else pa.array([], pa.string())
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks)
    d, w, before = _tokens(texts)

    def kinds(keys: np.ndarray, before: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        cut = np.uint64(64 - bits)
        yield np.unique(keys, return_inverse=True)
        keys = _pair_keys(before, keys)
        yield np.unique(np.append(keys, _START) >> cut, return_inverse=True)
        earlier = np.append(_START, before[:-1])[: len(keys)]
        earlier[before == _START] = _START
        keys = _pair_keys(keys, earlier + np.uint64(1)) >> cut
        del before, earlier
        yield np.unique(keys, return_inverse=True)

    return d, kinds(w, before)


def _ranges(keys: np.ndarray, ranges: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(range, cuts): the ranges that sorted keys fall in, and where each begins, with the end."""
    of = ((keys >> np.uint64(bits - 32)) * np.uint64(ranges)) >> np.uint64(32)
    cuts = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(keys) else np.zeros(0, np.int64)
    return of[cuts].astype(np.int64), np.append(cuts, len(keys))


def _squeezed(data: bytes) -> bytes:
    return np.array([len(data)], np.int64).tobytes() + pa.compress(data, codec="zstd", asbytes=True)


def _whole(data: bytes) -> bytes:
    return pa.decompress(data[8:], decompressed_size=int(np.frombuffer(data, np.int64, 1)[0]), codec="zstd", asbytes=True)


def _pack(keys: np.ndarray) -> bytes:
    """Steps between sorted keys, byte by byte from the lowest of all: the higher ones are nearly all 0."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return _squeezed(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_whole(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


_MUCH = 255


def _pack_counts(n: np.ndarray) -> bytes:
    """How many there are, a byte for each, then eight bytes for each of _MUCH or more."""
    return _squeezed(np.array([len(n)], np.int64).tobytes() + np.minimum(n, _MUCH).astype(np.uint8).tobytes() + n[n >= _MUCH].astype(np.int64).tobytes())


def _unpack_counts(data: bytes) -> np.ndarray:
    data = _whole(data)
    size = int(np.frombuffer(data, np.int64, 1)[0])
    n = np.frombuffer(data, np.uint8, size, 8).astype(np.int64)
    n[n == _MUCH] = np.frombuffer(data[8 + size :], np.int64)
    return n


def _pack_text(n: np.ndarray) -> bytes:
    """Counts of a text's tokens in as many bytes as the largest needs; the first byte says how many."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(n) or int(n.max()) < 1 << (8 * w))
    return bytes([width]) + n.astype(f"<u{width}").tobytes()


def _unpack_text(data: pa.Buffer) -> np.ndarray:
    data = memoryview(data)
    return np.frombuffer(data[1:], f"<u{data[0]}").astype(np.int64)


_SENT = "kind int, range int, block int, keys binary, counts binary"


def _send(ranges: int, bits: int):  # noqa: ANN202
    def run(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        train = np.array(table["train"], bool)
        d, kinds = _sorted_keys(table, bits)
        live = train[d]
        rows: dict[str, list] = {c.split()[0]: [] for c in _SENT.split(", ")}
        for kind, (keys, at) in enumerate(kinds):
            n = np.bincount(at[: len(d)][live], minlength=len(keys))
            if kind == 1:
                n[at[-1]] += int(train.sum())
            of, cuts = _ranges(keys, ranges, bits if kind else 64)
            for r, i, j in zip(of.tolist(), cuts[:-1], cuts[1:], strict=True):
                for c, v in zip(rows, (kind, r, block, _pack(keys[i:j]), _pack_counts(n[i:j])), strict=True):
                    rows[c].append(v)
        return pa.table({c: pa.array(v, pa.binary() if c in ("keys", "counts") else pa.int32()) for c, v in rows.items()})

    return run


def _reply(table: pa.Table) -> pa.Table:
    keys = [_unpack(x.as_py()) for x in table["keys"]]
    counts = [_unpack_counts(x.as_py()) for x in table["counts"]]
    distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(back, np.concatenate(counts).astype(float), len(distinct)).astype(np.int64)
    sizes = np.array([len(k) for k in keys])
    ends = np.cumsum(sizes)
    back = total[back]
    kind, own = table["kind"][0].as_py(), [_pack_counts(back[e - n : e]) for e, n in zip(ends, sizes, strict=True)]
    facts = np.array([int(total.sum()), int((total > 0).sum())], np.int64).tobytes()
    return pa.table({
        "kind": pa.array([kind] * (len(own) + 1), pa.int32()), "range": pa.array([*table["range"].to_pylist(), -1], pa.int32()),
        "block": pa.array([*table["block"].to_pylist(), -1 - table["range"][0].as_py()], pa.int32()), "counts": pa.array([*own, facts], pa.binary()),
    })


_LOOKED_UP = "train boolean, n_tokens long, n_known long, sum_log double, words binary, pairs binary, triples binary, starts long, total long, vocabulary long"


def _look_up(bits: int):  # noqa: ANN202
    """Counts of each token, pair and triple by text; a range's own totals pass through as a row without text."""

    def run(texts: pa.Table, replies: pa.Table) -> pa.Table:
        out: dict[str, list] = {c.split()[0]: [] for c in _LOOKED_UP.split(", ")}
        ids = texts["doc_id"]
        if not texts.num_rows:
            for kind, facts in zip(replies["kind"].to_pylist(), replies["counts"].to_pylist(), strict=True):
                if kind == 0:
                    total, distinct = np.frombuffer(facts, np.int64).tolist()
                    for c in out:
                        out[c].append({"total": total, "vocabulary": distinct}.get(c))
            ids = pa.nulls(len(out["total"]), ids.type)
        else:
            d, kinds = _sorted_keys(texts, bits)
            counts: list[np.ndarray] = []
            for kind, (keys, at) in enumerate(kinds):
                del keys
                rows = sorted((r, c) for k, r, c in zip(replies["kind"].to_pylist(), replies["range"].to_pylist(), replies["counts"].to_pylist(), strict=True) if k == kind)
                counts.append(np.concatenate([_unpack_counts(c) for _, c in rows])[at])
                del at
            word, starts = counts[0], int(counts[1][-1])
            ends = np.searchsorted(d, np.arange(texts.num_rows), side="right")
            first = np.append(0, ends[:-1])
            packed = [[_pack_text(c[i:j]) for i, j in zip(first, ends, strict=True)] for c in counts]
            out = {
                "train": texts["train"].to_pylist(), "n_tokens": (ends - first).tolist(), "n_known": np.bincount(d[word > 0], minlength=texts.num_rows).tolist(),
                "sum_log": np.bincount(d, np.log10(word.astype(float) + 1), texts.num_rows).tolist(), "words": packed[0], "pairs": packed[1], "triples": packed[2],
                "starts": [starts] * texts.num_rows, "total": [None] * texts.num_rows, "vocabulary": [None] * texts.num_rows,
            }
        kinds_of = {"boolean": pa.bool_(), "binary": pa.binary(), "long": pa.int64(), "double": pa.float64()}
        return pa.table({"doc_id": ids} | {(n := c.split())[0]: pa.array(out[n[0]], kinds_of[n[1]]) for c in _LOOKED_UP.split(", ")})

    return run


def _bucket(context: np.ndarray) -> np.ndarray:
    """The bucket of each context count."""
    return np.where(context < FEW, context, FEW - 3 + np.floor(np.log2(np.maximum(context, 1)))).astype(np.int64)


@dataclass
class Counts:
    """The counts of the tokens of one text, and of the corpus."""

    words: np.ndarray
    pairs: np.ndarray
    triples: np.ndarray
    starts: int
    total: int

    def level(self, order: int, held: int) -> tuple[np.ndarray, np.ndarray]:
        """(bucket of the context, estimate) of each token by its context of order - 1 words; held: occurrences
        taken out of the estimate."""
        if order == 1:
            return np.zeros(len(self.words), np.int64), np.maximum(self.words - held, 0) / max(self.total - held, 1)
        whole = np.append(self.starts, (self.words if order == 2 else self.pairs)[:-1])
        n = (self.pairs if order == 2 else self.triples) - held
        return _bucket(whole), np.where(whole > held, np.maximum(n, 0) / np.maximum(whole - held, 1), 0)


@dataclass
class Mixture:
    """Weights of pair, word and even estimate by bucket, and of the triple estimate by bucket."""

    low: np.ndarray
    high: np.ndarray | None
    floor: float

    def pairs(self, c: Counts, held: int) -> np.ndarray:
        """P(w | v) of each token."""
        b, p = c.level(2, held)
        return self.low[b, 0] * p + self.low[b, 1] * c.level(1, held)[1] + self.low[b, 2] * self.floor

    def all(self, c: Counts) -> np.ndarray:
        """P(w | u,v) of each token."""
        g, p = c.level(3, 0)
        return self.high[g, 0] * p + self.high[g, 1] * self.pairs(c, 0)


_STEP = 4  # histogram cells in a factor of two
_CELLS = 160


def mixture_weights(bucket: np.ndarray, parts: np.ndarray, n: np.ndarray, start: tuple[float, ...], rounds: int = 60) -> np.ndarray:
    """EM over a histogram of (bucket, estimates, count): weights of the estimates by bucket."""
    weights = np.tile(start, (BUCKETS, 1))
    for _ in range(rounds if len(n) else 0):
        share = weights[bucket] * parts
        share *= (n / share.sum(1))[:, None]
        weights = np.column_stack([np.bincount(bucket, share[:, k], BUCKETS) + 0.001 for k in range(len(start))])
        weights /= weights.sum(1, keepdims=True)
    return weights


def _cell(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.clip(np.rint(np.log2(np.maximum(p, 1e-300)) * _STEP) + _CELLS, 1, _CELLS), 0).astype(np.int64)


def _value(cell: np.ndarray) -> np.ndarray:
    return np.where(cell > 0, 2.0 ** ((cell - _CELLS) / _STEP), 0)


def score(docs: DataFrame, train: Column, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score) of each row of docs."""
    docs = docs.select("doc_id", "text", train.alias("train"))
    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"
    size, rows = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    blocks = max(1, -(-((size or 0) + 8 * rows) // block_bytes))
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")).repartition(min(blocks, MAX_TASKS), "block")
    bits = min(64, max(LEAST_BITS, SPARE_BITS + int(np.ceil(np.log2(max(2, size or 0))))))
    sent = dealt.groupBy("block").applyInArrow(_send(blocks, bits), _SENT)
    replies = sent.groupBy("kind", "range").applyInArrow(_reply, "kind int, range int, block int, counts binary")
    found = scratch(dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_look_up(bits), f"{kind}, {_LOOKED_UP}"), "lm-counts")
    total, vocabulary = found.agg(F.sum("total"), F.sum("vocabulary")).first()
    total, vocabulary = total or 0, vocabulary or 0
    texts = found.filter("n_tokens is not null")
    floor = 1.0 / (vocabulary + 1)

    def each(batch: pa.RecordBatch) -> Iterator[Counts]:
        for *packed, starts in zip(*(batch.column(c) for c in ("words", "pairs", "triples", "starts")), strict=True):
            yield Counts(*(_unpack_text(x.as_buffer()) for x in packed), starts.as_py(), total)

    def histogram(level: Callable[[Counts], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """(bucket, cell of the higher estimate, cell of the lower, tokens) over the training texts."""
        side = _CELLS + 1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(BUCKETS * side * side)
            for batch in batches:
                for c in each(batch):
                    b, p, q = level(c)
                    np.add.at(sums, (b * side + _cell(p)) * side + _cell(q), 1)
            some = np.flatnonzero(sums)
            yield pa.record_batch([pa.array(some // side**2), pa.array(some // side % side), pa.array(some % side), pa.array(sums[some])], ["b", "p", "q", "n"])

        used = texts.filter("train").select("words", "pairs", "triples", "starts")
        return used.mapInArrow(run, "b long, p long, q long, n double").groupBy("b", "p", "q").agg(F.sum("n")).toPandas().to_numpy(float).reshape(-1, 4)

    h = histogram(lambda c: (*c.level(2, 1), c.level(1, 1)[1]))
    low = mixture_weights(h[:, 0].astype(np.int64), np.column_stack([_value(h[:, 1]), _value(h[:, 2]), np.full(len(h), floor)]), h[:, 3], (0.5, 0.4, 0.1))
    half = Mixture(low, None, floor)
    h = histogram(lambda c: (*c.level(3, 1), half.pairs(c, 1)))
    model = Mixture(low, mixture_weights(h[:, 0].astype(np.int64), np.column_stack([_value(h[:, 1]), _value(h[:, 2])]), h[:, 3], (0.5, 0.5)), floor)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [float(np.log10(model.all(c)).sum()) for c in each(batch)]
            n = np.array(batch.column("n_tokens"))
            base = np.array(batch.column("sum_log")) - n * np.log10(total + vocabulary + 1)
            yield pa.record_batch([*(batch.column(c) for c in ("doc_id", "train", "n_tokens", "n_known")), pa.array(np.full(len(n), total)), pa.array(base), pa.array(out, pa.float64())], ["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return texts.mapInArrow(scored, f"{kind}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
