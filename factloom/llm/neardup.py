"""MinHash near-dedup with DartMinHash signatures, banded candidate search and exact verification.

A text is the multiset of its five-word shingles, in lower case. Every unit of weight (a shingle's occurrence) owns a
row of a Poisson process of darts along a rank axis, cut at 1/32, 1/16, ..., 1, 2, 4, ...; how many
darts fall in a piece, their ranks and their coordinates follow from a hash, so that equal shingles
throw equal darts. A text of weight W throws the pieces up to rank (ln t + 2) / W, about t ln t + 2t
darts in all, and keeps the earliest at each of its t coordinates; a text with an empty coordinate goes
on with the next pieces. Two texts agree at a coordinate with the probability of their weighted
Jaccard similarity.

Bands of coordinates make buckets; buckets of one member set count once for each order of leaders. Nobody
pairs up a bucket's members at first: each member meets the bucket's leader (one of three orders, by
band), the pair is verified on the whole shingle multisets, and connected components are formed. In buckets
that still hold several components, the members outside the largest one are compared with all others, block
against block over all tasks, of which only links between components leave a task. So all pairs of a
bucket are verified or known to be connected, whatever its size.

Buckets of over a thousandth of all texts are fewer than 1000 in a band; what is known of them is broadcast,
so that their members stay where they are instead of meeting in one task.

Exact copies (same 128-bit digest) are collapsed before all this and brought back at the end.

The result has one row per document: ``class_id`` is the smallest doc_id of its group.

Defined cases: a null text is a group of its own; empty texts are copies of each other; a text under
five words is one shingle of all its words; rows with a null doc_id are kept apart, class null;
repeated rows of one doc_id and text come back as they were; of different texts under one doc_id, that of
the least digest has the doc_id as its number in groups, the others a hash over 2**62, which is a group's
class_id where it holds no other; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm import textvec as tv
from factloom.llm.common import beside, free_name, map_texts, scratch
from factloom.llm.components import components
from factloom.llm.embeddup import _grouped

N_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
#: Members on average of a block of a bucket, and shingles that two blocks compare at a time.
CHUNK, VOCABULARY = 256, 8192
#: Ids of up to this many candidates are broadcast (24 bytes each); more go through a shuffled join.
BROADCAST_IDS = 2_000_000
#: Numbers of texts whose doc_id belongs to another text begin here.
_STRANGE = 1 << 62
_U = np.uint64
_FIRST = -5  # the first piece of the rank axis is [0, 2**_FIRST)


def elements(buf: np.ndarray, off: np.ndarray, n_words: int = N_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each unit of weight: the k-th occurrence of a shingle is its own unit."""
    d, h = tv.by_text(*tv.shingles(*tv.words(buf, off, ~tv.SPACE), n_words))
    head = np.ones(len(h), bool)
    head[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(head)
    nth = np.arange(len(h)) - np.repeat(at, np.diff(np.append(at, len(h))))
    return d, tv.mix(h + nth.astype(_U) * _U(0xA24BAED4963EE407))


def _poisson(u: np.ndarray, rate: float) -> np.ndarray:
    """Poisson counts by inversion of uniforms, for rates up to 1."""
    count = np.zeros(len(u), np.int64)
    left, mass, below = np.arange(len(u)), np.exp(-rate), np.exp(-rate)
    for k in range(1, 20):
        left = left[u[left] >= below]
        if not len(left):
            break
        count[left] = k
        mass *= rate / k
        below += mass
    return count


def _darts(d: np.ndarray, e: np.ndarray, piece: int, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, coordinate, rank) of all darts of these elements in one piece of the rank axis."""
    lo = 0.0 if piece == _FIRST else 2.0 ** (piece - 1)
    width = 2.0**piece - lo
    cells = max(1, int(width))
    cell = np.tile(np.arange(cells, dtype=_U), len(e)) if cells > 1 else np.zeros(len(e), _U)
    if cells > 1:
        d, e = np.repeat(d, cells), np.repeat(e, cells)
    key = tv.mix(e ^ (cell * _U(0xC2B2AE3D27D4EB4F) + _U((piece + 64) * 0x165667B19E3779F9 & (2**64 - 1))))
    count = _poisson(tv.unit(key), width / cells)
    some = np.flatnonzero(count)
    count = count[some]
    at = np.repeat(some, count)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    dart = tv.mix(key[at] + (nth + 1).astype(_U) * _U(0x9E3779B97F4A7C15))
    where = ((dart >> _U(32)) * _U(t)) >> _U(32)
    rank = lo + (cell[at].astype(float) + tv.unit(tv.mix(dart))) * (width / cells)
    return d[at], where.astype(np.int64), rank


def signatures(d: np.ndarray, e: np.ndarray, n: int, t: int) -> np.ndarray:
    """n x t signature values; a text without elements has zeros. Equal values mean equal darts."""
    weight = np.bincount(d, minlength=n)
    sig = np.full(n * t, np.uint64(2**64 - 1))
    with np.errstate(divide="ignore"):
        last = np.ceil(np.log2((np.log(t) + 2) / np.maximum(weight, 1))).astype(np.int64)
    last = np.maximum(last, _FIRST)
    live = weight > 0
    piece = _FIRST
    while live.any():
        take = live[d]
        if not take.all():
            d, e = d[take], e[take]
        doc, where, rank = _darts(d, e, piece, t)
        # the pattern of a positive double grows with its value; 40 bits hold its exponent and 29 of its mantissa
        key = np.sort(((doc * t + where).astype(_U) << _U(40)) | ((rank.view(_U) >> _U(23)) & _U((1 << 40) - 1)))
        slot = (key >> _U(40)).astype(np.int64)
        head = np.ones(len(slot), bool)
        head[1:] = slot[1:] != slot[:-1]
        slot, value = slot[head], key[head] & _U((1 << 40) - 1)
        sig[slot] = np.minimum(sig[slot], value)
        full = (sig.reshape(n, t) != np.uint64(2**64 - 1)).all(1)
        live &= ~((piece >= last) & full)
        piece += 1
    sig = sig.reshape(n, t)
    sig[weight == 0] = 0
    return sig


def _band_hashes(buf: np.ndarray, off: np.ndarray, bands: int, rows: int, n_words: int) -> np.ndarray:
    d, e = elements(buf, off, n_words)
    sig = signatures(d, e, len(off) - 1, bands * rows)
    out = np.zeros((len(sig), bands), _U)
    for r in range(rows):
        out = tv.mix(out * _U(0x9FB21C651E98DF25) + sig[:, r::rows] + np.arange(bands, dtype=_U))
    return out


def with_bands(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, n_words: int = N_WORDS) -> DataFrame:
    """docs with ``bands``: one 64-bit bucket number for each band; null where a text has no words."""

    def run(buf: np.ndarray, off: np.ndarray) -> dict[str, object]:
        got = _band_hashes(buf, off, bands, rows, n_words).view(np.int64)
        some = np.bincount(tv.spans(buf, off, ~tv.SPACE)[2], minlength=len(off) - 1) > 0
        ends = np.arange(len(got) + 1, dtype=np.int32) * bands
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(got.ravel()))
        return {"bands": pa.compute.if_else(pa.array(some), lists, None)}

    return map_texts(docs, run, [T.StructField("bands", T.ArrayType(T.LongType()))], keep=[c for c in docs.columns if c != "text"], slice_bytes=1_000_000)


def _text_key(doc_id: str, digest: str = "digest") -> Column:
    return F.xxhash64(doc_id, digest)


def _units(ids: DataFrame, texts: DataFrame, n_words: int) -> DataFrame:
    """(node, units): the sorted 32-bit hashes of the units of the texts of ids (node, rep, digest)."""
    ids = scratch(ids.select("node", "rep", _text_key("rep").alias("key")), "ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    wanted = texts.withColumn("key", _text_key("doc_id")).join(ids, "key").filter("doc_id = rep").select("node", "text")

    def packed(buf: np.ndarray, off: np.ndarray) -> dict[str, object]:
        d, e = elements(buf, off, n_words)
        e = (e >> _U(32)).astype(np.uint32)
        ends = np.searchsorted(d, np.arange(len(off)))
        return {"units": [np.sort(e[i:j]).tobytes() for i, j in zip(ends[:-1], ends[1:], strict=True)]}

    return scratch(map_texts(wanted, packed, [T.StructField("units", T.BinaryType())], keep=["node"]).dropDuplicates(["node"]), "units")


def verified(pairs: DataFrame, units: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) whose shingle multisets, as units has them, have a weighted Jaccard similarity >= threshold.

    A leader with many partners makes one skewed key, which adaptive execution splits.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32)
                if min(len(p), len(q)) < threshold * max(len(p), len(q)):
                    ok.append(False)
                    continue
                m = np.concatenate([p, q])
                m.sort(kind="stable")
                both = int((m[1:] == m[:-1]).sum())
                ok.append(both >= threshold * (len(m) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    joined = pairs.join(units.select(F.col("node").alias("b"), F.col("units").alias("ub")), "b").join(units.select(F.col("node").alias("a"), F.col("units").alias("ua")), "a")
    return joined.select("a", "b", "ua", "ub").mapInArrow(compare, "a long, b long")


def _members(reps: DataFrame, total: int) -> DataFrame:
    """(band, bucket, node, leader) of the members of buckets that hold several.

    Of buckets with the same members, one is taken for each of the three orders that choose leaders.
    """
    buckets = reps.filter("bands is not null").select("node", F.posexplode("bands").alias("band", "bucket"))
    turn = F.col("band") % 3
    order = F.struct(F.when(turn == 0, F.lit(0)).otherwise(F.xxhash64("node", turn)).alias("o"), F.col("node"))
    same = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"x{i}") for i in range(2)]
    all_of = buckets.groupBy("band", "bucket").agg(F.count("*").alias("n"), F.min(order)["node"].alias("leader"), F.min("node").alias("low"), *same).filter("n > 1")
    facts = all_of.groupBy(turn.alias("turn"), "n", "leader", "low", "x0", "x1").agg(F.min(F.struct("band", "bucket")).alias("at")).select("at.band", "at.bucket", "n", "leader")
    return beside(buckets, scratch(facts, "facts"), ["band", "bucket"], total).select("band", "bucket", "node", "leader")


def _mixed(members: DataFrame, comps: DataFrame, total: int) -> DataFrame:
    """(band, bucket, node, c, main, m, k) of buckets with several components: a member's and the largest
    component, and the bucket's members in all and outside the largest."""
    placed = scratch(members.join(comps, "node", "left").select("band", "bucket", "node", F.coalesce("component", "node").alias("c")), "placed")
    sizes = placed.groupBy("band", "bucket", "c").agg(F.count("*").alias("n"))
    facts = sizes.groupBy("band", "bucket").agg(F.sum("n").alias("n"), F.max(F.struct("n", "c")).alias("top"), F.count("*").alias("k")).filter("k > 1")
    facts = facts.select("band", "bucket", "n", F.col("top.c").alias("main"), (F.col("n") - F.col("top.n")).alias("outside"))
    return beside(placed, scratch(facts, "facts"), ["band", "bucket"], total).select("band", "bucket", "node", "c", "main", "n", "outside")


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many units each text of a shares with each of b, equal hashes within a text counted as often as both have them."""

    def flat(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(t) for t in texts])
        e, at = np.concatenate(texts).astype(_U), np.repeat(np.arange(len(texts)), size)
        head = np.ones(len(e), bool)
        head[1:] = (e[1:] != e[:-1]) | (at[1:] != at[:-1])
        start = np.flatnonzero(head)
        nth = np.arange(len(e)) - np.repeat(start, np.diff(np.append(start, len(e))))
        return (e << _U(32)) | nth.astype(_U), at

    (ea, ta), (eb, tb) = flat(a), flat(b)
    both = np.intersect1d(ea, eb)
    out = np.zeros((len(a), len(b)), np.float32)
    for lo in range(0, len(both), VOCABULARY):
        some = both[lo : lo + VOCABULARY]
        sides = []
        for e, t, n in ((ea, ta, len(a)), (eb, tb, len(b))):
            at = np.minimum(np.searchsorted(some, e), len(some) - 1)
            has = some[at] == e
            x = np.zeros((n, len(some)), np.float32)
            x[t[has], at[has]] = 1
            sides.append(x)
        out += sides[0] @ sides[1].T
    return out


def _stars(near: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a and b that near connects, each beside one id of its component."""
    none = len(a)
    la = np.arange(len(a))
    while True:
        lb = np.where(near, la[:, None], none).min(0)
        new = np.minimum(la, np.where(near, lb[None, :], none).min(1))
        if (new == la).all():
            break
        la = new
    i, j = np.flatnonzero(near.any(1)), np.flatnonzero(lb < none)
    return np.concatenate([a[la[i]], a[lb[j]]]), np.concatenate([a[i], b[j]])


def _block_links(mixed: DataFrame, units: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links between components, from all pairs of a bucket with one side outside its largest component.

    Blocks hold CHUNK members on average; block pairs spread over all tasks.
    """
    placed = mixed.withColumns({"i": F.ceil(F.col("outside") / CHUNK), "j": F.ceil(F.col("n") / CHUNK), "h": F.xxhash64("node", "band")})
    left = placed.filter("c != main").select("band", "bucket", F.expr("pmod(h, i)").alias("x"), F.expr("explode(sequence(0, j - 1))").alias("y"), "node", "c", F.lit(0).alias("side"))
    right = placed.select("band", "bucket", F.expr("explode(sequence(0, i - 1))").alias("x"), F.expr("pmod(h, j)").alias("y"), "node", "c", F.lit(1).alias("side"))
    rows = left.union(right).select(F.xxhash64("band", "bucket", "x", "y").alias("job"), "side", "node", "c")
    rows = rows.join(units, "node").select("job", "side", "c", "units").repartition("job").sortWithinPartitions("job")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, "job"):
            side, c = np.array(group["side"]), np.array(group["c"])
            units = [np.frombuffer(u.as_buffer(), np.uint32) for u in group["units"]]
            a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if not len(a) or not len(b):
                continue
            n = np.array([len(u) for u in units])
            both = _overlaps([units[i] for i in a], [units[i] for i in b])
            near = (both >= threshold * (n[a][:, None] + n[b][None, :] - both)) & (c[a][:, None] != c[b][None, :])
            x, y = _stars(near, c[a], c[b])
            yield pa.record_batch([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long").filter("a != b").select(*_ordered("a", "b")).distinct()


def _digest(text: Column) -> Column:
    """128 bits of a lower-cased text; null texts have the doc_id's instead."""
    return F.coalesce(F.md5(text.cast("binary")), F.concat(F.lit("null "), F.col("doc_id").cast("string")))


def _classes(docs: DataFrame, threshold: float, bands: int, rows: int, n_words: int) -> DataFrame:
    """(doc_id, digest, class_id, kept) of each row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text")).withColumn("digest", _digest(F.col("text")))
    signed = scratch(with_bands(texts, bands, rows, n_words), "signed")
    reps = signed.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    strange = reps.groupBy("rep").agg(F.min("digest").alias("own"), F.count("*").alias("n")).filter("n > 1").select("rep", "own")
    node = F.when(F.coalesce(F.col("own") == F.col("digest"), F.lit(True)), F.col("rep")).otherwise(F.lit(_STRANGE) + F.shiftrightunsigned(F.xxhash64("digest"), 2))
    reps = scratch(reps.join(strange, "rep", "left").select("digest", "rep", node.alias("node"), "bands"), "reps")
    total = reps.count()
    members = scratch(_members(reps, total), "members")
    several = members.select("node").distinct()
    units = _units(reps.select("node", "rep", "digest").join(several, "node", "left_semi"), texts, n_words)
    pairs = members.filter("node != leader").select(*_ordered("node", "leader")).distinct()
    comps = components(verified(pairs, units, threshold))
    mixed = scratch(_mixed(members, comps, total), "mixed")
    if not mixed.isEmpty():
        joined = components(_block_links(mixed, units, threshold)).select(F.col("node").alias("component"), F.col("component").alias("whole"))
        alone = joined.select(F.col("component").alias("node"), "component").join(comps.select("node"), "node", "left_anti")
        comps = comps.union(alone).join(joined, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    found = reps.select("digest", "rep", "node").join(comps, "node", "left").select("digest", "rep", "node", F.coalesce("component", "node").alias("class_id"))
    out = signed.select("doc_id", "digest").join(found, "digest", "left")
    kept = F.coalesce((F.col("node") == F.col("class_id")) & (F.col("doc_id") == F.col("rep")), F.lit(True)) | F.col("doc_id").isNull()
    return out.select("doc_id", "digest", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"), kept.alias("kept"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, n_words: int = N_WORDS) -> DataFrame:
    """(doc_id, class_id, kept): the group of each document; kept marks the group's smallest doc_id."""
    return _classes(docs, threshold, bands, rows, n_words).drop("digest")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that stand for their group, with all their columns.

    Of each group the row with the smallest doc_id stays (one, if it is repeated with its text); rows with
    a null doc_id stay. What goes is joined away by doc_id and text's digest; the list is broadcast while
    it's under BROADCAST_IDS.
    """
    found = scratch(_classes(docs, threshold, BANDS, ROWS, N_WORDS), "groups")
    text_key, digest = free_name(docs, "text_key"), _digest(F.lower("text"))
    keyed = docs.withColumn(text_key, F.xxhash64(F.col("doc_id").cast("long"), digest))
    gone = found.filter("not kept").select(_text_key("doc_id").alias(text_key)).distinct()
    if found.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    left = keyed.join(gone, text_key, "left_anti")
    repeated = scratch(found.filter("kept and doc_id is not null").groupBy(_text_key("doc_id").alias(text_key)).count().filter("count > 1").select(text_key), "repeated")
    if repeated.isEmpty():
        return left.select(*docs.columns)
    single = left.join(repeated, text_key, "left_semi").dropDuplicates([text_key])
    return left.join(repeated, text_key, "left_anti").select(*docs.columns).union(single.select(*docs.columns))
