"""Embedding near-dedup by NN-descent on cosine similarity.

Exact copies of a vector are collapsed first. The neighbour graph starts from blocks of vectors with equal
sign patterns under random projections (so many tables that a pair at the threshold meets with MEET) and is
refined: in each round every vector's neighbours and reverse neighbours meet (neighbours of neighbours),
and each vector keeps its ``k`` best, until a round adds hardly any link. Two vectors with a common link are
at most two links' angles apart, so lists hold nothing under that similarity. Within a block or meeting all
pairs are compared; its links leave it as each vector's best and as one tie to the block's component.

A vector whose k neighbours are all links is saturated; its list is enlarged to its whole component. The
component is cut into blocks of vectors with a centre and a radius. Two blocks so near that all pairs are
links, or so far apart that none is, are settled by the triangle inequality on angles; the vectors of
others are compared, and only counts leave a task.

Recall is audited by brute force on ``audit`` vectors, and more until AUDIT_LINKED of them have links;
while it is under the target, further tables and rounds follow. Where that doesn't end, an error is raised.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with
nothing, and so do vectors of different lengths with each other; copies link with each other; a null
vec_id has a null component and links with nothing; of different vectors under one vec_id, one has the
vec_id as its number in components, the others a hash over 2**62, which is the component_id where a
component holds no other; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import beside, scratch
from factloom.llm.components import components

THRESHOLD = 0.9
K = 12
#: Vectors of a sign pattern on average, and rows that are compared at a time at most.
BLOCK, CHUNK = 192, 1024
#: Share of the pairs at the threshold that the tables of one pass bring together.
MEET = 0.95
#: Vectors that the audit asks at first; linked ones among them that are enough; numbers in all that it asks with.
AUDIT, AUDIT_LINKED, AUDIT_MOST = 400, 50, 4_000_000
TARGET = 0.98
#: A round that adds less than this share of links is the last of its pass.
SETTLED = 0.001
PASSES = 20
#: Members of a block of a component at most, and blocks on average of a group that is compared at a time.
MEMBERS, GROUP = 256, 256
#: Numbers of vectors whose vec_id belongs to another vector begin here.
_STRANGE = 1 << 62


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _units(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; each is divided by its largest component first, so that no square over- or underflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _lists_of(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def _grouped(batches: Iterator[pa.RecordBatch], key: str, most: int | None = None) -> Iterator[pa.Table]:
    """Runs of rows with one key, from a partition sorted by it; runs over ``most`` rows in pieces."""
    kept: list[pa.Table] = []
    rows = 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        keys = np.array(table[key])
        cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else []
        for i, j in zip(cuts, [*cuts[1:], len(keys)], strict=True):
            while i < j:
                if kept and (kept[0][key][0].as_py() != keys[i] or rows == most):
                    yield pa.concat_tables(kept)
                    kept, rows = [], 0
                part = table.slice(i, min(j - i, most - rows) if most else j - i)
                kept.append(part)
                rows += part.num_rows
                i += part.num_rows
    if kept:
        yield pa.concat_tables(kept)


_LISTS = "id long, root long, v array<long>, s array<double>, w array<long>"


def _batch(u: np.ndarray, v: np.ndarray, s: np.ndarray, w: np.ndarray, ties: np.ndarray, k: int) -> pa.RecordBatch:
    """Each vector's k best neighbours v of similarity s and weight w as a row, and a row for each tie (id, root)."""
    order = np.lexsort((v, u))
    u, v, s, w = u[order], v[order], s[order], w[order]
    new = np.ones(len(u), bool)
    new[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    u, v, s, w = u[new], v[new], s[new], w[new]
    order = np.lexsort((-s, u))
    u, v, s, w = u[order], v[order], s[order], w[order]
    heads = np.flatnonzero(np.append(True, u[1:] != u[:-1])) if len(u) else np.zeros(0, np.int64)
    best = np.arange(len(u)) - np.repeat(heads, np.diff(np.append(heads, len(u)))) < k
    u, v, s, w = u[best], v[best], s[best], w[best]
    heads = np.flatnonzero(np.append(True, u[1:] != u[:-1])) if len(u) else np.zeros(0, np.int64)
    ties = np.unique(ties, axis=0)
    ends = pa.array(np.concatenate([heads, np.full(len(ties) + 1, len(u))]).astype(np.int32))
    own = u[heads]
    lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (v, s, w)]
    return pa.record_batch([pa.array(np.append(own, ties[:, 0])), pa.array(np.append(own, ties[:, 1])), *lists], ["id", "root", "v", "s", "w"])


def _roots(near: np.ndarray) -> np.ndarray:
    """The first row of each row's component."""
    root = np.arange(len(near))
    while True:
        new = np.minimum(root, np.where(near, root[None, :], len(near)).min(1))
        if (new == root).all():
            return root
        root = new


def _compared(k: int, threshold: float, key: str):  # noqa: ANN202
    """All pairs of each run of rows (key, id, x, weight): lists and ties, combined within the task."""
    floor = 2 * threshold * threshold - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list = []
        ties: list = [np.zeros((0, 2), np.int64)]

        def flush() -> pa.RecordBatch:
            made = _batch(*(np.concatenate([p[i] for p in parts]) for i in range(4)), np.concatenate(ties), k)
            parts.clear()
            del ties[1:]
            return made

        rows = 0
        for group in _grouped(batches, key, CHUNK):
            ids, first = np.unique(np.array(group["id"]), return_index=True)
            if len(ids) < 2:
                continue
            x, w = _matrix(group["x"])[first], np.array(group["weight"])[first]
            sim = np.clip(x @ x.T, -1, 1)
            np.fill_diagonal(sim, -2)
            near = sim >= threshold
            some = np.flatnonzero(near.any(1))
            if len(some):
                root = some[_roots(near[np.ix_(some, some)])]
                ties.append(np.column_stack([ids[some], ids[root]])[some != root])
            keep = sim >= floor
            for i in np.flatnonzero(keep.sum(1) > k):
                keep[i] = False
                keep[i, np.argpartition(-sim[i], k - 1)[:k]] = True
            i, j = np.nonzero(keep)
            if len(i):
                parts.append((ids[i], ids[j], sim[i, j], w[j]))
                rows += len(i)
            if rows > 500_000:
                yield flush()
                rows = 0
        if parts:
            yield flush()

    return run


def _merged(k: int):  # noqa: ANN202
    """Rows of lists sorted by id: one row for each id."""

    def of(t: pa.Table) -> pa.RecordBatch:
        lists = [t[c].combine_chunks() for c in ("v", "s", "w")]
        u = np.repeat(np.array(t["id"]), np.asarray(lists[0].value_lengths()))
        return _batch(u, *(np.asarray(x.flatten()) for x in lists), np.zeros((0, 2), np.int64), k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            ids = np.array(table["id"])
            cut = int(np.searchsorted(ids, ids[-1]))
            rest = table.slice(cut)
            if cut:
                yield of(table.slice(0, cut))
        if rest is not None:
            yield of(rest)

    return run


def _dealt(rows: DataFrame, keys: DataFrame, key: str, total: int) -> DataFrame:
    """rows sorted by key in partitions; keys of over a thousandth of total rows, fewer than 1000, over many.

    keys: the keys of rows, to be counted.
    """
    hot = F.broadcast(keys.groupBy(key).agg(F.count("*").alias("many")).filter(F.col("many") > total // 1000 + CHUNK))
    h = F.xxhash64("id", key)
    salt = F.when(F.col("many").isNull(), 0).otherwise(F.pmod(h, F.ceil(F.col("many") / CHUNK)))
    dealt = rows.join(hot, key, "left").select(F.xxhash64(key, salt).alias("block"), h.alias("h"), "id", "x", "weight")
    return dealt.repartition("block").sortWithinPartitions("block", "h")


def _start(vecs: DataFrame, n: int, dims: int, seed: int, k: int, threshold: float) -> DataFrame:
    """Lists and ties from blocks of equal sign patterns, several tables."""
    bits = max(1, int(np.ceil(np.log2(max(2, n / BLOCK)))))
    meet = (1 - np.arccos(threshold) / np.pi) ** bits
    tables = max(1, int(np.ceil(np.log(1 - MEET) / np.log1p(-meet))))
    planes = np.random.default_rng(seed).standard_normal((dims, tables * bits))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            got = (x @ planes > 0).reshape(len(x), tables, bits)
            code = (got * (1 << np.arange(bits))).sum(2) + (np.arange(tables) << (bits + 1))
            yield pa.record_batch([*batch.columns, _lists_of(code.astype(np.int64))], ["id", "x", "weight", "codes"])

    rows = vecs.mapInArrow(sign, "id long, x array<double>, weight long, codes array<long>").select("id", "x", "weight", F.explode("codes").alias("code"))
    # total: a thousandth of one table's rows
    return _dealt(rows, rows.select("code"), "code", n).mapInArrow(_compared(k, threshold, "block"), _LISTS)


def _meet(lists: DataFrame, vecs: DataFrame, n: int, k: int, threshold: float) -> DataFrame:
    """Every vector's neighbours and reverse neighbours meet around it."""
    pairs = lists.select(F.col("id").alias("at"), F.explode("v").alias("id"))
    around = pairs.union(pairs.select("id", "at")).union(lists.select("id", "id")).toDF("at", "id")
    total = (2 * k + 1) * n
    # a vector stands in as many rows as meet around it
    facts = around.groupBy("id").agg(F.count("*").alias("n")).join(vecs, "id")
    return _dealt(beside(around, facts, ["id"], total), around, "at", total).mapInArrow(_compared(k, threshold, "block"), _LISTS)


def _blocks(members: DataFrame, dims: int) -> DataFrame:
    """(component, block, ids, weights, xs, centre, radius, weight): members (component, id, x, weight) in runs of MEMBERS at most."""
    planes = np.random.default_rng(5).standard_normal((dims, 16))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = ((_matrix(batch.column(2)) @ planes > 0) * (1 << np.arange(16))).sum(1)
            yield pa.record_batch([*batch.columns, pa.array(code)], ["component", "id", "x", "weight", "code"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, "component", MEMBERS):
            x, ids, w = _matrix(group["x"]), np.array(group["id"]), np.array(group["weight"])
            centre = x.mean(0)
            size = np.sqrt((centre * centre).sum())
            centre = x[0] if size < 1e-6 else centre / size
            radius = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
            one = [[group["component"][0].as_py()], [int(ids[0])], [ids], [w], [x.ravel()], [centre], [radius], [int(w.sum())]]
            yield pa.record_batch([pa.array(v) for v in one], ["component", "block", "ids", "weights", "xs", "centre", "radius", "weight"])

    coded = scratch(members.select("component", "id", "x", "weight").mapInArrow(sign, "component long, id long, x array<double>, weight long, code long"), "members")
    placed = coded.repartitionByRange("component", "code", "id").sortWithinPartitions("component", "code", "id")
    return scratch(placed.mapInArrow(cut, "component long, block long, ids array<long>, weights array<long>, xs array<double>, centre array<double>, radius double, weight long"), "blocks")


def _count_within(members: DataFrame, dims: int, threshold: float) -> DataFrame:
    """(id, n): links of each member inside its component, weights added up."""
    blocks = _blocks(members, dims)
    size = blocks.groupBy("component").agg(F.count("*").alias("n"))
    facts = beside(blocks.select("component", "block", "centre", "radius", "weight"), size, ["component"], blocks.count())
    facts = facts.withColumn("groups", F.ceil(F.col("n") / GROUP)).withColumn("g", F.pmod(F.xxhash64("block"), F.col("groups")))
    every = F.explode(F.sequence(F.lit(0), F.col("groups") - 1))
    left = facts.select("component", F.col("g").alias("i"), every.alias("j"), F.lit(0).alias("side"), "block", "centre", "radius", "weight")
    right = facts.select("component", every.alias("i"), F.col("g").alias("j"), F.lit(1).alias("side"), "block", "centre", "radius", "weight")
    jobs = left.union(right).withColumn("job", F.xxhash64("component", "i", "j")).drop("component", "i", "j").repartition("job").sortWithinPartitions("job")
    link = float(np.arccos(threshold))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, "job"):
            side, block, c = np.array(group["side"]), np.array(group["block"]), _matrix(group["centre"])
            r, w = np.array(group["radius"]), np.array(group["weight"])
            a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            apart, reach = np.arccos(np.clip(c[a] @ c[b].T, -1, 1)), r[a][:, None] + r[b][None, :]
            same = block[a][:, None] == block[b][None, :]
            every = (apart + reach < link - 1e-6) & ~same
            i, j = np.nonzero((apart - reach < link + 1e-6) & ~every & (block[a][:, None] <= block[b][None, :]))
            yield pa.record_batch([pa.array(block[a]), pa.nulls(len(a), pa.int64()), pa.array((every @ w[b]).astype(np.int64))], ["a", "b", "n"])
            yield pa.record_batch([pa.array(block[a[i]]), pa.array(block[b[j]]), pa.array(np.zeros(len(i), np.int64))], ["a", "b", "n"])

    settled = scratch(jobs.mapInArrow(settle, "a long, b long, n long"), "settled")
    whole = settled.filter("b is null").groupBy(F.col("a").alias("block")).agg(F.sum("n").alias("n"))
    sides = [blocks.select(F.col("block").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("ids", "weights", "xs"))) for x in "ab"]
    open_pairs = settled.filter("b is not null").select("a", "b").join(sides[0], "a").join(sides[1], "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ia, wa, ib, wb = (np.asarray(batch.column(c)[r].values) for c in ("ids_a", "weights_a", "ids_b", "weights_b"))
                xa, xb = (np.asarray(batch.column(c)[r].values).reshape(-1, dims) for c in ("xs_a", "xs_b"))
                near = (xa @ xb.T >= threshold) & (ia[:, None] != ib[None, :])
                ids, n = ia, near @ wb
                if ia[0] != ib[0]:
                    ids, n = np.append(ia, ib), np.append(n, wa @ near)
                yield pa.record_batch([pa.array(ids), pa.array(n.astype(np.int64))], ["id", "n"])

    compared = open_pairs.select("ids_a", "weights_a", "xs_a", "ids_b", "weights_b", "xs_b").mapInArrow(compare, "id long, n long")
    spread = blocks.select("block", F.explode("ids").alias("id")).join(whole, "block").select("id", "n")
    return compared.union(spread).groupBy("id").agg(F.sum("n").alias("n"))


def _audit(vecs: DataFrame, links: DataFrame, dims: int, threshold: float, audit: int) -> tuple[float, int]:
    """(recall, linked vectors asked): the mean share found of a vector's true links, and of all links if less.

    Vectors are asked in order of their hash, block by block, until AUDIT_LINKED of them have links or all have
    been asked: without a link among all of them there is nothing to find. A block holds AUDIT_MOST numbers at most.
    """
    key, after, size = F.xxhash64("id"), F.lit(True), audit
    shares, found, true, linked = 0.0, 0, 0, 0
    while linked < AUDIT_LINKED:
        asked = vecs.filter(after).select(key.alias("key"), "id", "x").orderBy("key", "id").limit(max(1, min(size, AUDIT_MOST // dims))).toPandas()
        if not len(asked):
            break
        ids, q = asked["id"].to_numpy(), np.array(asked["x"].to_list(), float).reshape(len(asked), -1)

        def run(batches: Iterator[pa.RecordBatch], ids: np.ndarray = ids, q: np.ndarray = q) -> Iterator[pa.RecordBatch]:
            n = np.zeros(len(ids), np.int64)
            for batch in batches:
                x, own, w = _matrix(batch.column(1)), np.array(batch.column(0)), np.array(batch.column(2))
                for lo in range(0, len(x), 2048):
                    near = (x[lo : lo + 2048] @ q.T >= threshold) & (own[lo : lo + 2048, None] != ids)
                    n += w[lo : lo + 2048] @ near
            yield pa.record_batch([pa.array(ids), pa.array(n)], ["id", "n"])

        actual = vecs.select("id", "x", "weight").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("actual")).filter("actual > 0")
        share = F.least(F.coalesce("n", F.lit(0)), "actual")
        got = actual.join(links.select("id", "n"), "id", "left").agg(F.sum(share / F.col("actual")), F.sum(share), F.sum("actual"), F.count("*")).first()
        shares, found, true, linked = shares + (got[0] or 0), found + (got[1] or 0), true + (got[2] or 0), linked + got[3]
        last, number = int(asked["key"].iloc[-1]), int(ids[-1])
        after, size = (key > last) | ((key == last) & (F.col("id") > number)), size * 4
    return (min(shares / linked, found / true), linked) if linked else (1.0, 0)


def _links(vecs: DataFrame, dims: int, threshold: float, k: int, audit: int, target: float) -> tuple[DataFrame, DataFrame]:
    """(id, n) and (node, component) of vecs (id, x, weight)."""
    n = vecs.count()
    lists, ties = None, None
    for attempt in range(PASSES):
        raw = _start(vecs, n, dims, 17 + attempt, k, threshold)
        found = -1
        while True:
            raw = scratch(raw, "raw")
            tied = raw.filter("id != root").select("id", "root")
            ties = tied if ties is None else ties.union(tied)
            new = raw.filter("id = root")
            lists = scratch((new if lists is None else lists.union(new)).repartition("id").sortWithinPartitions("id").mapInArrow(_merged(k), _LISTS), "lists")
            linked = F.filter("s", lambda s: s >= threshold)
            now = lists.agg(F.sum(F.size(linked))).first()[0] or 0
            if now <= found * (1 + SETTLED) or not now:
                break
            found = now
            raw = _meet(lists, vecs, n, k, threshold)
        comps = components(ties, "id", "root")
        direct = lists.select("id", F.size(linked).alias("k"), F.aggregate(F.slice("w", F.lit(1), F.size(linked)), F.lit(0).cast("long"), lambda x, w: x + w).alias("n")).filter("k > 0")
        placed = comps.join(direct, comps.node == direct.id, "left").select("node", "component", F.coalesce("k", F.lit(0)).alias("k"))
        crowded = placed.groupBy("component").agg(F.count("*").alias("n"), F.max("k").alias("k")).filter(F.col("k") >= k).select("component", "n")
        inside = beside(comps, crowded, ["component"], n).select(F.col("node").alias("id"), "component")
        within = _count_within(vecs.join(inside, "id"), dims, threshold)
        mine = scratch(direct.select("id", "n").join(inside, "id", "left_anti").union(within), "counts")
        recall, asked = _audit(vecs, mine, dims, threshold, audit)
        logging.getLogger(__name__).info("pass %d: recall %.4f of the links of %d vectors", attempt + 1, recall, asked)
        if recall >= target:
            return mine, comps
    raise RuntimeError(f"recall stayed at {recall:.3f} of {target}")


def _hash_of(vec: str) -> Column:
    return F.xxhash64(vec)


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, k: int = K, audit: int = AUDIT, target: float = TARGET) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = F.coalesce(~bad & F.exists("vec", lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    good = rows.filter(valid)
    reps = good.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
    strange = reps.groupBy("rep").agg(F.min(_hash_of("vec")).alias("own"), F.count("*").alias("n")).filter("n > 1").select("rep", "own")
    node = F.when(F.coalesce(F.col("own") == _hash_of("vec"), F.lit(True)), F.col("rep")).otherwise(F.lit(_STRANGE) + F.shiftrightunsigned(_hash_of("vec"), 2))
    reps = scratch(reps.join(strange, "rep", "left").select("vec", "rep", node.alias("id"), "weight"), "vectors")
    counted, joined = None, None

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.record_batch([batch.column(0), _lists_of(_units(_matrix(batch.column(1)))), batch.column(2)], ["id", "x", "weight"])

    for (dims,) in reps.select(F.size("vec")).distinct().collect():
        vecs = scratch(reps.filter(F.size("vec") == dims).select("id", "vec", "weight").mapInArrow(unit, "id long, x array<double>, weight long"), "units")
        mine, comps = _links(vecs, dims, threshold, k, audit, target)
        counted = mine if counted is None else counted.union(mine)
        joined = comps if joined is None else joined.union(comps)
    if counted is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    facts = reps.join(counted, "id", "left").join(joined, F.col("id") == F.col("node"), "left")
    facts = facts.select("vec", "rep", "id", F.col("weight").alias("n"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = beside(good, facts, ["vec"], good.count())
    kept = (F.col("id") == F.col("component_id")) & (F.col("vec_id") == F.col("rep"))
    out = out.select("vec_id", "n_links", "component_id", kept.alias("kept"))
    return out.union(rows.filter(~valid).select("vec_id", F.lit(0).cast("long"), "vec_id", F.lit(True)))
