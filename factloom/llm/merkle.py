"""A Merkle manifest of a table: leaf hashes, subroots by group, one root, and a path for each row.

Leaves are hashed and ranked by DataFrame functions: sorted once by range, positions from the counts of
partitions. Trees grow in Pregel-style supersteps over an RDD. In a step up, children message their parent (the
key of an aligned run of 2**levels nodes), and a parent that has them all hashes its own little tree and
forwards the top; in a step down, a parent holds its children's digests still and sends each its siblings'
path, with what came from above. Leaves meet their path where they were gathered, so that no path travels
further than its run, and rows travel once. A tree of n leaves takes log2(n) / levels steps up and as many
down; levels=1 is the plain form, one level a step. What a lost executor held comes back from the sorted
leaves, which are written to the shared folder, over as many shuffles as there are steps.

Two consecutive nodes become one, the hash of both digests as hexadecimal text; a last single one is hashed
alone. The subroots, in order of their groups, are the leaves of the tree of the root.

Defined cases: a null group, and null orders, come first, and null fields hash as '-'; equal rows are leaves
of their own beside each other; a lone leaf is its own subroot, a lone subroot the root, and a path may be
empty; an empty table gives no rows; columns that aren't named aren't read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

from pyspark import RDD
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm.common import scratch

#: Levels of a step: runs of 256 nodes, a few dozen kilobytes of digests and names.
LEVELS = 8
#: Leaves in a partition of the steps, at most about.
PART_LEAVES = 200_000


def leaf_hash(*fields: Column) -> Column:
    """SHA-256, as hexadecimal text, of fields as their byte counts, ':' and text; '-' for null."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text)), 256)


def _ranked(rows: DataFrame) -> DataFrame:
    """rows (g, o, leaf, kept) with the group's size and each row's place in it, by o and leaf."""
    stored = scratch(rows.withColumn("id", F.monotonically_increasing_id()), "merkle-leaves")
    order = ("g", "o", "leaf", "id")
    placed = scratch(stored.repartitionByRange(*order).sortWithinPartitions(*order).drop("id").withColumn("at", F.monotonically_increasing_id()), "merkle-sorted")
    part = F.shiftright("at", 33)
    sizes = placed.groupBy(part.alias("part"), F.col("g").alias("of")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    own = Window.partitionBy("of")
    before = F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a row for each partition, and one more for each group: written, so that its size is known
    offsets = scratch(sizes.select("part", "of", (before - F.col("first")).alias("shift"), F.sum("n").over(own).alias("size")), "merkle-offsets")
    met = placed.join(offsets, (part == F.col("part")) & F.col("g").eqNullSafe(F.col("of")))
    return met.select("g", "size", (F.col("at") + F.col("shift")).alias("place"), "leaf", "kept")


def _spot(key: tuple) -> int:
    return zlib.crc32(repr(key).encode())


def _height(n: int) -> int:
    return (n - 1).bit_length()


def _tree(digests: list[str], height: int) -> list[list[str]]:
    """The levels of a run's tree, its own digests first."""
    levels = [digests]
    for _ in range(height):
        below = levels[-1]
        levels.append([hashlib.sha256("".join(below[i : i + 2]).encode()).hexdigest() for i in range(0, len(below), 2)])
    return levels


def _left(size: int, k: int, levels: int) -> int:
    """Levels that step k adds to a tree of this size."""
    return max(0, min(levels, _height(size) - k * levels))


def _upward(k: int, levels: int) -> Callable[[tuple], tuple]:
    """What a parent that has all its children sends to its own parent."""
    mask = (1 << levels) - 1

    def send(run: tuple) -> tuple:
        (tree, place), children = run
        top = _tree([c[1] for c in children], _left(tree[1], k, levels))[-1][0]
        return (tree, place >> levels), (place & mask, top, None)

    return send


def _downward(k: int, levels: int) -> Callable[[tuple], Iterator[tuple]]:
    """What a parent that knows its path sends to its children; in the last step, the rows of the leaves."""

    def send(met: tuple) -> Iterator[tuple]:
        (tree, place), both = met
        children, (extra, path) = (x for _, x in sorted(both, key=lambda x: x[0]))
        made = _tree([c[1] for c in children], _left(tree[1], k, levels))[:-1]
        for i, (_, digest, payload) in enumerate(children):
            own = []
            for depth, level in enumerate(made):
                j = i >> depth
                own.append("" if j ^ 1 >= len(level) else ("L" if j & 1 else "R") + level[j ^ 1])
            yield (tree, digest, payload, own + path, extra) if k == 0 else ((tree, (place << levels) + i), (extra, own + path))

    return send


class _Forest:
    """Trees of many groups at once, from leaves ((group, size), place, digest, payload)."""

    def __init__(self, leaves: RDD, largest: int, levels: int, parts: int) -> None:
        self.levels, self.parts = levels, parts
        mask = (1 << levels) - 1
        messages = leaves.map(lambda x: ((x[0], x[1] >> levels), (x[1] & mask, x[2], x[3])))
        self.runs = []
        for k in range(max(1, -(-_height(largest) // levels))):
            self.runs.append(messages.groupByKey(parts, _spot).mapValues(lambda got: sorted(got, key=lambda m: m[0])))
            messages = self.runs[-1].map(_upward(k, levels))
        #: ((group, size), root) of each tree
        self.roots = messages.map(lambda m: (m[0][0], m[1][1]))

    def paths(self, tops: RDD) -> RDD:
        """(tree, digest, payload, path, extra) of each leaf, from (tree, (extra, path of the root)) of each tree."""
        messages = tops.map(lambda t: ((t[0], 0), t[1]))
        for k in reversed(range(len(self.runs))):
            sent = messages.mapValues(lambda m: (1, m)).partitionBy(self.parts, _spot)
            # both sides are dealt alike already: they meet without another shuffle
            met = self.runs[k].mapValues(lambda c: (0, c)).union(sent).groupByKey(self.parts, _spot)
            messages = met.flatMap(_downward(k, self.levels))
        return messages


def manifest(docs: DataFrame, leaf: Column, group: str = "lang", order: str = "doc_id", keep: tuple[str, ...] = ("doc_id",), levels: int = LEVELS) -> DataFrame:
    """(keep..., leaf, subroot, root, path) of each row.

    path lists the siblings from leaf to root: 'L' or 'R', the side on which the sibling stands, and its digest;
    '' where a node is hashed alone. keep: short columns, which travel with the leaves.
    """
    spark = docs.sparkSession
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, T.StringType()) for n in ("leaf", "subroot", "root")] + [T.StructField("path", T.ArrayType(T.StringType()))])
    ranked = _ranked(docs.select(F.col(group).cast("string").alias("g"), F.col(order).alias("o"), leaf.alias("leaf"), F.struct(*keep).alias("kept")))
    total, largest, groups = ranked.agg(F.count("*"), F.max("size"), F.count_if(F.col("place") == 0)).first()
    if not total:
        return spark.createDataFrame([], schema)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // PART_LEAVES)
    rows = ranked.select("g", "size", "place", "leaf", "kept").rdd.map(lambda r: ((r[0], r[1]), r[2], r[3], tuple(r[4])))
    trees = _Forest(rows, largest, levels, parts)
    # of groups, null first, then by their bytes
    ordered = trees.roots.sortBy(lambda t: (t[0][0] is not None, (t[0][0] or "").encode())).zipWithIndex()
    top = _Forest(ordered.map(lambda t: ((None, groups), t[1], t[0][1], t[0][0])), groups, levels, max(1, min(parts, groups >> levels)))
    above = top.paths(top.roots.map(lambda t: (t[0], (t[1], [])))).map(lambda x: (x[2], ((x[1], x[4]), x[3])))
    out = trees.paths(above).map(lambda x: (*x[2], x[1], *x[4], x[3]))
    return spark.createDataFrame(out, schema, verifySchema=False)


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    step = lambda digest, s: F.sha2(F.when(s.startswith("L"), F.concat(F.substring(s, 2, 64), digest)).otherwise(F.concat(digest, F.substring(s, 2, 64))), 256)
    return F.aggregate(path, leaf, step)


def proof(path: Column) -> Column:
    """One hash over the siblings of a path, from leaf to root."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.substring(s, 2, 64)), ""), 256)
