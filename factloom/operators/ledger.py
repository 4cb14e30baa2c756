"""Sequence numbers, leaf hashes, chains in blocks, anchors, verification and tampering.

A chain is sequential by its nature, so it runs within blocks of BLOCK_FACTS successive numbers, which one
task gathers; the blocks' last roots are chained to anchors, one short row for each block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from factloom.sources.shared import scratch

BASE_LSN = 14_812_337
#: Facts in a block: about 10 MB of leaves in one task.
BLOCK_FACTS = 65_536
#: Facts that one task numbers and seals, about: blocks, or one that is larger.
CHUNK_FACTS = 65_536
#: What a leaf covers: all of a fact but its integrity.
SEALED = (
    "lsn", "seq", "fact_id", "obs_ts", "source", "raw", "rule_id", "action", "class", "risk", "actor", "target", "source_ip",
    "system_timestamp", "confidence", "raw_hash", "steps", "knowledge_version", "legal_stamp", "reasoning_version", "ontology_version",
)
INTEGRITY = ("leaf", "block", "root", "checksum")


def assign_lsn(facts: DataFrame, order: str = "seq", base: int = BASE_LSN) -> DataFrame:
    """Dense numbers after base in the given order: range partitions, their counts, an offset for each.

    facts are stored once, in order; what is counted and numbered comes from these files. The ranges come from a
    sample that Spark takes of facts themselves, so that lines are parsed a second time instead of being written,
    and read twice, before they are sorted. The offsets are a table of one row for each partition.
    """
    part, at = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    placed = scratch(facts.repartitionByRange(order).sortWithinPartitions(order).withColumn("__id", F.monotonically_increasing_id()), "sorted")
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("__part", (before + base + 1).alias("__first"))
    numbered = placed.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    return numbered.withColumn("lsn", (F.col("__first") + at).cast("long")).drop("__id", "__part", "__first")


def assign_lsn_by_chunk(facts: DataFrame, order: str = "seq", base: int = BASE_LSN, block_facts: int = BLOCK_FACTS) -> tuple[DataFrame, int] | None:
    """(``assign_lsn`` of facts, the last number), where a chunk of whole blocks lies in one task, in order.

    Only the column ``order`` is sorted and numbered at first; where chunks begin is one row for each CHUNK_FACTS facts.
    With these, facts themselves are shuffled once, and neither written nor shuffled again before they are sealed. None
    where order isn't a whole number, or doesn't tell the facts at a chunk's border apart: these are for assign_lsn.
    """
    if facts.schema[order].dataType.typeName() not in ("long", "integer"):
        return None
    step = block_facts * max(1, CHUNK_FACTS // block_facts)
    keys = assign_lsn(facts.select(F.col(order).alias("__key")), "__key", base)
    last = keys.agg(F.max("lsn")).first()[0] or base
    border = keys.filter((F.col("lsn") - BASE_LSN - 1) % step == 0).select(F.col("lsn"), "__key", F.lit(1).alias("at"))
    border = border.union(keys.filter((F.col("lsn") - BASE_LSN) % step == 0).select(F.col("lsn") + 1, "__key", F.lit(0)))
    rows = {(r[0], r[2]): r[1] for r in border.collect()}
    firsts = sorted(n for n, at in rows if at == 1 and n > base + 1)
    if any(rows[n, 0] is None or rows[n, 0] == rows[n, 1] for n in firsts):
        return None
    bounds, starts = np.array([rows[n, 1] for n in firsts], dtype=np.int64), np.array([base + 1, *firsts], dtype=np.int64)

    @F.pandas_udf("long")
    def first(values: pd.Series) -> pd.Series:
        return pd.Series(starts[np.searchsorted(bounds, values.to_numpy(dtype=np.int64), "right")])

    dealt = facts.withColumn("__first", first(F.coalesce(F.col(order).cast("long"), F.lit(-(1 << 63)))))
    number = F.row_number().over(Window.partitionBy("__first").orderBy(order))
    return dealt.withColumn("lsn", F.col("__first") + number - 1).drop("__first"), last


def _text(facts: DataFrame, name: str) -> Column:
    kind = facts.schema[name].dataType.typeName()
    column = F.col(name)
    return F.unix_micros(column).cast("string") if kind == "timestamp" else F.array_join(column, ";") if kind == "array" else column.cast("string")


def leaf_hash(facts: DataFrame, columns: tuple[str, ...] = SEALED) -> Column:
    """SHA-256 over length-prefixed fields of facts; a null field is '-', times are microseconds."""
    field = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat_ws(",", *(field(_text(facts, c)) for c in columns)), 256)


def checksum() -> Column:
    """First 48 hex digits of a hash of the leaf; not a signature."""
    return F.substring(F.sha2(F.concat(F.lit("factloom:"), F.col("leaf")), 256), 1, 48)


def _fold(previous: str, leaves: list[str]) -> list[str]:
    out = []
    for leaf in leaves:
        previous = hashlib.sha256((previous + leaf).encode()).hexdigest()
        out.append(previous)
    return out


def block_of(block_facts: int = BLOCK_FACTS, base: int = BASE_LSN) -> Column:
    return F.floor((F.col("lsn") - base - 1) / block_facts).cast("long")


def seal(facts: DataFrame, block_facts: int = BLOCK_FACTS, base: int = BASE_LSN, tail: tuple[int, str] | None = None, placed: bool = False) -> DataFrame:
    """Numbered facts with leaf, block, root and checksum: a chain for each block of successive numbers.

    tail: last number and root of what is stored already; the block that it left open goes on from there.
    placed: each block lies in one task already, in order, as assign_lsn_by_chunk leaves it.
    """
    leaves = facts.withColumn("leaf", leaf_hash(facts)).withColumns({"block": block_of(block_facts, base), "checksum": checksum()})
    going_on = -1 if tail is None or (tail[0] - base) % block_facts == 0 else (tail[0] - base) // block_facts
    names = [*leaves.columns, "root"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, root = None, ""
        for batch in batches:
            roots = []
            for b, leaf in zip(batch.column(names.index("block")).to_pylist(), batch.column(names.index("leaf")).to_pylist(), strict=True):
                if b != block:
                    block, root = b, tail[1] if b == going_on else ""
                root = hashlib.sha256((root + leaf).encode()).hexdigest()
                roots.append(root)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots, pa.string())], names)

    dealt = leaves if placed else leaves.repartition("block").sortWithinPartitions("block", "lsn")
    return dealt.mapInArrow(run, StructType([*leaves.schema.fields, StructField("root", StringType())]))


def block_roots(sealed: DataFrame) -> DataFrame:
    """(block, first_lsn, last_lsn, facts, root) of each block."""
    return sealed.groupBy("block").agg(F.min("lsn").alias("first_lsn"), F.max("lsn").alias("last_lsn"), F.count("*").alias("facts"), F.max_by("root", "lsn").alias("root"))


def chained(roots: DataFrame, order: str, previous: str = "", name: str = "anchor") -> DataFrame:
    """roots with the chain of their root column, in order. One ordered task: one row for each block or day."""
    schema = roots.schema.add(name, "string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        root = previous
        for b in batches:
            made = _fold(root, b["root"].tolist())
            root = made[-1] if made else root
            yield b.assign(**{name: made})

    return roots.repartition(1).sortWithinPartitions(order).mapInPandas(run, schema)


def seal_segments(facts: DataFrame, segment: str, block_facts: int = BLOCK_FACTS) -> DataFrame:
    """(segment, first_lsn, last_lsn, facts, root, anchor): a chain for each segment, and one over the segments.

    A segment's chain runs over the roots of its blocks, so that no task gathers more than a block's leaves
    or a segment's block roots.
    """
    leaves = facts.select(F.col(segment).cast("string").alias("segment"), block_of(block_facts).alias("block"), "lsn", leaf_hash(facts).alias("leaf"))

    def fold(rows: DataFrame, keys: list[str], leaf: str) -> DataFrame:
        def run(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
            b = b.sort_values("first_lsn")
            return pd.DataFrame([[*key, b["first_lsn"].iloc[0], b["last_lsn"].max(), b["facts"].sum(), _fold("", b[leaf].tolist())[-1]]], columns=[*keys, "first_lsn", "last_lsn", "facts", "root"])

        kinds = {"segment": "segment string", "block": "block long"}
        return rows.groupBy(*keys).applyInPandas(run, ", ".join(kinds[k] for k in keys) + ", first_lsn long, last_lsn long, facts long, root string")

    single = leaves.select("segment", "block", F.col("lsn").alias("first_lsn"), F.col("lsn").alias("last_lsn"), F.lit(1).cast("long").alias("facts"), "leaf")
    return chained(fold(fold(single, ["segment", "block"], "leaf"), ["segment"], "root"), "segment")


def _walked(sealed: DataFrame, anchors: DataFrame | None, block_facts: int, base: int, after: tuple[int, str] | None) -> DataFrame:
    """(block, lsn, kind, root, reason, at, held) of facts and anchor rows, in one shuffle by block.

    Each row is held against the fact before it, which equals the sequential walk by induction. A fact is bad if
    its leaf or root is wrong, if it comes twice or after a gap; an anchor row if the fact that it names as its last
    isn't there ("missing") or has another root ("anchor"). at: the first number that a fault puts in doubt;
    held: good facts of the block before it.
    """
    whole = F.coalesce(F.col("leaf") == leaf_hash(sealed), F.lit(False))
    rows = sealed.select("block", "lsn", F.lit(0).alias("kind"), "root", "leaf", whole.alias("whole"), F.col("lsn").alias("first"))
    if anchors is not None:
        rows = rows.union(anchors.select("block", F.col("last_lsn").alias("lsn"), F.lit(1), "root", F.lit(None).cast("string"), F.lit(True), F.col("first_lsn")))
    order = Window.partitionBy("block").orderBy("lsn", "kind", "root")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    fact = lambda c: F.last(F.when(F.col("kind") == 0, F.col(c)), ignorenulls=True).over(past)
    rows = rows.withColumns({"last": fact("lsn"), "before": fact("root")})
    start = F.col("block") * block_facts + base + 1
    opens = F.col("lsn") == start
    if after is not None:
        goes_on = F.col("last").isNull() & (F.col("lsn") == after[0] + 1) & ~opens
        rows = rows.withColumn("before", F.when(goes_on, F.lit(after[1])).otherwise(F.col("before"))).withColumn("last", F.when(goes_on, F.lit(after[0])).otherwise(F.col("last")))
    right = F.sha2(F.concat(F.when(opens, "").otherwise(F.coalesce("before", F.lit("?"))), "leaf"), 256)
    reason = F.when(
        F.col("kind") == 0,
        F.when(F.col("lsn") == F.col("last"), "double")
        .when(~F.col("whole"), "leaf")
        .when(~opens & F.col("last").isNotNull() & (F.col("last") != F.col("lsn") - 1), "gap")
        .when((opens | F.col("last").isNotNull()) & F.coalesce(F.col("root") != right, F.lit(True)), "root"),
    ).otherwise(F.when(~F.coalesce(F.col("last") == F.col("lsn"), F.lit(False)), "missing").when(F.coalesce(F.col("root") != F.col("before"), F.lit(True)), "anchor"))
    next_one = F.coalesce(F.col("last") + 1, start)
    at = F.when(F.col("kind") == 0, F.col("lsn")).when(reason == "anchor", F.col("first")).otherwise(F.least(next_one, F.col("lsn")))
    held = F.when(reason == "gap", next_one).otherwise(at) - start
    return rows.select("block", "lsn", "kind", "root", reason.alias("reason"), at.alias("at"), F.greatest(held, F.lit(0)).alias("held"))


def _blocks(walked: DataFrame) -> DataFrame:
    """One row for each block of what _walked gives: its facts, the numbers that they span, its last root, its first fault."""
    fact = F.col("kind") == 0
    of = lambda column, cond: F.when(cond, F.col(column))
    return walked.groupBy("block").agg(
        F.min(of("lsn", fact)).alias("first_lsn"), F.max(of("lsn", fact)).alias("last_lsn"), F.count_if(fact).alias("facts"), F.max_by("root", of("lsn", fact)).alias("root"),
        F.max(of("lsn", ~fact)).alias("anchored_lsn"), F.min(F.when(F.col("reason").isNotNull(), F.struct("at", "held"))).alias("fault"),
    )


def _edges(blocks: DataFrame, base: int, after: tuple[int, str] | None) -> DataFrame:
    """(block, at, held) where a block doesn't go on from the one before it, or the first from what is expected.

    One row for each block passes through the ordered window.
    """
    expected = base if after is None else after[0]
    ends = F.coalesce(F.max("last_lsn").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(expected))
    return blocks.filter("first_lsn is not null").select("block", F.col("first_lsn").alias("at"), ends.alias("ends")).filter("at != ends + 1").select("block", "at", F.lit(0).cast("long").alias("held"))


def bad_facts(sealed: DataFrame, block_facts: int = BLOCK_FACTS, base: int = BASE_LSN, after: tuple[int, str] | None = None) -> DataFrame:
    """(lsn, reason) of facts whose leaf or root is wrong, that come twice, or after a gap.

    A gap at a block's border shows in the blocks' first and last numbers; the first fact must have the number
    after base, or that after the tail ``after`` (number, root) from which sealed goes on.
    """
    walked = _walked(sealed, None, block_facts, base, after)
    gaps = _edges(_blocks(walked), base, after).select(F.col("at").alias("lsn"), F.lit("gap").alias("reason"))
    return walked.filter("reason is not null").select("lsn", "reason").union(gaps).distinct()


def holds(sealed: DataFrame, block_facts: int = BLOCK_FACTS, base: int = BASE_LSN, after: tuple[int, str] | None = None) -> bool:
    """Whether ``bad_facts`` would be empty: facts are shuffled once, and one row is left of each block."""
    blocks = scratch(_blocks(_walked(sealed, None, block_facts, base, after)), "blocks")
    return blocks.filter("fault is not null").isEmpty() and _edges(blocks, base, after).isEmpty()


def anchor_faults(anchors: DataFrame, block_facts: int = BLOCK_FACTS, base: int = BASE_LSN) -> DataFrame:
    """(block, at, held) of anchor rows that the chain of anchors doesn't bear out.

    A row covers the facts from first_lsn to last_lsn of its block; the row that ends before it has the anchor that
    its own is chained to, so that all rows are checked at once by an equi-join.
    """
    ends = anchors.groupBy((F.col("last_lsn") + 1).alias("first_lsn")).agg(F.min("anchor").alias("before"), F.count("*").alias("n"))
    same = anchors.groupBy("first_lsn").agg(F.count("*").alias("rows"))
    met = anchors.join(ends, "first_lsn", "left").join(same, "first_lsn")
    before = F.when(F.col("first_lsn") == base + 1, "").when(F.col("n") == 1, F.col("before"))
    start = F.col("block") * block_facts + base + 1
    inside = (F.col("first_lsn") >= start) & (F.col("last_lsn") < start + block_facts) & (F.col("facts") == F.col("last_lsn") - F.col("first_lsn") + 1)
    right = inside & (F.col("rows") == 1) & (F.col("anchor") == F.sha2(F.concat(before, F.col("root")), 256))
    return met.filter(~F.coalesce(right, F.lit(False))).select("block", F.col("first_lsn").alias("at"), F.greatest(F.col("first_lsn") - start, F.lit(0)).alias("held"))


def verify(sealed: DataFrame, anchors: DataFrame | None = None, block_facts: int = BLOCK_FACTS, base: int = BASE_LSN, trusted: str | None = None) -> DataFrame:
    """One row (status, facts, root): INTEG_OK or VIOLATED, facts before the first one in doubt, last root.

    Facts are read and shuffled once, by block, without their content; what is left is one row for each block.
    Anchors bind the blocks: each row's root is that of the fact it ends with, and its anchor follows from the row
    before it. A row that doesn't hold puts all that it covers in doubt. trusted: the last anchor as known from
    elsewhere; without it, whoever rewrites facts, roots and all later anchors goes unnoticed.
    """
    blocks = scratch(_blocks(_walked(sealed, anchors, block_facts, base, None)), "blocks")
    faults = blocks.filter("fault is not null").select("block", "fault.at", "fault.held").union(_edges(blocks, base, None))
    if anchors is not None:
        start = F.col("block") * block_facts + base + 1
        beyond = F.coalesce(F.col("anchored_lsn") + 1, F.col("first_lsn"))
        faults = faults.union(blocks.filter("facts > 0 and (anchored_lsn is null or last_lsn > anchored_lsn)").select("block", beyond.alias("at"), (beyond - start).alias("held")))
        faults = faults.union(anchor_faults(anchors, block_facts, base))
        if trusted is not None:
            tail = anchors.agg(F.max_by(F.struct("block", "anchor", "first_lsn"), "last_lsn").alias("t"))
            wrong = tail.filter(~F.coalesce(F.col("t.anchor") == trusted, F.lit(False)))
            faults = faults.union(wrong.select(F.coalesce("t.block", F.lit(0)).cast("long"), F.coalesce("t.first_lsn", F.lit(base + 1)).alias("at"), F.lit(0).cast("long")))
    first = faults.agg(F.min(F.struct("at", "block", "held")).alias("f"))
    good = F.when(F.col("f").isNull() | (F.col("block") < F.col("f.block")), F.col("facts")).when(F.col("block") == F.col("f.block"), F.least("facts", "f.held")).otherwise(0)
    counted = blocks.crossJoin(F.broadcast(first)).agg(F.coalesce(F.sum(good), F.lit(0)).alias("facts"), F.max_by("root", "last_lsn").alias("root"))
    status = F.when(F.col("f").isNull(), "INTEG_OK").otherwise("VIOLATED")
    return counted.crossJoin(F.broadcast(first)).select(status.alias("status"), "facts", "root")


def tamper(sealed: DataFrame, lsn: int) -> DataFrame:
    """sealed with the evidence of one fact changed."""
    return sealed.withColumn("raw_hash", F.when(F.col("lsn") == lsn, F.concat(F.lit("x"), F.expr("substring(raw_hash, 2)"))).otherwise(F.col("raw_hash")))
