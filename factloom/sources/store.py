"""The fact store: sealed facts as Parquet by append, and a table of anchors that says what is valid.

A store is a folder with ``facts`` (a folder for each append, named by its first number) and ``anchors``
(one row for each block that an append touched). Facts count once their anchors are written: a failed
append leaves no trace in reads, and its repetition takes its place.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import ledger
from factloom.sources.shared import exists, scratch

ANCHOR = "block long, first_lsn long, last_lsn long, facts long, root string, anchor string, batch_id long"
#: Leaves and roots are hexadecimal text, of which this leaves about half.
PACKED = "zstd"
NEEDED = {*ledger.SEALED, *ledger.INTEGRITY}


def anchors(spark: SparkSession, path: str) -> DataFrame:
    """The anchor rows of a store; none where there is no store yet."""
    return spark.read.schema(ANCHOR).parquet(f"{path}/anchors") if exists(spark, f"{path}/anchors") else spark.createDataFrame([], ANCHOR)


def tail(spark: SparkSession, path: str) -> tuple[int, str, str, int] | None:
    """(last number, root, anchor, last batch id) of a store, from its anchors alone; None where it has none."""
    if not exists(spark, f"{path}/anchors"):
        return None
    t = anchors(spark, path).agg(F.max("last_lsn"), F.max_by("root", "last_lsn"), F.max_by("anchor", "last_lsn"), F.max("batch_id")).first()
    return None if t[0] is None else tuple(t)


def block_size(spark: SparkSession, path: str) -> int:
    """Facts in a block of a store, as far as its anchors show: where the second block begins, or else the usual number."""
    second = anchors(spark, path).filter("block = 1").agg(F.min("first_lsn")).first()[0]
    return ledger.BLOCK_FACTS if second is None else second - ledger.BASE_LSN - 1


def append(facts: DataFrame, path: str, batch_id: int | None = None, block_facts: int = ledger.BLOCK_FACTS) -> None:
    """Number, seal and store facts after a store's tail. A batch_id that is stored already is skipped."""
    spark = facts.sparkSession
    end = tail(spark, path)
    if end and batch_id is not None and end[3] is not None and batch_id <= end[3]:
        return
    base = end[0] if end else ledger.BASE_LSN
    placed = ledger.assign_lsn_by_chunk(facts, base=base, block_facts=block_facts)
    numbered = placed[0] if placed else ledger.assign_lsn(facts, base=base)
    sealed = ledger.seal(numbered, block_facts, tail=end and end[:2], placed=placed is not None)
    where = f"{path}/facts/append={base + 1}"
    sealed.write.mode("overwrite").option("compression", PACKED).parquet(where)
    made = scratch(ledger.block_roots(spark.read.schema(sealed.schema).parquet(where).select("block", "lsn", "root")), "roots")
    if placed and (made.agg(F.sum("facts")).first()[0] or 0) != placed[1] - base:
        raise RuntimeError("the facts that were stored aren't those that were numbered")
    rows = ledger.chained(made, "block", end[2] if end else "").withColumn("batch_id", F.lit(batch_id).cast("long"))
    rows.coalesce(1).write.mode("append").parquet(f"{path}/anchors")


def catch_up(spark: SparkSession, leader: str, follower: str, upto: int | None = None) -> bool:
    """Append to the follower's store, as they are, the leader's facts after its tail; whether it accepts them.

    It does if the leader's fact at the follower's tail has the same root (an empty follower asks for none) and the
    leaves, numbers and chains of what comes in go on from there; only then are they anchored, so that facts which
    are refused don't count. upto: the last number to take over, by default the leader's tail.
    """
    end = tail(spark, follower)
    base = end[0] if end else ledger.BASE_LSN
    facts = read(spark, leader)
    if end and facts.filter((F.col("lsn") == base) & (F.col("root") == end[1])).isEmpty():
        return False
    new = facts.filter((F.col("lsn") > base) & (F.col("lsn") <= upto if upto is not None else F.lit(True)))
    where = f"{follower}/facts/append={base + 1}"
    new.write.mode("overwrite").option("compression", PACKED).parquet(where)
    came = spark.read.schema(facts.schema).parquet(where)
    if not ledger.holds(came, block_size(spark, leader), after=end and end[:2]):
        return False
    made = ledger.block_roots(came.select("block", "lsn", "root"))
    rows = ledger.chained(made, "block", end[2] if end else "").withColumn("batch_id", F.lit(None).cast("long"))
    rows.coalesce(1).write.mode("append").parquet(f"{follower}/anchors")
    return True


def read(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    """The facts that anchors cover; ordered: by number, as they were stored."""
    end = tail(spark, path)
    facts = spark.read.parquet(f"{path}/facts").drop("append")
    facts = facts.filter(F.col("lsn") <= (end[0] if end else ledger.BASE_LSN))
    return facts.orderBy("lsn") if ordered else facts


def verify(spark: SparkSession, path: str, block_facts: int = ledger.BLOCK_FACTS, trusted: str | None = None) -> DataFrame:
    """One row (status, facts, root): ERROR without a store, CORRUPTED where its files or columns aren't a
    store's, else what ledger.verify says of its facts and anchors."""
    try:
        facts = spark.read.parquet(f"{path}/facts").drop("append")
    except AnalysisException as e:
        status = "ERROR" if e.getCondition() == "PATH_NOT_FOUND" else "CORRUPTED"
        return spark.createDataFrame([(status, 0, None)], "status string, facts long, root string")
    if NEEDED - set(facts.columns):
        return spark.createDataFrame([("CORRUPTED", 0, None)], "status string, facts long, root string")
    return ledger.verify(read(spark, path), anchors(spark, path), block_facts, trusted=trusted)
