"""Recent facts, statistics, daily series, as-of views and replica checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def recent(facts: DataFrame, n: int = 20) -> DataFrame:
    """The newest facts, 200 at most."""
    return facts.orderBy(F.desc("lsn")).limit(min(n, 200))


def stats(facts: DataFrame) -> DataFrame:
    return facts.agg(F.count("*").alias("events"), F.max("lsn").alias("head"))


def daily(facts: DataFrame) -> DataFrame:
    """(day, volume, cumulative_lsn): the running total needs one row a day only."""
    days = facts.groupBy(F.to_date(F.timestamp_micros("system_timestamp")).alias("day")).agg(F.count("*").alias("volume"))
    return days.withColumn("cumulative", F.sum("volume").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)))


def trailing(daily_rows: DataFrame, entries: int = 30) -> DataFrame:
    """daily_rows with ``trailing``: the volume of so many entries up to each."""
    return daily_rows.withColumn("trailing", F.sum("volume").over(Window.orderBy("day").rowsBetween(1 - entries, 0)))


def density(volume: Column, limits: tuple[int, int, int] = (225_000, 240_000, 255_000), beyond: Column | None = None) -> Column:
    """Level 1 to 4 of a daily volume; 0 where beyond holds, as on days after the one that is looked back from."""
    a, b, c = limits
    return F.when(F.lit(False) if beyond is None else beyond, 0).when(volume < a, 1).when(volume < b, 2).when(volume < c, 3).otherwise(4)


def split_volume(volume: Column) -> list[Column]:
    return [(volume * share).cast("long").alias(name) for name, share in (("primary", 0.55), ("secondary", 0.25), ("tertiary", 0.20))]


def as_of(daily_rows: DataFrame, day: str) -> DataFrame:
    return daily_rows.filter(F.col("day") <= F.to_date(F.lit(day))).agg(F.max_by("cumulative", "day").alias("cumulative"), F.max("day").alias("day"))


def graph_as_of(nodes: DataFrame, lsn: int, halo: int) -> DataFrame:
    """Nodes known at lsn; fresh while younger than halo."""
    return nodes.filter(F.col("lsn_start") <= lsn).withColumn("fresh", lsn - F.col("lsn_start") < halo)


def edges_as_of(facts: DataFrame, lsn: int) -> DataFrame:
    """(actor, target, lsn_start) of the pairs that facts up to lsn connect."""
    known = facts.filter((F.col("lsn") <= lsn) & F.col("actor").isNotNull() & F.col("target").isNotNull())
    return known.groupBy("actor", "target").agg(F.min("lsn").alias("lsn_start"))


def short_number(x: Column) -> Column:
    """1,2K / 3M / 4,56B."""
    text = F.when(x >= 1e9, F.concat(F.format_string("%.2f", x / 1e9), F.lit("B"))).when(x >= 1e6, F.concat(F.format_string("%.2f", x / 1e6), F.lit("M"))).when(x >= 1e3, F.concat(F.format_string("%.1f", x / 1e3), F.lit("K"))).otherwise(F.format_string("%.0f", x.cast("double")))
    return F.replace(text, F.lit("."), F.lit(","))


def missing_range(leader: DataFrame, follower: DataFrame) -> DataFrame:
    """Facts that the follower lacks."""
    return leader.join(follower.select("lsn"), "lsn", "left_anti")


def divergence(leader: DataFrame, follower: DataFrame) -> DataFrame:
    """(lsn): the first number whose roots differ; null if none does."""
    both = leader.select("lsn", F.col("root").alias("a")).join(follower.select("lsn", F.col("root").alias("b")), "lsn")
    return both.agg(F.min(F.when(~F.col("a").eqNullSafe(F.col("b")), F.col("lsn"))).alias("lsn"))


def accepts(follower: DataFrame, previous_lsn: int, previous_root: str) -> DataFrame:
    """(accepted): whether the follower's tail is what the leader's append builds on."""
    return follower.agg(F.coalesce((F.max("lsn") == previous_lsn) & (F.max_by("root", "lsn") == previous_root), F.lit(False)).alias("accepted"))


def commit_lsn(tails: DataFrame) -> DataFrame:
    """(commit_lsn): the largest number that a majority of replicas (one row each) has."""
    return tails.agg(F.sort_array(F.collect_list("lsn"), asc=False).alias("l")).select(F.get("l", F.floor(F.size("l") / 2).cast("int")).alias("commit_lsn"))


def converged(tails: DataFrame) -> DataFrame:
    return tails.agg(((F.countDistinct("root") == 1) & (F.countDistinct("lsn") == 1)).alias("converged"))
