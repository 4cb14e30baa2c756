"""Sliding counts by actor, the escalation of facts, and sessions, in batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.plans.connector import Signature
from factloom.sources.shared import scratch

#: An actor with more facts than this inside one window's length is counted over range partitions.
HOT_FACTS = 500_000
#: A fact takes more bytes than this in a plan's estimate.
FACT_BYTES = 128


def _actor() -> Column:
    """All facts without an actor share one window."""
    return F.coalesce("actor", F.lit("unknown"))


def _window_counts(rows: DataFrame, trigger: Column, window_secs: int, name: str) -> DataFrame:
    """rows with the column ``name``: how many rows with trigger the actor has had within the window so far.

    Null for other rows. Equal timestamps count by order of arrival (seq). An actor's rows are dealt by stretches of
    one window's length, each of which also holds copies of the stretch before, so that an actor of any number of rows
    spreads over many tasks. A row stands where its window starts, among the copies: those before it have left the
    window. Both counts run on from row to row, so that work doesn't grow with the window's content.
    """
    span = window_secs * 1_000_000
    stretch = F.floor(F.col("system_timestamp") / span)
    copies = rows.withColumn("__copy", F.explode(F.when(trigger, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    copies = copies.withColumns({"__stretch": stretch + F.col("__copy"), "__at": F.col("system_timestamp") - F.when(F.col("__copy") == 0, span).otherwise(0)})
    whole = Window.partitionBy(_actor(), F.coalesce(trigger, F.lit(False)), "__stretch")
    so_far = whole.orderBy("__at", "__copy", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n = F.sum(1 - F.col("__copy")).over(so_far) + F.sum("__copy").over(whole) - F.sum("__copy").over(so_far)
    return copies.withColumn(name, F.when(trigger, n).cast("long")).filter("__copy = 0").drop("__stretch", "__copy", "__at")


def _counted_in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(id, kind, part, who, so_far) of rows sorted by who and time: facts of the actor up to each row, in this task."""
    last, carry = None, 0
    for b in batches:
        if not len(b):
            continue
        who = b["who"].to_numpy()
        seen = np.cumsum(b["kind"].to_numpy())
        first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        base = np.repeat(np.r_[0, seen[first[1:] - 1]], np.diff(np.r_[first, len(b)]))
        so_far = seen - base
        if who[0] == last:
            so_far[: first[1] if len(first) > 1 else len(b)] += carry
        last, carry = who[-1], int(so_far[-1])
        yield b[["id", "kind", "part", "who"]].assign(so_far=so_far)


def _range_counts(rows: DataFrame, window_secs: int, name: str) -> DataFrame:
    """rows, all of which count, with ``name`` as _window_counts gives it, for actors of any number of facts in a window.

    Each fact asks at its window's start how many facts came before it. Facts and questions are sorted together
    by actor and time in range partitions, counted there, and what earlier partitions hold of an actor is carried
    over: one row for each partition and actor. A fact's count is its own number less that of its question. Facts
    of one actor, even of one instant, spread over all partitions.
    """
    span = window_secs * 1_000_000
    stored = scratch(rows.withColumn("__id", F.monotonically_increasing_id()), "hot-facts")
    facts = stored.select(_actor().alias("who"), F.col("system_timestamp").alias("at"), F.lit(1).alias("kind"), "seq", F.col("__id").alias("id"))
    asked = facts.select("who", (F.col("at") - span).alias("at"), F.lit(0).alias("kind"), "seq", "id")
    order = ("who", "at", "kind", "seq", "id")
    placed = facts.union(asked).repartitionByRange(*order).sortWithinPartitions(*order)
    counted = placed.withColumn("part", F.spark_partition_id()).select("id", "kind", "part", "who").mapInPandas(_counted_in_order, "id long, kind int, part int, who string, so_far long")
    counted = scratch(counted, "hot-counts")
    held = counted.groupBy("part", "who").agg(F.sum("kind").alias("n"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("who").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    carried = scratch(held.select("part", "who", earlier.alias("earlier")), "hot-carried")
    placed_at = counted.join(carried, ["part", "who"]).select("id", "kind", (F.col("so_far") + F.col("earlier")).alias("n"))
    both = placed_at.groupBy(F.col("id").alias("__id")).agg((F.sum(F.when(F.col("kind") == 1, F.col("n"))) - F.sum(F.when(F.col("kind") == 0, F.col("n")))).alias(name))
    return stored.join(both, "__id").select(*rows.columns, name)


def _hot_actors(rows: DataFrame, trigger: Column, window_secs: int, hot_facts: int) -> DataFrame | None:
    """(who) of actors with over hot_facts triggers inside one stretch of the window's length; None if there are none."""
    stretch = F.floor(F.col("system_timestamp") / (window_secs * 1_000_000))
    crowded = rows.filter(trigger).groupBy(_actor().alias("who"), stretch.alias("stretch")).count().filter(F.col("count") > hot_facts)
    hot = scratch(crowded.select("who").distinct(), "hot-actors")
    return None if hot.isEmpty() else hot


def escalate_where(facts: DataFrame, watched: list[tuple[Column, Signature]], hot_facts: int = HOT_FACTS) -> DataFrame:
    """facts with class and risk of the last signature that fires, and ``window_count`` of its window.

    watched: signatures, each with the facts that count for it. Only these are shuffled; the others pass by. An
    actor whose facts crowd a window is counted over range partitions, the others by stretches of it.
    """
    some = F.lit(False)
    for trigger, _ in watched:
        some = some | F.coalesce(trigger, F.lit(False))
    out = facts.filter(some).withColumn("window_count", F.lit(0).cast("long"))
    # where the plan's own estimate says that there can't be so many facts, nothing is written or counted first
    crowded = int(str(out._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > hot_facts * FACT_BYTES
    if crowded:
        out = scratch(out, "watched")
        crowded = out.count() > hot_facts
    base = out
    for k, (trigger, s) in enumerate(watched):
        hot = _hot_actors(base, trigger, s.window_secs, hot_facts) if crowded else None
        if hot is None:
            out = _window_counts(out, trigger, s.window_secs, "__n")
        else:
            crowd = F.coalesce(trigger, F.lit(False))
            of_hot = out.filter(crowd).join(hot, _actor() == F.col("who"), "left_semi")
            rest = out.join(hot, crowd & (_actor() == F.col("who")), "left_anti")
            out = _window_counts(rest, trigger, s.window_secs, "__n").union(_range_counts(of_hot, s.window_secs, "__n"))
        fires = F.coalesce(F.col("__n") >= s.threshold, F.lit(False))
        out = out.withColumns({
            "class": F.when(fires, s.behavior_class).otherwise(F.col("class")),
            "risk": F.when(fires, s.risk).otherwise(F.col("risk")),
            "window_count": F.coalesce("__n", "window_count"),
        }).drop("__n")
        if hot is not None and k < len(watched) - 1:
            out = scratch(out, "watched")
    return out.union(facts.filter(~some).withColumn("window_count", F.lit(0).cast("long")))


def escalate(facts: DataFrame, signatures: tuple[Signature, ...], hot_facts: int = HOT_FACTS) -> DataFrame:
    """``escalate_where`` with the action of each signature as its trigger."""
    return escalate_where(facts, [(F.col("action") == s.action, s) for s in signatures], hot_facts)


def sessions(facts: DataFrame, gap: str) -> DataFrame:
    """(actor, opened, closed, facts, actions, worst) of each actor's sessions: facts at most gap apart.

    closed is gap after the last fact. Partial sessions of a task are merged before they are shuffled
    (spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition), so that a busy actor sends few rows.
    The same call works on a stream that has a watermark on ``obs_ts``. worst: the highest risk, in its order.
    """
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, RISKS)), F.col("risk")), F.lit(0))
    grouped = facts.groupBy(_actor().alias("actor"), F.session_window("obs_ts", gap).alias("session"))
    made = grouped.agg(F.count("*").alias("facts"), F.array_join(F.array_sort(F.collect_set("action")), ",").alias("actions"), F.max(rank).alias("rank"))
    worst = F.get(F.array(*map(F.lit, RISKS)), (F.col("rank") - 1).cast("int"))
    return made.select("actor", F.col("session.start").alias("opened"), F.col("session.end").alias("closed"), "facts", "actions", worst.alias("worst"))


# Risks in ascending order.
RISKS = ("Low", "Medium", "High", "Critical")
