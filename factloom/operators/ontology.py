"""Hierarchies of classes: what lies below what, and counts rolled up on every level.

A hierarchy is a table (class, parent); a null parent, or none, makes a root. A class may have several parents;
what lies below an ancestor by more than one way counts there once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.sources.shared import scratch


def closure(tree: DataFrame) -> DataFrame:
    """(class, ancestor, distance) of each class and all that it lies below, itself at distance 0.

    Ways are doubled: a round joins the ways of the greatest length to all that are known, so that rounds grow with
    the logarithm of the depth. A cycle is an error, found once a way leads back to where it began.
    """
    edges = tree.select(F.col("class").cast("string").alias("class"), F.col("parent").cast("string").alias("parent")).filter("class is not null")
    nodes = edges.select("class").union(edges.filter("parent is not null").select("parent")).distinct()
    ways = scratch(edges.filter("parent is not null").distinct().select("class", F.col("parent").alias("ancestor"), F.lit(1).cast("long").alias("distance")), "ways")
    longest = 1
    while True:
        back = ways.filter("class = ancestor").select("class").first()
        if back:
            raise ValueError(f"{back[0]} lies below itself")
        ends = ways.filter(F.col("distance") == longest)
        if ends.isEmpty():
            break
        onward = ways.select(F.col("class").alias("ancestor"), F.col("ancestor").alias("next"), F.col("distance").alias("more"))
        longer = ends.join(onward, "ancestor").select("class", F.col("next").alias("ancestor"), (F.col("distance") + F.col("more")).alias("distance"))
        ways = scratch(ways.union(longer.distinct()), "ways")
        longest *= 2
    shortest = ways.groupBy("class", "ancestor").agg(F.min("distance").alias("distance"))
    return shortest.union(nodes.select("class", F.col("class").alias("ancestor"), F.lit(0).cast("long")))


def rolled_up(facts: DataFrame, tree: DataFrame, name: str = "class") -> DataFrame:
    """(class, level, own, total) of each class of the tree or of facts: facts of the class, and of all below it.

    level: how far the class lies from the farthest root; classes that the tree doesn't know are roots. Facts are
    counted before anything is joined: what is rolled up is one row for each class.
    """
    own = facts.groupBy(F.coalesce(F.col(name).cast("string"), F.lit("")).alias("class")).agg(F.count("*").alias("own"))
    below = scratch(closure(tree), "closure")
    strange = own.join(below.select("class").distinct(), "class", "left_anti").select("class", F.col("class").alias("ancestor"), F.lit(0).cast("long").alias("distance"))
    every = below.union(strange)
    depth = every.groupBy("class").agg(F.max("distance").alias("level"))
    counted = every.join(own, "class", "left").groupBy(F.col("ancestor").alias("class")).agg(F.sum(F.coalesce("own", F.lit(0))).alias("total"), F.sum(F.when(F.col("distance") == 0, F.coalesce("own", F.lit(0)))).alias("own"))
    return counted.join(depth, "class").select("class", "level", "own", "total")
