"""Connected components by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import beside, scratch


def _star(edges: DataFrame, large: bool, total: int) -> DataFrame:
    """Link each node's larger (or smaller) neighbours to the least of its neighbourhood.

    The least neighbour comes from an aggregate with partial sums; that of a node with very many
    neighbours is broadcast to its edges. total: edges, at least.
    """
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    else:
        both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("n")).select("u", F.least("u", "low").alias("m"), "n")
    joined = beside(both, least, ["u"], 2 * total)
    moved = joined.filter("v > u" if large else "v <= u").select(F.col("v").alias("x"), "m")
    if not large:
        moved = moved.union(least.select(F.col("u").alias("x"), "m"))
    return moved.filter("x != m").select(F.col("m").alias("a"), F.col("x").alias("b"))


def _settled(edges: DataFrame) -> bool:
    """Whether edges (a, b) are stars: each b has one a, which is no b itself. One shuffle of partial sums."""
    ends = edges.select(F.col("a").alias("x"), F.lit(True).alias("top"), F.lit(0).alias("n")).union(edges.select("b", F.lit(False), F.lit(1)))
    nodes = ends.groupBy("x").agg(F.max("top").alias("top"), F.sum("n").alias("n"))
    return nodes.filter("n > 1 or top and n > 0").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component) for every node on an edge; component is the smallest node that it reaches.

    Rounds go on until only stars are left; ``rounds`` guards against an endless loop, and running out of
    it is an error.
    """
    now = scratch(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a != b").distinct(), "edges")
    for _ in range(rounds):
        if _settled(now):
            break
        total = now.count()
        now = scratch(_star(_star(now, True, total), False, total).distinct(), "edges")
    else:
        raise RuntimeError("connected components did not settle")
    stars = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return stars.union(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
