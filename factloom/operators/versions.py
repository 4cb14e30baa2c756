"""What changes when a connector is replaced by another version of itself: stored lines read by both in one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.patterns import captured, strip, to_java, told_apart
from factloom.operators import ingest
from factloom.plans.connector import Connector

FIELDS = ("rule_id", "action", "class", "risk", "actor", "target", "source_ip")


def _finding(connector: Connector, raw: Column) -> Column:
    """What the connector finds in a line: groups by place, or keys and values; null if it can't read it."""
    if connector.pattern is None:
        pairs = ingest.key_values(raw)
        return F.when(F.size(pairs) > 0, pairs)
    return captured(strip(raw), connector.pattern)[0]


def _tokens(connector: Connector, found: Column) -> dict | ingest.Mapping:
    if connector.pattern is None:
        return ingest.token_columns(connector, found)
    names = to_java(connector.pattern)[1]
    return told_apart(strip(F.col("raw")), connector.pattern, {n: F.get(found, F.lit(i)) for i, n in enumerate(names)})


def compared(lines: DataFrame, old: Connector, new: Connector) -> DataFrame:
    """lines (seq, raw, ...) with ``old`` and ``new``, the outcome of each version, and ``change``.

    An outcome is null where the version can't read the line. change: ``same``, ``changed`` (in whatever field),
    ``gained`` (only the new version reads the line), ``lost``, or ``drift`` (neither does). Versions of one
    pattern share its findings; a line is scanned once for both.
    """
    raw = F.col("raw")
    shared = old.pattern == new.pattern
    found = [_finding(old, raw).alias("old")] + ([] if shared else [_finding(new, raw).alias("new")])
    once = lines.select("*", F.explode(F.array(F.struct(*found))).alias("__found"))
    of = {"old": F.col("__found.old"), "new": F.col("__found.old" if shared else "__found.new")}
    outcomes = (F.when(of[name].isNotNull(), ingest.rule_outcome(_tokens(connector, of[name]), connector)).alias(name) for name, connector in (("old", old), ("new", new)))
    once = once.select("*", F.explode(F.array(F.struct(*outcomes))).alias("__told"))
    for name in ("old", "new"):
        once = once.withColumn(name, F.when(F.col(f"__told.{name}").isNotNull(), ingest.emptied(f"__told.{name}")))
    a, b = F.col("old"), F.col("new")
    change = F.when(a.isNull() & b.isNull(), "drift").when(a.isNull(), "gained").when(b.isNull(), "lost").when(a.eqNullSafe(b), "same").otherwise("changed")
    return once.drop("__found", "__told").withColumn("change", change)


def difference(both: DataFrame) -> DataFrame:
    """(change, old_rule, new_rule, old_class, new_class, old_risk, new_risk, lines, first_seq, sample) of all but ``same``.

    risk_step: how far the risk rises, or falls, in its order; null where one version doesn't read the lines.
    """
    sides = [F.col(f"{side}.{field}").alias(f"{side}_{name}") for field, name in (("rule_id", "rule"), ("class", "class"), ("risk", "risk")) for side in ("old", "new")]
    by = [f"{side}_{name}" for name in ("rule", "class", "risk") for side in ("old", "new")]
    rows = both.filter("change != 'same'").select("change", "seq", "raw", *sides)
    place = lambda c: F.array_position(F.array(*map(F.lit, RISKS)), F.col(c))
    known = F.when((place("old_risk") > 0) & (place("new_risk") > 0), place("new_risk") - place("old_risk"))
    return rows.groupBy("change", *by).agg(F.count("*").alias("lines"), F.min("seq").alias("first_seq"), F.min_by(F.substring("raw", 1, 90), "seq").alias("sample")).withColumn("risk_step", known)


# Risks in ascending order.
RISKS = ("Low", "Medium", "High", "Critical")
