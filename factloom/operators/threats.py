"""Facts tagged by providers of threat indicators, given as tables.

An indicator (provider, tag, kind, value) names an action, a class, or a range of IPv4 addresses that the
source of a fact lies in (kind ``action``, ``class`` or ``range``; 10.0.0.0/8, or an address alone). Ranges may be
nested: of those of one provider the longest wins, with all its tags. All providers are met in one pass: what
facts have in common is tagged once, since tags depend on action, class and source alone, and a range is met by
an equi-join of the address's prefixes, one for each length that occurs among the ranges (33 at most).

Values that are no range, sources that are no IPv4 address, and nulls match nothing; repeated indicators count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.sources.shared import scratch

KEYS = ("action", "class", "source_ip")


def address(text: Column) -> Column:
    """An IPv4 address as a number; null for all else."""
    parts = F.split(text, r"\.")
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda n, p: n * 256 + p.try_cast("long"))
    return F.when(text.rlike(r"\A(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?:\.(?!\z)|\z)){4}\z"), number)


def _prefix(number: Column, length: Column) -> Column:
    return F.floor(number / F.pow(F.lit(2.0), 32 - length)).cast("long")


def ranges(indicators: DataFrame) -> DataFrame:
    """(provider, tag, length, prefix) of the indicators that are ranges."""
    parts = F.split("value", "/")
    length = F.when(F.size(parts) == 1, 32).when((F.size(parts) == 2) & F.get(parts, F.lit(1)).rlike(r"\A(?:3[0-2]|[12]?\d)\z"), F.get(parts, F.lit(1)).try_cast("int"))
    found = indicators.filter("kind = 'range'").select("provider", "tag", length.alias("length"), address(F.get(parts, F.lit(0))).alias("number"))
    return found.filter("length is not null and number is not null").select("provider", "tag", "length", _prefix(F.col("number"), F.col("length")).alias("prefix")).distinct()


def tagged(facts: DataFrame, indicators: DataFrame) -> DataFrame:
    """facts with ``tags``: array of (provider, tag, kind) in order, empty where nothing matches."""
    known = indicators.filter("provider is not null and tag is not null")
    spans = scratch(ranges(known), "ranges")
    lengths = [r[0] for r in spans.select("length").distinct().orderBy("length").collect()]
    alike = scratch(facts.groupBy(*KEYS).agg(F.count("*").alias("facts")), "alike").select(*KEYS, F.monotonically_increasing_id().alias("id"))
    alike = scratch(alike, "alike")
    plain = known.filter("kind in ('action', 'class')").select("provider", "tag", "kind", "value").distinct()
    sought = alike.select("id", F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in ("action", "class")))).alias("k")).select("id", "k.*")
    named = sought.join(plain, ["kind", "value"]).select("id", "provider", "tag", "kind")
    number = address(F.col("source_ip"))
    prefixes = F.array(*(F.struct(F.lit(n).alias("length"), _prefix(number, F.lit(n)).alias("prefix")) for n in lengths)).cast("array<struct<length:int,prefix:bigint>>")
    inside = alike.filter(number.isNotNull()).select("id", F.inline(prefixes)).join(spans, ["length", "prefix"])
    longest = inside.groupBy("id", "provider", "length").agg(F.collect_set("tag").alias("tags")).groupBy("id", "provider").agg(F.max_by("tags", "length").alias("tags"))
    hit = named.union(longest.select("id", "provider", F.explode("tags").alias("tag"), F.lit("range").alias("kind")))
    tags = hit.groupBy("id").agg(F.array_sort(F.collect_set(F.struct("provider", "tag", "kind"))).alias("tags"))
    # written, so that the join knows its size and can split a crowded key
    given = scratch(alike.join(tags, "id").select(*(F.col(k).alias(f"__{k}") for k in KEYS), "tags"), "tags")
    same = None
    for k in KEYS:
        one = F.col(k).eqNullSafe(F.col(f"__{k}"))
        same = one if same is None else same & one
    none = F.array().cast("array<struct<provider:string,tag:string,kind:string>>")
    return facts.join(given, same, "left").drop(*(f"__{k}" for k in KEYS)).withColumn("tags", F.coalesce("tags", none))


def tag_counts(facts: DataFrame) -> DataFrame:
    """(provider, tag, kind, facts): how many tagged facts each tag has."""
    return facts.select(F.explode("tags").alias("t")).groupBy("t.provider", "t.tag", "t.kind").agg(F.count("*").alias("facts"))
