"""Drift: templates of lines that nothing parses, their clusters, and seeds of new parsers."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions.patterns import strip
from factloom.sources.shared import beside, exists, scratch

# Masks in their order, and what each mask stands for in a suggested pattern.
MASKS = (
    (r"\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:\s(?:UTC|GMT|Z))?", "<TS>"),
    (r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "<IP>"),
    (r"\b[0-9a-fA-F]{12,}\b", "<HEX>"),
    (r'"[^"]*"', "<STR>"),
    (r"\b\d+\b", "<NUM>"),
    (r"(?<==)[A-Za-z0-9_./@:-]+", "<VAL>"),
)
BODIES = {"TS": r"\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}\S*", "IP": r"\d{1,3}(?:\.\d{1,3}){3}", "HEX": r"[0-9a-fA-F]+", "STR": r'[^"]*', "NUM": r"\d+", "VAL": r"[^\s|]+"}
SIMILAR = 0.6


def mask(raw: Column) -> Column:
    """A line with its variable parts masked and white space collapsed."""
    out = strip(raw)
    for pattern, name in MASKS:
        out = F.regexp_replace(out, f"(?U){pattern}", name)
    return F.regexp_replace(out, r"(?U)\s+", " ")


def template_groups(lines: DataFrame) -> DataFrame:
    """(template, count, first_seq, sample) of lines (seq, raw)."""
    return lines.select("seq", "raw", mask(F.col("raw")).alias("template")).groupBy("template").agg(F.count("*").alias("count"), F.min("seq").alias("first_seq"), F.min_by("raw", "seq").alias("sample"))


def tokens(template: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(template, F.lit("([A-Za-z_]+|<[A-Z]+>)"), F.lit(1)))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def _marked_tokens() -> Column:
    """The tokens of a template; those of a template without any are one mark, equal to each other."""
    t = tokens(F.col("template"))
    return F.when(F.size(t) == 0, F.array(F.lit(""))).otherwise(t)


def _similar_sets(sets: DataFrame, least: float, others: DataFrame | None = None) -> DataFrame:
    """(a, b, similarity) of token sets (id, tokens) that reach ``least``: a < b, or a of sets and b of others.

    Two sets that similar share one of the rarest |s| - ceil(least |s|) + 1 tokens of each, so that only those
    are joined, and sets of too different sizes are left out before they are compared. A token that very many sets
    have is a prefix of few, since tokens are taken in order of rarity.
    """
    both = sets if others is None else sets.union(others)
    count = both.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    size = F.size("tokens")

    def prefixes(of: DataFrame, id_: str, n: str) -> DataFrame:
        ranked = of.select("id", F.explode("tokens").alias("token")).join(count, "token")
        ordered = ranked.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "token"))), lambda t: t["token"]).alias("tokens"))
        cut = F.slice("tokens", F.lit(1), (size - F.ceil(size * least - 1e-9) + 1).cast("int"))
        return ordered.select(F.col("id").alias(id_), size.alias(n), F.explode(cut).alias("token"))

    right = sets if others is None else others
    pairs = prefixes(sets, "a", "na").join(prefixes(right, "b", "nb"), "token")
    pairs = pairs.filter(f"na >= {least} * nb - 1e-9 and nb >= {least} * na - 1e-9" + (" and a < b" if others is None else "")).select("a", "b").distinct()
    ta, tb = (df.select(F.col("id").alias(x), F.col("tokens").alias(f"t{x}")) for df, x in ((sets, "a"), (right, "b")))
    shared = F.size(F.array_intersect("ta", "tb"))
    scored = pairs.join(ta, "a").join(tb, "b").select("a", "b", (shared / (F.size("ta") + F.size("tb") - shared)).alias("similarity"))
    return scored.filter(F.col("similarity") >= least)


#: Templates of a pack, about; packs of each side that meet in one task; and most parts of each side, whose square are tasks.
CHUNK = 200
PACKS = 30
PARTS = 250


def similar_templates(groups: DataFrame, least: float = SIMILAR, chunk: int = CHUNK, digits: int | None = None) -> DataFrame:
    """(a, b, similarity) of templates that reach ``least``; a comes first. Equal token sets are compared once.

    A large set has packs of its own, in order of appearance; small sets share packs. What is joined are keys: a pack
    learns which of its sets meet which others, by large set or shared pack. Packs then meet as a product of their
    parts, each of which is read where it was written, so that disk grows with the templates and not with their pairs.
    A task holds a few packs and the rows of two, which Spark gathers before it hands them on. The rows themselves are
    as many as there are pairs. ``digits`` rounds the similarities.
    """
    t = scratch(groups.select("template", "first_seq", F.array_sort(_marked_tokens()).alias("tokens")), "templates")
    sets = scratch(t.groupBy("tokens").agg(F.count("*").alias("n")).withColumn("id", F.monotonically_increasing_id()), "sets")
    small = F.col("n") <= chunk
    shares = -(-(sets.filter(small).agg(F.sum("n")).first()[0] or 1) // chunk)
    group = F.when(small, F.concat(F.lit("pack "), F.pmod(F.xxhash64("id"), F.lit(shares)))).otherwise(F.concat(F.lit("set "), "id"))
    place = F.when(small, 0).otherwise(F.floor(F.monotonically_increasing_id() / chunk))
    placed = _of_sets(t, sets).repartitionByRange("id", "first_seq").sortWithinPartitions("id", "first_seq").select(group.alias("group"), place.alias("place"), "id", "first_seq", "template")
    each = placed.groupBy("group", "place", "id").agg(F.array_sort(F.collect_list(F.struct("first_seq", "template"))).alias("each"))
    packs = scratch(each.groupBy("group", "place").agg(F.map_from_entries(F.collect_list(F.struct("id", "each"))).alias("sets")), "packs")

    near = _similar_sets(sets.select("id", "tokens"), least).union(sets.select("id", "id", F.lit(1.0))).toDF("ia", "ib", "similarity")
    near = near.withColumn("similarity", F.col("similarity") if digits is None else F.round("similarity", digits))
    left, right = (sets.select(F.col("id").alias(f"i{x}"), group.alias(f"g{x}")) for x in "ab")
    links = near.join(left, "ia").join(right, "ib").groupBy("ga", "gb").agg(F.collect_list(F.struct("ia", "ib", "similarity")).alias("links"))
    links = links.groupBy(F.col("ga").alias("group")).agg(F.map_from_entries(F.collect_list(F.struct("gb", "links"))).alias("links"))
    links = scratch(links.join(packs.groupBy("group").agg(F.count("*").alias("n")), "group"), "links")

    session, count = groups.sparkSession, packs.count()
    tasks = max(session.sparkContext.defaultParallelism * 4, int(session.conf.get("spark.sql.shuffle.partitions")))
    parts = max(math.ceil(math.sqrt(tasks)), min(-(-count // PACKS), PARTS))
    own = beside(packs, links, ["group"], count).select(F.col("group").alias("ga"), F.col("place").alias("pa"), F.col("sets").alias("sa"), "links").repartition(parts)
    other = packs.select(F.col("group").alias("gb"), F.col("place").alias("pb"), F.col("sets").alias("sb")).repartition(parts)
    meet = F.try_element_at("links", F.col("gb"))
    both = own.join(other.hint("shuffle_replicate_nl"), meet.isNotNull() & F.expr("ga <> gb or pa <= pb"))
    met = both.select("sa", "sb", F.expr("ga = gb and pa = pb").alias("same"), F.explode(meet).alias("link"))
    lists = met.select("link.similarity", F.expr("same and link.ia = link.ib").alias("own"), F.try_element_at("sa", F.col("link.ia")).alias("ea"), F.try_element_at("sb", F.col("link.ib")).alias("eb"))
    out = lists.select("similarity", "own", "eb", F.explode("ea").alias("x")).select("similarity", "own", "x", F.explode("eb").alias("y"))
    out = out.withColumn("first", F.expr("x.first_seq < y.first_seq")).filter("first or not own and x.first_seq > y.first_seq")
    a, b = (lambda c, p=p, q=q: F.when(F.col("first"), F.col(f"{p}.{c}")).otherwise(F.col(f"{q}.{c}")) for p, q in ("xy", "yx"))
    return out.select(a("template").alias("a"), b("template").alias("b"), a("first_seq").alias("sa"), b("first_seq").alias("sb"), "similarity")


def similar_token_sets(groups: DataFrame, least: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """((a, b, similarity) of token sets that reach ``least``, (template, of) of all templates).

    A set goes by its first template; templates of one set are similar to the same ones, so that pairs of sets and
    membership say what all pairs of templates would.
    """
    t, sets = _token_sets(groups)
    near = _similar_sets(sets.select("id", "tokens"), least)
    left, right = (sets.select(F.col("id").alias(x), F.col("name").alias(f"n{x}")) for x in "ab")
    pairs = near.join(left, "a").join(right, "b").select(F.col("na").alias("a"), F.col("nb").alias("b"), "similarity")
    return pairs, _of_sets(t, sets).select("template", F.col("name").alias("of"))


#: Token sets that one task walks through, about.
PIECE = 20_000
LEADERS = "place long, tokens array<string>, name string"


def _walked(least: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The greedy walk over token sets (id, tokens) in order of id: (id, leader).

    Leaders are known by their rarest tokens, one of which a set that is near enough shares.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"id": [], "tokens": []}), *batches]).sort_values("id")
        sets = [frozenset(t) for t in rows["tokens"]]
        ids = rows["id"].astype("int64").tolist()
        count: dict[str, int] = {}
        for s in sets:
            for t in s:
                count[t] = count.get(t, 0) + 1
        by_token: dict[str, list[int]] = {}
        out = []
        for i, s in enumerate(sets):
            prefix = sorted(s, key=lambda t: (count[t], t))[: len(s) - math.ceil(len(s) * least - 1e-9) + 1]
            near = sorted({k for t in prefix for k in by_token.get(t, ())})
            leader = next((k for k in near if len(s & sets[k]) >= least * len(s | sets[k])), i)
            if leader == i:
                for t in prefix:
                    by_token.setdefault(t, []).append(i)
            out.append(ids[leader])
        yield pd.DataFrame({"id": ids, "leader": out})

    return run


def _assigned(sets: DataFrame, known: DataFrame | None, least: float, piece: int) -> tuple[DataFrame, DataFrame]:
    """((id, leader's place), (place, tokens, name) of all leaders) of token sets (id, tokens, name), after the known ones.

    Pieces of sets in order of id meet the leaders so far by a join; those that join none are walked through in one
    task, which holds a piece at most. The first leader in order that is near enough counts.
    """
    total = sets.count()
    cuts = sorted(set(sets.approxQuantile("id", [k * piece / total for k in range(1, -(-total // piece))], 0.0))) if total > piece else []
    out = None
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = sets.filter((F.lit(True) if low is None else F.col("id") > low) & (F.lit(True) if high is None else F.col("id") <= high))
        rest, joined = part.select("id", "tokens"), None
        if known is not None:
            met = _similar_sets(rest, least, known.select(F.col("place").alias("id"), "tokens"))
            joined = scratch(met.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("leader")), "joined")
            rest = rest.join(joined, "id", "left_anti")
        walked = scratch(rest.repartition(1).mapInPandas(_walked(least), "id long, leader long"), "walked")
        fresh = part.join(walked.filter("id = leader").select("id"), "id").select(F.col("id").alias("place"), "tokens", "name")
        known = scratch(fresh if known is None else known.union(fresh), "leaders")
        both = walked if joined is None else joined.union(walked)
        out = both if out is None else out.union(both)
    return out, known


def _token_sets(groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(templates with their tokens, the distinct token sets (id, tokens, name, n)): a set of n templates goes by its first."""
    t = scratch(groups.select("template", "first_seq", F.array_sort(_marked_tokens()).alias("tokens")), "templates")
    return t, scratch(t.groupBy("tokens").agg(F.min("first_seq").alias("id"), F.min_by("template", "first_seq").alias("name"), F.count("*").alias("n")).select("id", "tokens", "name", "n"), "sets")


def _of_sets(templates: DataFrame, facts: DataFrame) -> DataFrame:
    """Templates joined to the facts of their token sets (tokens, n and more); few sets may hold nearly all templates."""
    return beside(templates, facts, ["tokens"], templates.count())


def leaders(groups: DataFrame, least: float = SIMILAR, piece: int = PIECE) -> DataFrame:
    """(template, leader): greedy in order of appearance; a template joins the first leader near enough.

    Templates of one token set share their fate, that of the first of them.
    """
    t, sets = _token_sets(groups)
    placed, every = _assigned(sets, None, least, piece)
    named = placed.join(every.select(F.col("place").alias("leader"), F.col("name").alias("of")), "leader").join(sets.select("id", "tokens", "n"), "id")
    return _of_sets(t, scratch(named.select("tokens", "n", F.col("of").alias("leader")), "named")).select("template", "leader")


def absorb(lines: DataFrame, path: str, batch_id: int, least: float = SIMILAR, piece: int = PIECE) -> None:
    """Add a batch of drift lines (seq, raw) to the clusters that are kept in the folder path.

    A batch meets the leaders of earlier batches only, and leaves those that are new (``leaders``) and what it
    counted (``counts``); a batch that is absorbed again takes its own place. Batches come in order of seq, which
    makes the clusters those of a walk over all lines.
    """
    spark = lines.sparkSession
    groups = scratch(template_groups(lines), "groups")
    known = None
    if exists(spark, f"{path}/leaders"):
        earlier = spark.read.schema(f"{LEADERS}, batch long").parquet(f"{path}/leaders").filter(F.col("batch") < batch_id).drop("batch")
        known = scratch(earlier, "known")
    t, sets = _token_sets(groups)
    placed, every = _assigned(sets, known, least, piece)
    ids = scratch(placed.join(sets.select("id", "tokens", "n"), "id").select("tokens", "n", "leader"), "placed")
    counted = groups.join(_of_sets(t, ids).select("template", "leader"), "template")
    sums = counted.groupBy(F.col("leader").alias("place")).agg(F.sum("count").alias("count"), F.min("first_seq").alias("first_seq"), F.min_by("sample", "first_seq").alias("sample"))
    fresh = every if known is None else every.join(known.select("place"), "place", "left_anti")
    fresh.coalesce(1).write.mode("overwrite").parquet(f"{path}/leaders/batch={batch_id}")
    sums.coalesce(1).write.mode("overwrite").parquet(f"{path}/counts/batch={batch_id}")


def absorbed(spark: SparkSession, path: str) -> DataFrame:
    """(template, count, first_seq, sample) of the clusters kept in path, by their leaders."""
    counts = spark.read.schema("place long, count long, first_seq long, sample string").parquet(f"{path}/counts")
    named = spark.read.schema(LEADERS).parquet(f"{path}/leaders").select("place", F.col("name").alias("template"))
    sums = counts.groupBy("place").agg(F.sum("count").alias("count"), F.min("first_seq").alias("first_seq"), F.min_by("sample", "first_seq").alias("sample"))
    return sums.join(named, "place").select("template", "count", "first_seq", "sample")


def suggest(template: str) -> str:
    """An anchored pattern with a numbered named group for each mask; runs on cluster rows only."""
    count: dict[str, int] = {}
    out = []
    for part in re.split(r"(<(?:TS|IP|HEX|STR|NUM|VAL)>)", template):
        name = part[1:-1]
        if part[:1] == "<" and name in BODIES:
            count[name] = count.get(name, 0) + 1
            body = f"(?P<{name.lower()}{count[name]}>{BODIES[name]})"
            out.append(f'"{body}"' if name == "STR" else body)
        else:
            out.append(re.escape(part))
    return "^" + "".join(out) + "$"


def _seed(template: str) -> tuple[str, bool]:
    pattern = suggest(template)
    try:
        re.compile(pattern)
    except re.error:
        return pattern, False
    return pattern, True


def cluster_report(lines: DataFrame, least: float = SIMILAR) -> DataFrame:
    """(template, count, coverage_pct, sample, suggested_regex, regex_valid), largest cluster first."""
    groups = scratch(template_groups(lines), "groups")
    sizes = groups.join(leaders(groups, least), "template").groupBy("leader").agg(F.sum("count").alias("count"))
    total = groups.agg(F.sum("count").alias("total"))
    own = groups.select(F.col("template").alias("leader"), "first_seq", "sample")
    out = sizes.join(own, "leader").crossJoin(F.broadcast(total)).orderBy(F.desc("count"), "first_seq")
    return out.select(F.col("leader").alias("template"), "count", F.round(100 * F.col("count") / F.col("total"), 1).alias("coverage_pct"), F.substring("sample", 1, 90).alias("sample"), F.inline(F.array(F.udf(_seed, "suggested_regex string, regex_valid boolean", useArrow=False)("leader"))))


def entropy(sizes: DataFrame, count: str = "count") -> DataFrame:
    """(entropy): Shannon entropy in bits of group sizes, 3 decimals; 0 for none."""
    total = sizes.agg(F.sum(count).alias("total"))
    p = F.col(count) / F.col("total")
    return sizes.crossJoin(F.broadcast(total)).agg(F.coalesce(F.round(F.sum(-p * F.log2(p)), 3), F.lit(0.0)).alias("entropy"))
