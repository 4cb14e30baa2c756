"""Lines of many sources at once: each is dealt to a connector, parsed, classified and watched in one pass.

A registry knows connectors by source. Lines of a source that it doesn't know are offered to its formats, in
order, and go to the first that can read them. A line that nothing takes is kept with the reason: ``no_connector``
(no format reads a line of an unknown source) or ``drift`` (the connector of its source can't read it).
Nothing is scanned or parsed a second time: what a line's own connector finds in it is one column of a CASE by
connector, generated once a line, and the rules of all connectors are the branches of another.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.patterns import captured, once, strip, to_java, told_apart
from factloom.operators import behavior, ingest
from factloom.plans.connector import Connector, Signature, execution_order

NO_CONNECTOR, DRIFT = "no_connector", "drift"


@dataclass(frozen=True)
class Registry:
    """Connectors by source, and those that lines of other sources are offered to."""

    by_source: dict[str, Connector]
    formats: tuple[Connector, ...] = field(default=())

    def connectors(self) -> tuple[Connector, ...]:
        """Each connector once; two different ones of one name are an error."""
        known: dict[str, Connector] = {}
        for c in (*self.by_source.values(), *self.formats):
            if known.setdefault(c.name, c) != c:
                raise ValueError(f"two connectors are called {c.name}")
        return tuple(known.values())


_READING = "struct<connector:string,names:array<string>,texts:array<string>>"


def _read(connector: Connector, raw: Column) -> Column:
    """(connector, groups or keys and values as a map) of a line; null if the connector can't read it.

    A pattern's groups are a map by name too, so that all connectors' findings are of one type. A line meets the pattern
    once: whether it matched is asked of what was found.
    """
    name = F.lit(connector.name).alias("connector")
    if connector.pattern is None:
        return once(ingest.key_values(raw), lambda m: F.when(F.size(m) > 0, F.struct(name, F.map_keys(m).alias("names"), F.map_values(m).alias("texts"))))
    got, names = captured(strip(raw), connector.pattern)
    return once(got, lambda g: F.when(g.isNotNull(), F.struct(name, F.array(*map(F.lit, names)).cast("array<string>").alias("names"), g.alias("texts"))))


def deal(obs: DataFrame, registry: Registry) -> DataFrame:
    """obs with ``reading`` (connector, names, texts), null for lines that nothing reads, and ``reason`` for those."""
    raw = F.col("raw")
    own = None
    for c in registry.connectors():
        sources = [s for s, x in registry.by_source.items() if x == c]
        if sources:
            mine = F.col("source").isin(*sources)
            own = F.when(mine, _read(c, raw)) if own is None else own.when(mine, _read(c, raw))
    offered = F.coalesce(*(_read(c, raw) for c in registry.formats)) if registry.formats else F.lit(None).cast(_READING)
    reading = offered if own is None else own.otherwise(offered)
    known = F.coalesce(F.col("source").isin(*registry.by_source), F.lit(False)) if registry.by_source else F.lit(False)
    # generated once for each line, however many branches read it
    read = obs.select("*", F.explode(F.array(reading)).alias("reading"))
    return read.withColumn("reason", F.when(F.col("reading").isNull(), F.when(known, DRIFT).otherwise(NO_CONNECTOR)))


def _tokens(connector: Connector) -> dict | ingest.Mapping:
    texts = F.col("reading.texts")
    if connector.pattern is None:
        return ingest.token_columns(connector, F.map_from_arrays("reading.names", "reading.texts"))
    names = to_java(connector.pattern)[1]
    return told_apart(strip(F.col("raw")), connector.pattern, {n: F.get(texts, F.lit(i)) for i, n in enumerate(names)})


def unrouted(dealt: DataFrame) -> DataFrame:
    """The lines that nothing read, as they came, with the reason."""
    return dealt.filter(F.col("reading").isNull()).drop("reading")


def facts(dealt: DataFrame, registry: Registry) -> DataFrame:
    """One flat fact for each line that its connector read."""
    by = lambda value: _by_connector({c.name: value(c) for c in registry.connectors()})
    read = dealt.filter(F.col("reading").isNotNull())
    told = F.coalesce(by(lambda c: ingest.rule_outcome(_tokens(c), c)), ingest.unmatched())
    named = read.withColumn("semantic", told).withColumn("semantic", ingest.emptied("semantic"))
    steps = by(lambda c: F.array(*map(F.lit, execution_order(c.steps)))).cast("array<string>")
    return named.select(*ingest.fact_columns(by(lambda c: F.lit(c.confidence)).cast("double"), steps, F.col("reading.connector"), by(lambda c: F.lit(c.ontology_version)).cast("string")))


def _by_connector(values: dict[str, Column]) -> Column:
    chain = None
    for name, value in values.items():
        mine = F.col("reading.connector") == name
        chain = F.when(mine, value) if chain is None else chain.when(mine, value)
    return F.lit(None) if chain is None else chain


def escalate(routed: DataFrame, registry: Registry, signatures: dict[str, tuple[Signature, ...]] | None = None) -> DataFrame:
    """Facts with class and risk of the last signature of their own connector that fires, and ``window_count``.

    signatures: by connector's name, by default those of the connectors. An actor of two connectors has a window
    for each.
    """
    given = {c.name: c.signatures for c in registry.connectors()} if signatures is None else signatures
    watched = [((F.col("knowledge_version") == name) & (F.col("action") == s.action), s) for name, every in given.items() for s in every]
    return behavior.escalate_where(routed, watched)


def counters(dealt: DataFrame) -> DataFrame:
    """(source, connector, reason, lines): how many lines of each source went where."""
    return dealt.groupBy("source", F.col("reading.connector").alias("connector"), "reason").agg(F.count("*").alias("lines"))
