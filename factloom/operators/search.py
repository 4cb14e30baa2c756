"""Search over facts: a filter by action, target and time, and a projection by the names of a fact's fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names that a search may use for a fact's fields.
ALIASES = {
    "fact.id": "fact_id", "actor.id": "actor", "actor.name": "actor", "target.id": "target", "source.ip": "source_ip",
    "fact.behavior.class": "class", "fact.behavior.action": "action", "fact.behavior.risk_level": "risk", "fact.confidence": "confidence",
    "fact.knowledge_version": "knowledge_version", "fact.reasoning_version": "reasoning_version", "fact.ontology_version": "ontology_version", "lsn": "lsn", "timestamp": "system_timestamp",
    "integrity.merkle_root_anchor": "root", "integrity.signature": "checksum",
}
# Groups of fields that a search may name as a whole.
GROUPS = {
    "fact.identity": {"actor.id": "actor", "actor.name": "actor", "target.id": "target", "source.ip": "source_ip"},
    "fact.time": {"system_timestamp": "system_timestamp", "log_sequence_number": "lsn"},
    "fact.behavior": {"class": "class", "action": "action", "risk_level": "risk"},
    "fact.evidence": {"raw_observation_hash": "raw_hash", "carimbo_tempo_legal": "legal_stamp"},
    "fact.lineage": {"transformation_steps": "steps", "input_source": "source", "matched_rule": "rule_id"},
    "fact.integrity": {"leaf_hash": "leaf", "merkle_root_anchor": "root", "signature": "checksum"},
}
SECONDS = {"minutes": 60, "hours": 3600, "days": 86400}


def _field(facts: DataFrame, name: str) -> Column:
    if name in GROUPS:
        return F.struct(*(_field(facts, c).alias(n) for n, c in GROUPS[name].items()))
    column = ALIASES.get(name, name)
    return F.col(f"`{column}`") if column in facts.columns else F.lit(None).cast("string")


def search(facts: DataFrame, fields: tuple[str, ...], action: str = "*", target: str = "*", within: tuple[int, str] | None = None, as_of_micros: int | None = None) -> DataFrame:
    """The fields of the facts with this action and target ('*': any; a null target compares as '').

    within: (5, "days") and the like, counted back from as_of_micros (by default now). Unknown fields are
    null; output columns are sorted and distinct. All filters reach a Parquet scan.
    """
    out = facts
    if action != "*":
        out = out.filter(F.col("action") == action)
    if target != "*":
        out = out.filter(F.col("target") == target if target else F.col("target").isNull() | (F.col("target") == ""))
    if within is not None:
        span = within[0] * SECONDS[within[1]] * 1_000_000
        now = F.unix_micros(F.current_timestamp()) if as_of_micros is None else F.lit(as_of_micros)
        out = out.filter(F.col("system_timestamp") >= now - span)
    return out.select(*(_field(facts, f).alias(f) for f in sorted(set(fields))))


def nested(facts: DataFrame) -> DataFrame:
    """facts as fact_id, one struct for each group of fields (identity, time, behavior, evidence, lineage, integrity),
    confidence and the versions of knowledge, reasoning and ontology; names have no dots."""
    plain = lambda n: n.replace(".", "_")
    groups = [F.struct(*(_field(facts, c).alias(plain(n)) for n, c in fields.items())).alias(name.removeprefix("fact.")) for name, fields in GROUPS.items()]
    return facts.select("fact_id", *groups, "confidence", "knowledge_version", "reasoning_version", "ontology_version")
