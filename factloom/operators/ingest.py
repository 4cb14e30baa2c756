"""Observations (seq, obs_ts, source, raw) to classified facts, in Catalyst expressions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.blake3 import blake3
from factloom.functions.patterns import ALWAYS, ASKED, captured, extracts, fill, found, once, participation, strip, to_java, told_apart, took_part
from factloom.plans.connector import LEGAL_STAMP, REASONING_VERSION, Condition, Connector, Rule, execution_order


class _MapTokens(Mapping):
    """Tokens of a key-value line: any name is a lookup in the map."""

    def __init__(self, column: Column) -> None:
        self.column = column

    def __getitem__(self, name: str) -> Column:
        return F.try_element_at(self.column, F.lit(name))

    def __contains__(self, name: object) -> bool:
        return True

    def __iter__(self):  # noqa: ANN204
        return iter(())

    def __len__(self) -> int:
        return 0


def strip_priority(raw: Column) -> Column:
    """A leading <...> of syslog off."""
    return F.regexp_replace(raw, "^<[^>]*>", "")


def key_values(raw: Column) -> Column:
    """Map of the key=value chunks of a line, split at the first '='; the last of equal keys wins."""

    def last_wins(chunks: Column, keys: Column) -> Column:
        pairs = F.transform(keys, lambda k, i: F.struct(k.alias("key"), i.alias("i"), F.get(chunks, i).alias("c")))
        last = F.filter(pairs, lambda p: ~F.array_contains(F.slice(keys, p["i"] + 2, F.size(keys)), p["key"]))
        return F.map_from_entries(F.transform(last, lambda p: F.struct(p["key"], F.substring(p["c"], F.length(p["key"]) + 2, F.length(p["c"])))))

    chunks = F.filter(F.split(strip(raw), r"(?U)\s+"), lambda c: c.contains("="))
    return once(chunks, lambda cs: once(F.transform(cs, lambda c: F.substring_index(c, "=", 1)), lambda ks: last_wins(cs, ks)))


def _app(df: DataFrame) -> str:
    """The application that columns belong to. They are built once for each connector in it, since building the
    expressions of many rules takes longer than a small batch of lines."""
    return df.sparkSession.sparkContext.applicationId


@lru_cache(maxsize=64)
def _parse_columns(app: str, pattern: str) -> tuple[Column, Column, Column]:
    got, names = captured(F.col("raw"), pattern)
    each = told_apart(strip(F.col("raw")), pattern, {n: F.col("__got")[i] for i, n in enumerate(names)})
    return F.explode(F.array(got)).alias("__got"), F.struct(*(c.alias(n) for n, c in each.items())), F.col("__got").isNotNull()


def parse(obs: DataFrame, connector: Connector) -> DataFrame:
    """obs with ``tokens`` and ``parsed``; lines that the connector can't read have parsed false."""
    # one row for each line: a generated column is computed once, however often rules and filters read it
    if connector.pattern is None:
        return obs.select("*", F.explode(F.array(key_values(F.col("raw")))).alias("tokens")).withColumn("parsed", F.coalesce(F.size("tokens") > 0, F.lit(False)))
    got, tokens, parsed = _parse_columns(_app(obs), connector.pattern)
    return obs.select("*", got).withColumns({"tokens": tokens, "parsed": parsed}).drop("__got")


def quarantine(parsed: DataFrame) -> DataFrame:
    """The lines that didn't parse, as they came."""
    return parsed.filter(~F.col("parsed")).drop("tokens", "parsed")


def drift_counts(parsed: DataFrame) -> DataFrame:
    """(sealed, quarantined): how many lines parse and how many don't."""
    return parsed.agg(F.count_if("parsed").alias("sealed"), F.count_if(~F.col("parsed")).alias("quarantined"))


def condition_test(c: Condition, tokens: dict | Mapping) -> tuple[Column, dict[str, tuple[Column, Column]]]:
    """(condition, tokens that it binds, each for templates and for conditions).

    A group that took no part leaves the token of its name as it is. Where there is none, it is empty in a template,
    which saves a second pass for the comparison, and null in a condition.
    """
    value = tokens[c.field] if c.field in tokens else F.lit(None).cast("string")
    if c.matches is not None:
        text = F.coalesce(value, F.lit(""))
        kinds = participation(c.matches)

        def bind(name: str, got: Column) -> tuple[Column, Column]:
            if kinds[name] == ALWAYS:
                return got, got
            base = tokens[name] if name in tokens else F.lit(None).cast("string")
            told = F.when(took_part(text, c.matches, name) if kinds[name] == ASKED else got != "", got).otherwise(base)
            return (got if name not in tokens else told), told

        return found(text, c.matches), {n: bind(n, got) for n, got in extracts(text, c.matches).items()}
    if c.equals is not None:
        return F.coalesce(value == c.equals, F.lit(False)), {}
    if c.contains is not None:
        return F.coalesce(value.contains(c.contains), F.lit(False)), {}
    if c.among is not None:
        return F.coalesce(value.isin(*c.among), F.lit(False)), {}
    if c.severity_in is not None:
        severity = tokens["severity"] if "severity" in tokens else F.lit(None).cast("string")
        return F.coalesce(severity.isin(*c.severity_in), F.lit(False)), {}
    return F.lit(True), {}


class _Bound(Mapping):
    """Tokens with those that conditions bound on top."""

    def __init__(self, base: Mapping, over: dict[str, Column]) -> None:
        self.base, self.over = base, over

    def __getitem__(self, name: str) -> Column:
        return self.over[name] if name in self.over else self.base[name]

    def __contains__(self, name: object) -> bool:
        return name in self.over or name in self.base

    def __iter__(self):  # noqa: ANN204
        return iter(self.over)

    def __len__(self) -> int:
        return len(self.over)


def _outcome(rule: str, action: Column, kind: Column, risk: str, actor: Column, target: Column, ip: Column) -> Column:
    return F.struct(F.lit(rule).alias("rule_id"), action.alias("action"), kind.alias("class"), F.lit(risk).alias("risk"), actor.alias("actor"), target.alias("target"), ip.alias("source_ip"))


def rule_tests(rule: Rule, base: Mapping) -> list[tuple[Column, dict[str, tuple[Column, Column]]]]:
    """(test, tokens bound so far) of each condition of a rule; later ones read what earlier ones bind."""
    out, bound = [], {}
    for c in rule.when:
        test, got = condition_test(c, _Bound(base, {n: told for n, (_, told) in bound.items()}))
        bound = {**bound, **got}
        out.append((test, bound))
    return out


def bound_texts(rule: Rule, base: Mapping) -> dict[str, Column]:
    """The tokens that a rule's conditions bind, as its templates read them."""
    tests = rule_tests(rule, base)
    return {n: text for n, (text, _) in tests[-1][1].items()} if tests else {}


def with_bound(base: Mapping, bound: dict[str, Column]) -> Mapping:
    return _Bound(base, bound)


def outcome_of(rule: Rule, base: Mapping) -> Column:
    """What a rule says of a line for which it holds. Templates that come out empty stay empty; see ``emptied``."""
    tokens = with_bound(base, bound_texts(rule, base))
    return _outcome(rule.id, *(fill(t, tokens) for t in (rule.action, rule.behavior_class)), rule.risk, *(fill(t, tokens) for t in (rule.actor, rule.target, rule.source_ip)))


def unmatched() -> Column:
    """What is said of a line for which no rule holds."""
    empty = F.lit("")
    return _outcome("__unmatched__", F.lit("log.unknown"), F.lit("observation"), "Low", empty, empty, empty)


def rule_outcome(base: Mapping, connector: Connector) -> Column:
    """Struct of the first rule of a connector that holds on the tokens: one CASE over all rules.

    A template that comes out empty stays empty here; ``emptied`` makes it null behind the CASE, so that no
    pattern runs a second time for the comparison.
    """
    chain = None
    for rule in connector.rules:
        holds = F.lit(True)
        for test, _ in rule_tests(rule, base):
            holds = holds & test
        made = outcome_of(rule, base)
        chain = F.when(holds, made) if chain is None else chain.when(holds, made)
    return unmatched() if chain is None else chain.otherwise(unmatched())


def emptied(semantic: str) -> Column:
    """A rule's outcome with null for templates that came out empty."""
    filled = (F.nullif(F.col(semantic)[n], F.lit("")).alias(n) for n in ("actor", "target", "source_ip"))
    return F.struct(*(F.col(semantic)[n].alias(n) for n in ("rule_id", "action", "class", "risk")), *filled)


def token_columns(connector: Connector, tokens: Column) -> Mapping:
    """The tokens by name: the fields of a pattern's struct, or lookups in a map."""
    return _MapTokens(tokens) if connector.pattern is None else {n: tokens[n] for n in to_java(connector.pattern)[1]}


@lru_cache(maxsize=64)
def _rule_columns(app: str, connector: Connector) -> tuple[Column, Column]:
    return rule_outcome(token_columns(connector, F.col("tokens")), connector), emptied("semantic")


def classify(parsed: DataFrame, connector: Connector) -> DataFrame:
    """Rows that parsed, with the struct of the first rule that holds."""
    outcome, told = _rule_columns(_app(parsed), connector)
    return parsed.filter("parsed").withColumn("semantic", outcome).withColumn("semantic", told)


def fact_id() -> Column:
    """A UUID of version 7 by form: milliseconds, then hash digits of the line's origin, so that reruns agree."""
    ms = F.lpad(F.lower(F.hex(F.unix_millis("obs_ts"))), 12, "0")
    h = F.sha2(F.concat_ws(":", "source", F.col("seq").cast("string"), "raw"), 256)
    part = lambda c, at, n: F.substring(c, at, n)
    return F.concat(part(ms, 1, 8), F.lit("-"), part(ms, 9, 4), F.lit("-7"), part(h, 1, 3), F.lit("-8"), part(h, 4, 3), F.lit("-"), part(h, 7, 12))


def evidence(raw: Column, kind: str = "s256") -> Column:
    """The hash of a line as it came: ``s256`` (SHA-256, in the engine) or ``b3`` (BLAKE3, in Arrow batches)."""
    digest = {"s256": lambda: F.sha2(raw, 256), "b3": lambda: blake3(raw)}[kind]()
    return F.concat(F.lit(f"{kind}:"), digest)


def facts(obs: DataFrame, connector: Connector, hashed: str = "s256") -> DataFrame:
    """One flat fact for each line that parses; hashed: the kind of its evidence."""
    return facts_of(parse(obs, connector), connector, hashed)


def facts_of(parsed: DataFrame, connector: Connector, hashed: str = "s256") -> DataFrame:
    """``facts`` of what ``parse`` has made of the lines."""
    return classify(parsed, connector).select(*_fact_columns(_app(parsed), connector, hashed))


@lru_cache(maxsize=64)
def _fact_columns(app: str, connector: Connector, hashed: str) -> list[Column | str]:
    return fact_columns(F.lit(connector.confidence), F.array(*map(F.lit, execution_order(connector.steps))), F.lit(connector.name), F.lit(connector.ontology_version), hashed)


def fact_columns(confidence: Column, steps: Column, version: Column, ontology: Column, hashed: str = "s256") -> list[Column | str]:
    """The columns of a flat fact from an observation with ``semantic``, with what its connector says of itself."""
    s = F.col("semantic")
    return [
        "seq", fact_id().alias("fact_id"), "obs_ts", "source", "raw", s["rule_id"].alias("rule_id"), s["action"].alias("action"), s["class"].alias("class"), s["risk"].alias("risk"),
        s["actor"].alias("actor"), s["target"].alias("target"), s["source_ip"].alias("source_ip"),
        F.unix_micros("obs_ts").alias("system_timestamp"), confidence.alias("confidence"),
        evidence(F.col("raw"), hashed).alias("raw_hash"), steps.alias("steps"), version.alias("knowledge_version"),
        F.lit(LEGAL_STAMP).alias("legal_stamp"), F.lit(REASONING_VERSION).alias("reasoning_version"), ontology.alias("ontology_version"),
    ]


def coverage(cases: DataFrame, connector: Connector) -> DataFrame:
    """(cases, matching, rate): how many lines (input, expect_action) get the action expected of them."""
    obs = cases.select(F.monotonically_increasing_id().alias("seq"), F.timestamp_seconds(F.lit(0)).alias("obs_ts"), F.lit("case").alias("source"), F.col("input").alias("raw"), "expect_action")
    got = classify(parse(obs, connector), connector)
    ok = got.agg(F.count_if(F.col("semantic")["action"] == F.col("expect_action")).alias("matching"))
    return cases.agg(F.count("*").alias("cases")).crossJoin(ok).select("cases", "matching", (100.0 * F.col("matching") / F.greatest("cases", F.lit(1))).alias("rate"))
