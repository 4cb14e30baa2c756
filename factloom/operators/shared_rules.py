"""Many rules at once: each distinct condition is tested once a line, and a rule is a mask over the answers.

A CASE over rules tests a condition again in every rule that has it, and seeks each literal by itself. Here the
distinct conditions get a bit each, in words of 62; a rule holds if its bits are set in the words. Literals
sought in one field, from AUTOMATON of them on, are found by one Aho-Corasick automaton in a single pass
over the field, in Arrow batches. A condition that reads a token which an earlier one of its rule binds has a bit
of its own. Constants of rules are arrays, so that the plan grows with the conditions, not the rules; masks are tried
on the distinct answers of an Arrow batch, all lines of it at once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.patterns import WHITE, fill, participation
from factloom.operators import ingest
from factloom.plans.connector import Condition, Connector, Rule

WORD_BITS = 62
#: So many literals of one field are sought by an automaton.
AUTOMATON = 8


@dataclass(frozen=True)
class Compiled:
    """The distinct conditions, each with the rule and place of one that can't be shared, and the bits of each rule."""

    conditions: tuple[tuple[Condition, tuple[int, int] | None], ...]
    masks: tuple[frozenset[int], ...]


def _plain(c: Condition) -> Condition:
    """The condition with what its operator doesn't read left out, so that equal tests are equal."""
    for name in ("matches", "equals", "contains", "among"):
        if getattr(c, name) is not None:
            return Condition(c.field, **{name: getattr(c, name)})
    return Condition(severity_in=c.severity_in) if c.severity_in is not None else Condition()


def compiled(rules: tuple[Rule, ...]) -> Compiled:
    places: dict[tuple[Condition, tuple[int, int] | None], int] = {}
    masks = []
    for n, rule in enumerate(rules):
        bound: set[str] = set()
        bits = set()
        for k, c in enumerate(rule.when):
            c = _plain(c)
            own = (n, k) if (c.field if c.severity_in is None else "severity") in bound else None
            if c != Condition():
                bits.add(places.setdefault((c, own), len(places)))
            if c.matches is not None:
                bound |= set(participation(c.matches))
        masks.append(frozenset(bits))
    return Compiled(tuple(places), tuple(masks))


def _sought(literals: list[tuple[str, int]], words: int) -> object:
    """A function from a field's text to the words with the bits of the literals that it holds."""

    @F.pandas_udf("array<long>")
    def seek(texts: pd.Series) -> pd.Series:
        import ahocorasick

        machine = ahocorasick.Automaton()
        always = [0] * words
        for literal, place in literals:
            if literal:
                machine.add_word(literal, place)
            else:
                always[place // WORD_BITS] |= 1 << place % WORD_BITS
        machine.make_automaton()

        def one(text: str | None) -> list[int]:
            if text is None:
                return [0] * words
            got = always.copy()
            for _, place in machine.iter(text):
                got[place // WORD_BITS] |= 1 << place % WORD_BITS
            return got

        return texts.map(one, na_action=None)

    return seek


def _first(masks: list[list[int]]) -> object:
    """A function from words of bits to the place of the first mask that they hold, -1 for none."""
    table = np.array(masks, dtype=np.int64)

    @F.pandas_udf("int")
    def first(*words: pd.Series) -> pd.Series:
        answers = np.column_stack([w.to_numpy(dtype=np.int64) for w in words])
        kinds, at = np.unique(answers, axis=0, return_inverse=True)
        chosen = np.full(len(kinds), -1, dtype=np.int32)
        rest = np.arange(len(kinds))
        for place, mask in enumerate(table):
            used = np.flatnonzero(mask)
            held = ((kinds[rest][:, used] & mask[used]) == mask[used]).all(axis=1)
            chosen[rest[held]] = place
            rest = rest[~held]
            if not len(rest):
                break
        return pd.Series(chosen[at.ravel()])

    return first


def _texts(values: list[str]) -> Column:
    """A constant array, as one literal."""
    mark = "\x1f"
    if any(mark in v for v in values):
        return F.array(*map(F.lit, values))
    return F.split(F.lit(mark.join(values)), mark, -1)


def _numbers(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")


def _answers(made: Compiled, rules: tuple[Rule, ...], tokens: Mapping) -> tuple[list[Column], dict[str, Column]]:
    """(words of bits, automata's results by name, which the words read)."""
    words = -(-len(made.conditions) // WORD_BITS)
    by_field: dict[str, list[tuple[str, int]]] = {}
    for place, (c, own) in enumerate(made.conditions):
        if c.contains is not None and own is None:
            by_field.setdefault(c.field, []).append((c.contains, place))
    sought = {f: each for f, each in by_field.items() if len(each) >= AUTOMATON}
    machine = {f"__found_{k}": _sought(each, words)(tokens[f] if f in tokens else F.lit(None).cast("string")) for k, (f, each) in enumerate(sought.items())}
    found = {place for each in sought.values() for _, place in each}
    out = [F.lit(0).cast("long") for _ in range(words)]
    for place, (c, own) in enumerate(made.conditions):
        if place not in found:
            test = ingest.condition_test(c, tokens)[0] if own is None else ingest.rule_tests(rules[own[0]], tokens)[own[1]][0]
            w = place // WORD_BITS
            out[w] = out[w].bitwiseOR(F.when(test, F.lit(1 << place % WORD_BITS).cast("long")).otherwise(F.lit(0).cast("long")))
    for name in machine:
        out = [word.bitwiseOR(F.get(F.col(name), F.lit(w))) for w, word in enumerate(out)]
    return out, machine


def _chosen(rules: tuple[Rule, ...], number: Column, base: Mapping) -> Column:
    """What the rule of this number says; constants are looked up, and equal templates written once."""

    def field(of: Callable[[Rule], str | None]) -> Column:
        fixed: list[str] = []
        kinds: dict[object, tuple[int, Column]] = {}
        which = []
        for k, rule in enumerate(rules):
            template = of(rule)
            names = set(re.findall(r"\$\{([^}]*)\}", template or ""))
            fixed.append("" if names else (template or "").strip(WHITE))
            if not names:
                which.append(0)
                continue
            bound = ingest.bound_texts(rule, base) if any(c.matches for c in rule.when) else {}
            key = (template, k if names & set(bound) else None)
            if key not in kinds:
                kinds[key] = (len(kinds) + 1, fill(template, ingest.with_bound(base, bound)))
            which.append(kinds[key][0])
        value = F.get(_texts(fixed), number)
        kind = F.get(_numbers(which), number)
        chain = None
        for k, made in kinds.values():
            chain = F.when(kind == k, made) if chain is None else chain.when(kind == k, made)
        return value if chain is None else chain.otherwise(value)

    constant = lambda of: F.get(_texts([of(r) for r in rules]), number)
    texts = [field(lambda r, n=n: getattr(r, n)) for n in ("action", "behavior_class")]
    identity = [field(lambda r, n=n: getattr(r, n)) for n in ("actor", "target", "source_ip")]
    return F.struct(
        constant(lambda r: r.id).alias("rule_id"), texts[0].alias("action"), texts[1].alias("class"), constant(lambda r: r.risk).alias("risk"),
        identity[0].alias("actor"), identity[1].alias("target"), identity[2].alias("source_ip"),
    )


def classify(parsed: DataFrame, connector: Connector) -> DataFrame:
    """``ingest.classify`` with shared conditions: the same rows, by the first rule that holds."""
    rules = connector.rules
    made = compiled(rules)
    base = ingest.token_columns(connector, F.col("tokens"))
    words, machine = _answers(made, rules, base)
    rows = parsed.filter("parsed")
    for name, column in machine.items():
        rows = rows.withColumn(name, column)
    if rules and words:
        mask = lambda bits, w: sum(1 << b % WORD_BITS for b in bits if b // WORD_BITS == w)
        number = _first([[mask(bits, w) for w in range(len(words))] for bits in made.masks])(*words)
    else:
        number = F.lit(0 if rules else -1)
    rows = rows.withColumn("__rule", number)
    chosen = F.when(F.col("__rule") >= 0, _chosen(rules, F.col("__rule"), base)).otherwise(ingest.unmatched()) if rules else ingest.unmatched()
    return rows.withColumn("semantic", chosen).withColumn("semantic", ingest.emptied("semantic")).drop("__rule", *machine)
