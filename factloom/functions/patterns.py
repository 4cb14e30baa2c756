"""Regular expressions and templates of connectors as Spark columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once for each row, however often use reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def to_java(pattern: str) -> tuple[str, dict[str, int]]:
    """(Java pattern, group number by name): named groups become positional, classes Unicode."""
    names: dict[str, int] = {}
    out, count, i, in_class = [], 0, 0, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            out.append(pattern[i : i + 2])
            i += 2
            continue
        if c == "[":
            in_class = True
        elif c == "]":
            in_class = False
        elif c == "(" and not in_class:
            named = re.match(r"\(\?P?<(\w+)>", pattern[i:])
            if named or pattern[i + 1 : i + 2] != "?":
                count += 1
            if named:
                names[named[1]] = count
                out.append("(")
                i += named.end()
                continue
        out.append(c)
        i += 1
    return "(?Ud)" + "".join(out), names


#: What an empty text from a group's extraction says: the group always takes part (ALWAYS), it can't match empty and so
#: took no part (FILLED), or it may have done either (ASKED).
ALWAYS, FILLED, ASKED = "always", "filled", "asked"


def participation(pattern: str) -> dict[str, str]:
    """ALWAYS, FILLED or ASKED for each named group."""
    parser = re._parser
    tree = parser.parse(re.sub(r"\(\?<(?=\w)", "(?P<", pattern))
    names = {k: n for n, k in tree.state.groupdict.items()}
    out: dict[str, str] = {}

    def walk(items: parser.SubPattern, optional: bool) -> None:
        for op, args in items:
            kind = str(op)
            if kind == "SUBPATTERN":
                if args[0] in names:
                    out[names[args[0]]] = ALWAYS if not optional else FILLED if args[3].getwidth()[0] else ASKED
                walk(args[3], optional)
            elif kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
                walk(args[2], optional or args[0] == 0)
            elif kind == "BRANCH":
                for branch in args[1]:
                    walk(branch, True)
            elif kind == "ATOMIC_GROUP":
                walk(args, optional)
            elif kind in ("ASSERT", "ASSERT_NOT"):
                walk(args[1], optional or kind == "ASSERT_NOT")

    walk(tree, False)
    return out


def took_part(column: Column, pattern: str, name: str) -> Column:
    """Whether a named group takes part in the first match; a pass of its own.

    An empty group stands behind the named one, and takes part where that does; a reference back to it holds
    then only. The first match is made atomic, so that none is sought in which the group would take part.
    """
    opening = re.search(rf"\(\?P?<{re.escape(name)}>", pattern)
    depth, i, in_class = 0, opening.start(), False
    while True:
        c = pattern[i]
        if c == "\\":
            i += 2
            continue
        if in_class:
            in_class = c != "]"
        elif c == "[":
            in_class = True
        elif c in "()":
            depth += 1 if c == "(" else -1
            if not depth:
                break
        i += 1
    marked = f"{pattern[: opening.start()]}(?:{pattern[opening.start() : i + 1]}(?P<took_part_>)){pattern[i + 1 :]}"
    java, names = to_java(marked)
    return column.rlike(rf"\A(?>(?s:.*?)(?:{java}))(?:\{names['took_part_']})")


def extracts(column: Column, pattern: str) -> dict[str, Column]:
    """Named groups of the first match; '' for a group that took no part."""
    java, names = to_java(pattern)
    return {n: F.regexp_extract(column, java, k) for n, k in names.items()}


def told_apart(column: Column, pattern: str, got: dict[str, Column]) -> dict[str, Column]:
    """got, the groups' texts of a first match, with null for groups that took no part."""
    kinds = participation(pattern)
    part = {ALWAYS: lambda n, c: c, FILLED: lambda n, c: F.nullif(c, F.lit("")), ASKED: lambda n, c: F.when(took_part(column, pattern, n), c)}
    return {n: part[kinds[n]](n, c) for n, c in got.items()}


def groups(column: Column, pattern: str) -> dict[str, Column]:
    """Named groups of the first match; null for a group that took no part, and without a match."""
    return {n: F.when(found(column, pattern), c) for n, c in told_apart(column, pattern, extracts(column, pattern)).items()}


_GROUP, _MATCH = "\x01", "\x02"


def captured(raw: Column, pattern: str) -> tuple[Column, list[str]]:
    """(array of the named groups of the first match, their names): one pass of the pattern over a stripped line.

    The array is null without a match; a group that took no part is empty. Lines that hold the marks
    themselves, which aren't white space, take a pass for each group.
    """
    column = strip(raw)
    java, names = to_java(pattern)
    marked = F.regexp_replace(column, java, _MATCH + _GROUP.join(f"${k}" for k in names.values()) + _MATCH)
    split = F.split(F.get(F.split(marked, _MATCH), F.lit(1)), _GROUP)
    each = F.when(column.rlike(java), F.array(*(F.regexp_extract(column, java, k) for k in names.values())).cast("array<string>"))
    return F.when(raw.contains(_GROUP) | raw.contains(_MATCH), each).otherwise(split), list(names)


def found(column: Column, pattern: str) -> Column:
    return column.rlike(to_java(pattern)[0])


# The characters of Unicode's White_Space property.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(column: Column) -> Column:
    """Unicode white space off both ends."""
    return F.btrim(column, F.lit(WHITE))


def fill(template: str | None, tokens: Mapping[str, Column]) -> Column:
    """Fill ${name} from tokens ('' if absent), strip; each token is read once."""
    pieces = re.split(r"\$\{([^}]*)\}", template or "")
    if len(pieces) == 1:
        return F.lit(pieces[0].strip(WHITE))
    parts = [F.coalesce(tokens[p], F.lit("")) if k % 2 else F.lit(p) for k, p in enumerate(pieces) if (p in tokens if k % 2 else p)]
    return strip(F.concat(*parts)) if parts else F.lit("")


def render(template: str | None, tokens: Mapping[str, Column]) -> Column:
    """``fill``; null if nothing is left."""
    return F.nullif(fill(template, tokens), F.lit(""))
