"""Secret scans: single findings, and the parts of credentials that belong together, in DataFrame functions.

Three kinds are reported wherever they stand: ``assign`` (a named value), ``access`` (an access identifier) and
``hex`` (a long run of hexadecimal digits). Three more are weak by themselves: ``client`` (a user, client or
account under its name), ``secret`` (a mixed run of 20 to 128 letters and digits) and ``endpoint`` (an address,
or a host under its name). A weak candidate is reported only where complementary parts stand in its scope, the
``scope`` characters around it: a client with a secret part (assign, hex, secret), a secret with an identifier
(access, client), an endpoint with both. A candidate that overlaps a base finding is part of that already.

Parts are rows (row, kind, start, end): lengths of matches and of what lies between them are summed by a window
over a text's matches. Candidates meet parts by an interval join: both are dealt to bins of ``scope``
characters, a candidate to all that its scope touches, so that a bin holds as many parts at most as fit in it,
whatever the length of a text. Rows are told apart by a number of their own, so that copies don't meet. Texts
are read once and aren't shuffled; only rows with matches are.

Defined cases: a null text is empty; a text without findings has no spans; repeated rows each give a row; a
result column takes the place of an input column ``spans``; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.common import scratch


def _either(word: str) -> str:
    """A pattern of word in which letters may stand in either case (of ASCII only)."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: Kinds in their order.
KINDS = ("assign", "access", "hex", "client", "secret", "endpoint")
BASE, IDENTIFIERS, SECRETS = (0, 1, 2), (1, 3), (0, 2, 4)
_NAMED = r"""["']?\x20*[:=]\x20*["']?"""
PATTERNS = {
    "assign": "(" + "|".join(map(_either, ("password", "passwd", "secret", "token", "api_?key"))) + ")" + _NAMED + "([A-Za-z0-9+/_.=-]+)",
    # runs of these two are matched whole, so that a least length in the pattern drops the same matches
    "access": "AKIA[A-Z0-9]{12,}",
    "hex": "[0-9a-f]{32,}",
    "client": "(" + "|".join(map(_either, ("client_?id", "account_?id", "key_?id", "user_?name", "user", "login"))) + ")" + _NAMED + "([A-Za-z0-9@._-]+)",
    "secret": "[A-Za-z0-9+/]{20,}",
    "endpoint": "[a-z][a-z0-9+]*://[A-Za-z0-9._:/@-]+|(?:" + "|".join(map(_either, ("endpoint", "hostname", "host", "server"))) + ")" + _NAMED + "[A-Za-z0-9.-]+",
}
SCOPE_CHARS = 256
#: Lengths of the value of an assignment, of that of a client, and of a mixed run.
ASSIGN_CHARS, CLIENT_CHARS, SECRET_CHARS = 8, 3, 128


def _holds(kind: str, match: Column) -> Column:
    """Whether a match of the kind's pattern is a finding."""
    if kind == "assign":
        return F.length(F.regexp_extract(match, PATTERNS[kind], 2)) >= ASSIGN_CHARS
    if kind == "client":
        return F.length(F.regexp_extract(match, PATTERNS[kind], 2)) >= CLIENT_CHARS
    if kind == "secret":
        return (F.length(match) <= SECRET_CHARS) & match.rlike("[a-z]") & match.rlike("[A-Z]") & match.rlike("[0-9]")
    return F.lit(True)


#: Characters without which a kind has no match: a plain search for them spares most texts the pattern.
HINTS = {"assign": ("=", ":"), "access": ("AKIA",), "client": ("=", ":"), "endpoint": ("=", ":")}


def _matches(kind: str, text: Column) -> Column:
    """(kind, list of (gap before, length, holds)) of a text's matches, leftmost first; null where there are none."""
    pattern = F.lit(PATTERNS[kind])
    gaps = F.split(text, PATTERNS[kind], -1)
    each = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: F.struct(F.length(m).alias("size"), _holds(kind, m).alias("holds")))
    both = F.zip_with(each, F.transform(F.slice(gaps, 1, F.size(each)), F.length), lambda m, g: F.struct(g.alias("gap"), m["size"].alias("size"), m["holds"].alias("holds")))
    some = F.lit(kind not in HINTS)
    for hint in HINTS.get(kind, ()):
        some = some | text.contains(hint)
    return F.when(some & text.rlike(PATTERNS[kind]), F.struct(F.lit(KINDS.index(kind)).alias("kind"), both.alias("matches")))


def _parts(found: DataFrame) -> DataFrame:
    """(rid, kind, start, end) of all findings, weak ones included, in code points."""
    each = found.select("rid", F.inline("found")).select("rid", "kind", F.posexplode("matches").alias("i", "m")).select("rid", "kind", "i", "m.*")
    upto = Window.partitionBy("rid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    ends = each.select("rid", "kind", "size", "holds", F.sum(F.col("gap") + F.col("size")).over(upto).alias("end"))
    return ends.filter("holds").select("rid", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """The weak candidates of parts that have what they lack within scope characters."""
    bins = lambda low, high: F.explode(F.sequence(F.floor(low / scope), F.floor(high / scope)))
    weak = parts.filter(~F.col("kind").isin(*BASE)).select("rid", "kind", "start", "end", bins(F.greatest(F.col("start") - scope, F.lit(0)), F.col("end") - 1 + scope).alias("bin"))
    other = parts.select("rid", bins(F.col("start"), F.col("end") - 1).alias("bin"), F.col("kind").alias("of"), F.col("start").alias("low"), F.col("end").alias("high"))
    met = weak.join(other, ["rid", "bin"]).filter((F.col("low") <= F.col("end") + scope) & (F.col("high") >= F.col("start") - scope))
    some = lambda kinds: F.max(F.col("of").isin(*kinds))
    overlaps = F.col("of").isin(*BASE) & (F.col("low") < F.col("end")) & (F.col("high") > F.col("start"))
    facts = met.groupBy("rid", "kind", "start", "end").agg(some(IDENTIFIERS).alias("identified"), some(SECRETS).alias("secret"), F.max(overlaps).alias("inside"))
    kind = F.col("kind").cast("int")
    needs = F.when(kind == KINDS.index("client"), F.col("secret")).when(kind == KINDS.index("secret"), F.col("identified")).otherwise(F.col("secret") & F.col("identified"))
    return facts.filter(needs & ~F.col("inside")).select("rid", "kind", "start", "end")


def find(docs: DataFrame, scope: int = SCOPE_CHARS) -> DataFrame:
    """docs without text, with spans: array of (start, end, kind) by start, then kind; ends are exclusive."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = F.struct(*(c for c in docs.columns if c not in ("text", "spans")))
    found = F.filter(F.array(*(_matches(k, text) for k in KINDS)), lambda m: m.isNotNull())
    rows = scratch(docs.select(kept.alias("kept"), found.alias("found"), F.monotonically_increasing_id().alias("rid")), "secret-rows")
    some = rows.filter(F.size("found") > 0)
    parts = scratch(_parts(some), "secret-parts")
    spans = parts.filter(F.col("kind").isin(*BASE)).union(_linked(parts, scope))
    listed = spans.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("each"))
    names = F.array(*map(F.lit, KINDS))
    named = F.transform(F.coalesce("each", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.get(names, s["kind"]).alias("kind")))
    none = F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")
    return rows.filter(F.size("found") == 0).select("kept.*", none.alias("spans")).union(some.select("rid", "kept").join(listed, "rid", "left").select("kept.*", named.alias("spans")))
