"""Fill-in-middle: documents cut at the borders of units and put in a new order, in DataFrame functions.

A unit is a run of white space with the word after it; white space at the end is a unit of its own. Units are
rows (document, ordinal, length). They are summed at two grains, so that few of them travel: runs of
``block_units`` units shrink to one row where they were read, a window over a document's runs says where each
begins, and only the units of the two runs that a cut falls into are kept as rows, with a window of running
sums of their own. Cut requests join the units by ordinal and the runs by number, and an aggregate brings a
document's two offsets together. Texts are read for the lengths of their units, and once more for the
substrings; they travel once, to meet their offsets. No task gathers more than one document's rows.

Defined cases: a null text is empty; an empty text, and one that holds a marker itself, stays as it is
("plain"); a null id draws as an empty one; repeated rows each give a row, the same one; new columns take the
place of input columns of their name; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.common import scratch

# What a unit is, and the markers of the three parts.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Units in a run: a document of n units sends n / BLOCK_UNITS + 2 * BLOCK_UNITS rows.
BLOCK_UNITS = 32
NEW = ("n", "form", "prefix_chars", "middle_chars", "output")


def _draws(seed: int, name: str) -> list[Column]:
    """Four numbers under 2**32 that follow from a document's id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(name).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _offsets(cuts: DataFrame, block_units: int) -> DataFrame:
    """(rid, prefix_end, middle_end) in characters, of cuts (rid, lengths, a, b): the ends of units a and b."""
    run = lambda c: F.floor(c / block_units)
    units = cuts.select("rid", "a", "b", F.posexplode("lengths").alias("ordinal", "length")).withColumn("run", run(F.col("ordinal")))
    before = Window.partitionBy("rid").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = units.groupBy("rid", "run").agg(F.sum("length").alias("length")).select("rid", "run", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("before"))
    upto = Window.partitionBy("rid", "run").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)
    asked = units.filter((F.col("run") == run(F.col("a") - 1)) | (F.col("run") == run(F.col("b") - 1)))
    ends = asked.select("rid", "run", "ordinal", F.sum("length").over(upto).alias("upto"))
    requests = cuts.select("rid", F.posexplode(F.array("a", "b")).alias("which", "units")).filter("units > 0")
    requests = requests.select("rid", "which", run(F.col("units") - 1).alias("run"), (F.col("units") - 1).alias("ordinal"))
    met = requests.join(ends, ["rid", "run", "ordinal"]).join(runs, ["rid", "run"])
    end = F.col("before") + F.col("upto")
    return met.groupBy("rid").agg(*(F.max(F.when(F.col("which") == k, end)).alias(name) for k, name in enumerate(("prefix_end", "middle_end"))))


def transform(docs: DataFrame, seed: int = 42, plain_percent: int = 50, spm_percent: int = 80, block_units: int = BLOCK_UNITS) -> DataFrame:
    """docs without text, with n (units), form ("plain", "psm", "spm"), prefix_chars, middle_chars and output.

    plain_percent of the documents keep their order; of the others spm_percent put the suffix first.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    draw = _draws(seed, "doc_id")
    held = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    form = F.when((text == "") | held | (draw[2] % 100 >= 100 - plain_percent), "plain").when(draw[3] % 100 < spm_percent, "spm").otherwise("psm")
    kept = F.struct(*(c for c in docs.columns if c not in NEW and c != "text"))
    rows = docs.select(kept.alias("kept"), text.alias("text"), form.alias("form"), draw[0].alias("x"), draw[1].alias("y"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"))
    units = F.regexp_extract_all("text", F.lit(UNIT), F.lit(0))
    none = F.lit(None).cast("long")
    plain = rows.filter("form = 'plain'").select("kept.*", F.size(units).cast("long").alias("n"), "form", none.alias("prefix_chars"), none.alias("middle_chars"), F.col("text").alias("output"))

    # equal rows have equal offsets, so a document is known by what it holds
    known = F.unhex(F.sha2(F.concat(F.length("id").cast("string"), F.lit(":"), "id", "text"), 256)).alias("key")
    cut = rows.filter("form != 'plain'").select("*", known)
    sizes = scratch(cut.select("key", "x", "y", F.transform(units, F.length).alias("lengths"), F.monotonically_increasing_id().alias("rid")), "fim-units")
    n = F.size("lengths").cast("long")
    a, b = F.col("x") % (n + 1), F.col("y") % (n + 1)
    cuts = sizes.select("rid", "key", "lengths", n.alias("n"), F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    found = cuts.select("rid", "key", "n").join(_offsets(cuts, block_units), "rid", "left")
    ends = found.groupBy("key").agg(F.max("n").alias("n"), F.max(F.coalesce("prefix_end", F.lit(0))).alias("start"), F.max(F.coalesce("middle_end", F.lit(0))).alias("stop"))
    whole = cut.join(scratch(ends, "fim-offsets"), "key")
    part = lambda begin, size: F.col("text").substr(begin, size)
    one = F.lit(1)
    prefix, middle = part(one, F.col("start").cast("int")), part((F.col("start") + 1).cast("int"), (F.col("stop") - F.col("start")).cast("int"))
    suffix = part((F.col("stop") + 1).cast("int"), F.length("text"))
    mark = {m: F.lit(m) for m in (PREFIX, SUFFIX, MIDDLE)}
    output = F.when(F.col("form") == "psm", F.concat(mark[PREFIX], prefix, mark[SUFFIX], suffix, mark[MIDDLE], middle)).otherwise(F.concat(mark[SUFFIX], suffix, mark[PREFIX], prefix, mark[MIDDLE], middle))
    return plain.union(whole.select("kept.*", "n", "form", F.col("start").alias("prefix_chars"), (F.col("stop") - F.col("start")).alias("middle_chars"), output.alias("output")))


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made from: each marker stands once in an output that isn't plain."""
    head, middle = F.substring_index(output, MIDDLE, 1), F.substring_index(output, MIDDLE, -1)
    first = lambda second: F.substring_index(head, second, 1).substr(F.lit(len(PREFIX) + 1), F.length(output))
    second = lambda marker: F.substring_index(head, marker, -1)
    psm, spm = F.concat(first(SUFFIX), middle, second(SUFFIX)), F.concat(second(PREFIX), middle, first(PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
