"""Chat formatting: every participant's perspective on a multi-party dialogue, in DataFrame functions.

For each speaker of a conversation the dialogue is rendered with that speaker as assistant, other
speakers as named users and system turns as context; ``mask`` lists the character spans that the
assistant of this perspective has to say. Long conversations come in parts of ``part_turns`` turn
numbers, in order, whose texts joined give the whole; a part is all that one task gathers. Spans count from
the start of their part. Only turns without a number or of one equal number make a part larger than that.
Markers that a text or a role's name holds itself are rendered as they are: escape them beforehand where
texts aren't trusted.

Defined cases: a null role speaks as ``unknown``, a null text is empty, a null turn comes first (in
part -1); a null conv_id is a conversation of its own; fully repeated rows count once; equal turns are
ordered by role and text; a conversation without speakers and an empty table give no rows; extra
columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART_TURNS = 256
END = "<|end|>"


def perspectives(conversations: DataFrame, part_turns: int = PART_TURNS, context_role: str = "system") -> DataFrame:
    """(conv_id, speaker, part, n_turns, rendered, mask) for each conversation, speaker and part."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    part = F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)).cast("long").alias("part")
    parts = rows.groupBy("conv_id", part).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    speakers = rows.filter(F.col("role") != context_role).select(F.col("conv_id").alias("of"), F.col("role").alias("speaker")).distinct()
    both = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("of")))
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            F.when(t["role"] == F.col("speaker"), "<|assistant|>\n")
            .when(t["role"] == context_role, "<|system|>\n")
            .otherwise(F.concat(F.lit("<|user name="), t["role"], F.lit("|>\n")))
            .alias("head"),
            F.concat(t["text"], F.lit(END)).alias("body"),
            (t["role"] == F.col("speaker")).alias("own"),
        ),
    )
    both = both.select("conv_id", "speaker", "part", pieces.alias("pieces"))
    length = F.transform("pieces", lambda p: F.length(p["head"]) + F.length(p["body"]) + 1)
    # where each piece begins: running sums over the part's turns
    begins = F.aggregate(
        length,
        F.array(F.lit(0)),
        lambda got, n: F.concat(got, F.array(F.element_at(got, -1) + n)),
    )
    both = both.withColumn("begins", begins)
    spans = F.filter(
        F.transform("pieces", lambda p, i: F.struct(p["own"].alias("own"), (F.get("begins", i) + F.length(p["head"])).alias("start"), (F.get("begins", i + 1) - 1).alias("end"))),
        lambda s: s["own"],
    )
    return both.select(
        "conv_id", "speaker", "part", F.size("pieces").cast("long").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("rendered"),
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("mask"),
    )
