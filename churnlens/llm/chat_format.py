"""Operator 2 — chat formatting by multi-party perspective rotation.

Every participant (distinct role) of a conversation is taken as the assistant in
turn: their messages become assistant messages that count for the loss, all
others become messages of named users that are masked out. One row per
conversation, perspective and part: ``parts`` are consecutive runs of at most
``turns_per_part`` turn numbers, so a conversation of any length is rendered
whole without ever being gathered into one row.

Format of a message: ``<|assistant|>`` or ``<|user:NAME|>``, newline, the text,
``<|end|>``, newline. Marks inside texts and names are escaped, so no message can forge
another one: a backslash goes in after each ``<`` that backslashes, if any, and ``|``
follow, and in a name also after each ``|`` that backslashes and ``>`` follow; taking one
out again restores the text. ``spans`` lists start and length, in characters of
``rendered``, of what the perspective's own messages contribute (text and end
mark, not the header); ``n_trained`` is their sum.

A conversation's participants come from a distinct (conversation, role) pair list
that is pre-aggregated before its shuffle; messages meet the participants by an
equi-join on (conversation, part) — never a cross join — and a part's rows are
bounded by the turn numbers it may hold. Messages of a part that share a turn
number are ordered by role, then text.

Cases: NULL conv_id is no conversation and gives no row; NULL turn sorts before
all others (part NULL turned into -1); a NULL role is the participant
``unknown``; NULL text renders as empty; repeated rows (equal in conversation,
turn, role and text) are rendered once; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS_PER_PART = 256


def _escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def _header(is_self: Column, name: Column) -> Column:
    return F.when(is_self, F.lit("<|assistant|>\n")).otherwise(
        F.concat(F.lit("<|user:"), F.regexp_replace(_escaped(name), r"\|(\\*)>", r"|\\$1>"),
                 F.lit("|>\n")))


def rotate(conversations: DataFrame, turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """conv_id, perspective, part, n_messages, n_trained, rendered, spans."""
    told = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id",
        F.coalesce(F.floor(F.col("turn") / F.lit(turns_per_part)), F.lit(-1)).cast("long")
        .alias("part"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text")).distinct()
    people = told.select("conv_id", F.col("role").alias("perspective")).distinct()
    parts = told.groupBy("conv_id", "part").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("said"))
    seen = parts.join(people, "conv_id")
    own = lambda m: m["role"] == F.col("perspective")
    body = seen.select(
        "conv_id", "perspective", "part",
        F.transform("said", lambda m: F.struct(
            _header(own(m), m["role"]).alias("head"),
            F.concat(_escaped(m["text"]), F.lit("<|end|>\n")).alias("body"),
            own(m).alias("own"))).alias("m"))
    start = F.struct(F.lit(0).cast("long").alias("at"),
                     F.expr("cast(array() as array<struct<start:bigint,length:bigint>>)")
                     .alias("spans"))

    def step(acc, m):
        begin = acc["at"] + F.length(m["head"])
        long = F.length(m["body"]).cast("long")
        return F.struct((begin + long).cast("long").alias("at"),
                        F.when(m["own"], F.array_append(acc["spans"], F.struct(
                            begin.cast("long").alias("start"), long.alias("length"))))
                        .otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate("m", start, step, lambda acc: acc["spans"])
    out = body.select(
        "conv_id", "perspective", "part", F.size("m").cast("long").alias("n_messages"),
        F.array_join(F.transform("m", lambda m: F.concat(m["head"], m["body"])), "")
        .alias("rendered"), spans.alias("spans"))
    return out.select(
        "conv_id", "perspective", "part", "n_messages",
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["length"])
        .alias("n_trained"),
        "rendered", "spans")
