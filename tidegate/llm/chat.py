"""Dialogues rendered from every participant's side, with DataFrame functions only.

For each participant of a conversation the whole dialogue is rendered with that speaker as the assistant and the other
speakers as named users; messages of ``system`` speakers keep their role and aren't participants. The mask of a rendering
marks what the participant said, with the end mark of each message: the characters a model of that speaker learns.

A conversation is rendered in parts of ``TURNS_PER_PART`` turn numbers, so that a conversation with any number of turns
spreads over tasks; the parts in order, joined, are the dialogue, and a part's spans count from the part's begin. All
messages of one part meet in one task.

Order and ties: by turn (null last, in a part of its own, numbered -1), then speaker, then text; repeated rows are repeated
messages. A null speaker is called ``unknown``, a null text is empty, a null conversation is one of its own. Conversations
of system messages alone have no participant and give no row; an empty table gives an empty table. Only the columns named
in the result are returned, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TURNS_PER_PART = 512
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM = ("system",)


def _header(role: str, name: Column | None = None) -> Column:
    return F.lit(f"{OPEN}{role}\n") if name is None else F.concat(F.lit(f"{OPEN}{role} name="), name, F.lit("\n"))


def perspectives(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    system: tuple[str, ...] = SYSTEM,
    turns_per_part: int = TURNS_PER_PART,
) -> DataFrame:
    """``conv_id, perspective, part, n_messages, n_own, text, spans``; spans are start and end (exclusive) in code points."""
    said = turns.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(speaker).cast("string"), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col(text), F.lit("")).alias("said"),
    )
    is_system = F.col("speaker").isin(*system)
    said = said.select(
        "*",
        F.coalesce(F.floor(F.col("turn") / turns_per_part), F.lit(-1)).cast("long").alias("part"),
        F.when(is_system, F.concat(F.lit(OPEN), "speaker", F.lit("\n")))
        .otherwise(_header("user", F.col("speaker")))
        .alias("header"),
    )
    own_header = _header("assistant")
    in_part = W.partitionBy("conv_id", "part").orderBy("turn", "speaker", "said")
    in_own = W.partitionBy("conv_id", "part", "speaker").orderBy("turn", "said")
    before = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    size = F.length("header") + F.length("said") + F.lit(len(CLOSE))
    placed = said.select(
        "*",
        F.row_number().over(in_part).alias("place"),
        F.coalesce(F.sum(size).over(before(in_part)), F.lit(0)).alias("begin"),
    ).select(
        "*",
        # An own message's header is the assistant's: what all own messages before it are shorter or longer by.
        ((F.row_number().over(in_own) - 1) * (F.length(own_header) - F.length("header"))).alias("shift"),
    )
    parts = placed.groupBy("conv_id", "part").agg(
        F.sort_array(F.collect_list(F.struct("place", "speaker", "header", "said", "begin", "shift"))).alias("messages")
    )
    # A pair of conversation and speaker is counted in partial aggregates, then met by the parts of its conversation.
    people = said.filter(~is_system).groupBy("conv_id", F.col("speaker").alias("perspective")).agg(F.lit(1).alias("one"))
    met = parts.withColumnRenamed("conv_id", "conv").join(people, F.col("conv").eqNullSafe(F.col("conv_id")))
    own = F.filter("messages", lambda m: m["speaker"] == F.col("perspective"))
    head = F.length(own_header)
    return met.select(
        "conv_id",
        "perspective",
        "part",
        F.size("messages").cast("long").alias("n_messages"),
        F.size(own).cast("long").alias("n_own"),
        F.array_join(
            F.transform(
                "messages",
                lambda m: F.concat(
                    F.when(m["speaker"] == F.col("perspective"), own_header).otherwise(m["header"]), m["said"], F.lit(CLOSE)
                ),
            ),
            "",
        ).alias("text"),
        F.transform(
            own,
            lambda m: F.struct(
                (m["begin"] + m["shift"] + head).alias("start"),
                (m["begin"] + m["shift"] + head + F.length(m["said"]) + F.lit(len(CLOSE))).alias("end"),
            ),
        ).alias("spans"),
    )
