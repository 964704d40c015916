"""Dialogues as chat text, once from the side of each of their speakers.

Only DataFrame functions: a long dialogue is cut into segments of a fixed number of turns, and every
segment is rendered for every speaker of the dialogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelayers.operators.ranking import rank_within
from carelayers.sources.layers import shared_folder

#: Turns of a segment; a dialogue of up to so many turns is one text.
SEGMENT_TURNS = 64
# Fixed values of the chat format.
START, END = "<|im_start|>", "<|im_end|>"
SYSTEM, UNKNOWN = "system", "unknown"


def _plain(text: Column) -> Column:
    """Text in which nothing looks like a marker: ``<|`` becomes ``<\\|``."""
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def _name(speaker: Column) -> Column:
    return F.regexp_replace(_plain(speaker), r"[\s]+", " ")


def perspectives(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    speaker_col: str = "role",
    text_col: str = "text",
    segment_turns: int = SEGMENT_TURNS,
) -> DataFrame:
    """``(conv_col, segment, perspective, n_turns, text, masks)``: each dialogue by each speaker.

    In a speaker's own text that speaker is ``assistant`` and the others are users with their names;
    ``masks`` are the ``(start, end)`` of the speaker's turns in it, in code points, from the turn's
    text to its end marker. ``system`` turns are the same for all and nobody's perspective; turns
    without a speaker are an unknown user's. Turns follow their number (NULL last), then speaker and
    text; repeated rows are turns of their own; NULL text is empty. Turns without a dialogue are one
    dialogue. Dialogues whose turns are all system's or unknown users', and empty tables, give
    nothing. Other columns are not looked at.

    A dialogue of more than ``segment_turns`` turns gives several texts per speaker, ``segment`` 0
    and on; each has that many turns, for speakers who are silent in it too. Every text begins with
    all ``system`` turns that open the dialogue; those repeated from earlier segments do not count in
    ``n_turns``.

    Numbering does not gather a dialogue in one task, and segments meet their speakers by dialogue and
    segment, so neither a long nor a repeated dialogue is one task's work. Segments are written once to the
    shared folder.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.col(speaker_col).cast("string").alias("speaker"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    ranked = rank_within(rows, ["conv"], ["turn"], "place")
    ranked = ranked.withColumn("segment", F.floor((F.col("place") - 1) / segment_turns).cast("bigint"))
    turn = F.struct("place", "speaker", _plain(F.col("text")).alias("text"))
    system = F.coalesce(F.col("speaker") == SYSTEM, F.lit(False))
    segments = ranked.groupBy("conv", "segment").agg(
        F.sort_array(F.collect_list(turn)).alias("own_turns"), F.min(F.when(~system, F.col("place"))).alias("other")
    )
    folder = shared_folder(turns.sparkSession, "chat")
    segments.write.parquet(folder)
    segments = turns.sparkSession.read.parquet(folder)
    # One row a dialogue: its last segment, and the first turn that is not system's.
    whole = segments.groupBy("conv").agg(F.max("segment").alias("last"), F.min("other").alias("opened"))
    opening = F.filter("own_turns", lambda t: t["place"] < F.col("opened"))
    long = whole.where("last > 0 and opened > 1").select(F.col("conv").alias("of"), "opened")
    leading = segments.where(F.get("own_turns", F.lit(0))["speaker"] == SYSTEM)
    leading = leading.join(long, F.col("conv").eqNullSafe(F.col("of"))).select("of", opening.alias("part"))
    leading = leading.groupBy("of").agg(F.flatten(F.sort_array(F.collect_list("part"))).alias("leading"))
    speakers = rows.where(F.col("speaker") != SYSTEM).select("conv", F.col("speaker").alias("perspective")).distinct()
    whole = whole.join(leading, F.col("conv").eqNullSafe(F.col("of")), "left")
    whole = whole.select(F.col("conv").alias("of"), "last", "leading")
    texts = speakers.join(whole, F.col("conv").eqNullSafe(F.col("of"))).select(
        "of", "perspective", "leading", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"))).alias("nth")
    )
    sides = segments.join(texts, F.col("conv").eqNullSafe(F.col("of")) & (F.col("segment") == F.col("nth")))
    # System turns that open the dialogue and lie in earlier segments.
    earlier = F.filter("leading", lambda t: t["place"] <= F.col("segment") * segment_turns)
    turns = F.when(F.col("leading").isNull(), F.col("own_turns")).otherwise(F.concat(earlier, F.col("own_turns")))
    sides = sides.withColumn("turns", turns)

    def head(t: Column) -> Column:
        user = F.concat(F.lit("user name="), _name(F.coalesce(t["speaker"], F.lit(UNKNOWN))))
        role = (
            F.when(t["speaker"] == SYSTEM, SYSTEM)
            .when(t["speaker"] == F.col("perspective"), "assistant")
            .otherwise(user)
        )
        return F.concat(F.lit(START), role, F.lit("\n"))

    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            head(t).alias("head"),
            F.concat(t["text"], F.lit(END)).alias("body"),
            F.coalesce(t["speaker"] == F.col("perspective"), F.lit(False)).alias("own"),
        ),
    )
    sides = sides.withColumn("pieces", pieces)
    span = "struct<start:bigint,end:bigint>"

    def step(state: Column, p: Column) -> Column:
        start = state["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        here = F.array(F.struct(start.alias("start"), end.alias("end")).cast(span))
        masks = F.when(p["own"], F.concat(state["masks"], here)).otherwise(state["masks"])
        return F.struct((end + 1).alias("at"), masks.alias("masks"))

    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{span}>").alias("masks"))
    return sides.select(
        F.col("conv").alias(conv_col),
        "segment",
        "perspective",
        F.size("own_turns").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("text"),
        F.aggregate("pieces", begin, step, lambda s: s["masks"]).alias("masks"),
    )
