"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered once with
that participant as the assistant and everyone else as a named user; the loss
mask covers the assistant's own words.  The rendering of a perspective is the
concatenation of its segments in turn order; each segment carries its place,
so a conversation of any length is never held in one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsentinel.llm.common import pick

#: The markers around a message.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Speakers that give instructions and take no part.
NARRATORS = ("system",)
#: Turns in a slice of a conversation; digits of a text's digest that cut the
#: rows of one turn into cells.
SLICE = 1024
DIGITS = 2
#: Stands for a missing turn number in keys; sorts before any other.
_NO_TURN = -(1 << 62)


def _key(value: Column) -> Column:
    """A key without nulls, in which no text stands for null."""
    return F.when(value.isNull(), "n").otherwise(F.concat(F.lit("s"), value.cast("string")))


def _clean(text: Column) -> Column:
    """Markers inside a text are broken up, so a text cannot end its own
    message."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def perspectives(conversations: DataFrame, narrators=NARRATORS, slice_turns: int = SLICE) -> DataFrame:
    """``conversations`` → one row per conversation, perspective and turn:
    ``conv_id, perspective, turn, part`` (the number among the perspective's
    rows of that turn), ``role`` (assistant, user or system), ``name``,
    ``segment``, its place ``start_at .. end_at`` in the rendering and the
    masked (learned) characters ``mask_from .. mask_to``, empty for others'
    words.

    Participants are the different speakers but the narrators, told apart by
    their names as they stand: "ann lee" and "ann_lee" are two, and so are a
    null and a blank speaker.  Only the rendering escapes a name (white space
    and marker characters become one underscore, nothing becomes ``unknown``);
    names of a conversation that then look alike are numbered, ``ann_lee`` and
    ``ann_lee#2``, in the order of the names as they stand (null first).  A
    conversation without a participant gives no rows.  A null text is empty;
    turns go by number (null first), then by speaker and the text's MD5; rows
    that repeat are rendered each.  Rows of a null ``conv_id`` are one
    conversation, another than that of the text "null".  An empty table gives
    no rows; other columns are ignored.
    """
    shown = F.regexp_replace(F.trim(F.coalesce("role", F.lit(""))), r"[\s<>|=#]+", "_")
    # Keys without nulls; the digest stands for the text wherever rows are
    # ordered and joined, so the text itself is shuffled once.
    turns = pick(conversations, "conv_id", "turn", "role", "text").select(
        "conv_id", F.col("turn").cast("long").alias("turn"), _key(F.col("conv_id")).alias("conv"), _key(F.col("role")).alias("who"),
        F.when(shown == "", F.lit("unknown")).otherwise(shown).alias("shown"), _clean(F.col("text")).alias("body"),
    ).withColumn("at", F.coalesce("turn", F.lit(_NO_TURN))).withColumn("digest", F.md5("body"))
    alike = Window.partitionBy("conv", "shown").orderBy("who")
    names = turns.select("conv", "who", "shown").distinct().withColumn("n", F.row_number().over(alike)).select(
        "conv", "who", F.when(F.col("n") == 1, F.col("shown")).otherwise(F.concat_ws("#", "shown", F.col("n").cast("string"))).alias("speaker")
    )
    telling = [f"s{n}" for n in narrators]
    people = names.filter(~F.col("who").isin(*telling)).select("conv", F.col("who").alias("me"), F.col("speaker").alias("perspective"))
    slim = turns.select("conv", "at", "who", "digest", F.char_length("body").cast("long").alias("chars")).join(names, ["conv", "who"])
    rows = slim.join(people, "conv")
    role = F.when(F.col("who") == F.col("me"), "assistant").when(F.col("who").isin(*telling), "system").otherwise("user")
    head = F.concat(F.lit(OPEN), "role", F.when(F.col("role") == "user", F.concat(F.lit(" name="), "speaker")).otherwise(F.lit("")), F.lit("\n"))
    tail = CLOSE + "\n"
    rows = rows.withColumn("role", role).withColumn("lead", head)
    rows = rows.withColumn("size", F.char_length("lead") + F.col("chars") + len(tail))
    # Places: a running sum over slices of turns, inside a slice over cells
    # (the rows of a turn and speaker whose digests begin alike), and inside a
    # cell over its rows; the same for the number in the turn.  However many
    # rows have one turn number, or none, no cell is more than a part of them.
    rows = rows.withColumn("slice", F.floor(F.col("at") / slice_turns)).withColumn("cell", F.substring("digest", 1, DIGITS))
    key = ["conv", "me"]
    cells = rows.groupBy(*key, "slice", "at", "who", "cell").agg(F.sum("size").alias("all"), F.count(F.lit(1)).alias("n"))

    def past(*part: str):
        return Window.partitionBy(*part).rowsBetween(Window.unboundedPreceding, -1)

    def before(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    slices = cells.groupBy(*key, "slice").agg(F.sum("all").alias("all"))
    slices = slices.select(*key, "slice", before("all", past(*key).orderBy("slice")).alias("from_slice"))
    starts = cells.select(
        *key, "slice", "at", "who", "cell", before("all", past(*key, "slice").orderBy("at", "who", "cell")).alias("from_cell"),
        before("n", past(*key, "slice", "at").orderBy("who", "cell")).alias("earlier"),
    ).join(slices, [*key, "slice"])
    cell = [*key, "at", "who", "cell"]
    own = Window.partitionBy(*cell).orderBy("digest")
    rows = rows.withColumn("inside", before("size", past(*cell).orderBy("digest"))).withColumn("number", F.row_number().over(own))
    rows = rows.drop("slice").join(starts, cell)
    one = ["conv", "at", "who", "digest"]
    texts = turns.groupBy(*one).agg(F.first("conv_id").alias("conv_id"), F.first("turn").alias("turn"), F.first("body").alias("body"))
    start, learned = F.col("from_slice") + F.col("from_cell") + F.col("inside"), F.col("role") == "assistant"
    return rows.join(texts, one).select(
        "conv_id", "perspective", "turn", (F.col("earlier") + F.col("number")).cast("int").alias("part"), "role",
        F.when(F.col("role") == "user", F.col("speaker")).alias("name"),
        F.concat("lead", "body", F.lit(tail)).alias("segment"), start.alias("start_at"), (start + F.col("size")).alias("end_at"),
        F.when(learned, start + F.char_length("lead")).alias("mask_from"),
        F.when(learned, start + F.col("size") - len(tail)).alias("mask_to"),
    )
