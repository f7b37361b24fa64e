"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target number of words and a weight schedule over training
time (piecewise linear on [0, 1]).  The integral of the schedule, scaled to
the target, is the source's cumulative token demand.  The source offers its
documents in a fixed pseudo-random order, again and again until its target is
met; the inverse of the cumulative demand at the words offered before gives
each pass over a document its training position, and rows are range-sorted by
position.  The pass that crosses the target is cut to the words that remain.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsentinel.llm.common import find, positional, row_hash, stored, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: Documents in a slice of a source's order, on average.
SLICE = 4096

#: Weight schedules over training time (time, weight), dealt to the sources
#: by rank: steady, early, late.
SCHEDULES = (
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 2.0), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 0.5), (0.5, 1.0), (1.0, 2.0)),
)


def _cumulative(schedule) -> list[tuple[float, float, float, float]]:
    """(time, weight, slope, integral so far as a share of the whole), one
    entry per linear piece."""
    pieces, done = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule[:-1], schedule[1:]):
        if t1 <= t0 or min(w0, w1) < 0:
            raise ValueError("schedule times must grow and weights be 0 or more")
        pieces.append((t0, w0, (w1 - w0) / (t1 - t0), done))
        done += (w0 + w1) / 2 * (t1 - t0)
    if done <= 0:
        raise ValueError("a schedule needs some weight")
    return [(t, w / done, s / done, c / done) for t, w, s, c in pieces]


def _inverse(share: Column, schedule) -> Column:
    """Training time at which the integral of the schedule reaches a share of
    the whole: the root of c + w x + s x^2 / 2 = share in its piece."""
    at: Column | None = None
    for t, w, s, c in _cumulative(schedule):
        left = share - F.lit(c)
        if s == 0:
            x = left / F.lit(w) if w else F.lit(0.0)
        else:
            x = (F.sqrt(F.greatest(F.lit(w * w) + F.lit(2 * s) * left, F.lit(0.0))) - F.lit(w)) / F.lit(s)
        time = F.lit(t) + x
        at = time if at is None else F.when(share >= F.lit(c), time).otherwise(at)
    return F.least(F.greatest(at, F.lit(0.0)), F.lit(1.0))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_size, docs)`` → with ``rank`` and ``target``.

    Sources by code point, null last, weigh ``weights`` in turn and share
    ``share`` times all words.  A target stops at ``most`` times its source's
    size, and what is over goes to the others by weight until none is above:
    target = min(most * size, level * weight) with the one level at which the
    targets add up.  The level is found from running sums over the sources
    (one row per source) in the order in which they reach their stop.
    """
    everything = Window.orderBy(F.col("source").isNull(), "source")
    s = sources.withColumn("rank", F.row_number().over(everything) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = s.withColumn("weight", weight).withColumn("stop", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("stop") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    s = s.withColumn(
        "level",
        (F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("stop").over(before), F.lit(0.0)))
        / F.sum("weight").over(after),
    )
    # The first source in this order that the level does not fill is where
    # the level holds; if all are full, each target is its stop.
    level = F.min_by(
        F.when(F.col("level") * F.col("weight") <= F.col("stop"), F.col("level")),
        F.when(F.col("level") * F.col("weight") <= F.col("stop"), F.struct(F.col("stop") / F.col("weight"), F.col("rank"))),
    ).over(whole)
    return s.withColumn("target", F.coalesce(F.least(F.col("stop"), level * F.col("weight")), F.col("stop"))).select(
        "source", "source_size", "docs", "rank", "target"
    )


def _order_hash(key: Column) -> Column:
    """A fixed pseudo-random place in [0, 2^52) from the document id."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("long")


def plan_mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, slice_docs: int = SLICE) -> DataFrame:
    """``documents`` → one row per input row: ``doc_id, source, size,
    source_size, rank, target, offered`` (words that the source offers before
    the document in each pass) and ``row_hash``.

    Null and empty texts have size 0 and take nothing; null sources are one
    source, the last; rows that repeat a ``doc_id`` are ordered by content and
    count each; an empty table gives no rows.  Running sums go over slices of
    a source's order, over the cells of a slice and over the rows of a cell,
    so neither a source nor an id that many rows carry is ever in one task.
    """
    moved, names = positional(docs)
    key, source, text = (F.col(f"_c{find(names, n)}") for n in ("doc_id", "source", "text"))
    cols = moved.select(
        key.alias("doc_id"), source.alias("source"), word_count(text).alias("size"),
        row_hash(moved).alias("row_hash"), _order_hash(key).alias("place"),
    )
    sized = stored(cols, "sizes")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    aims = stored(targets(per_source, weights, share, most), "targets")
    slices = F.greatest(F.lit(1), F.ceil(F.col("docs") / slice_docs))
    rows = sized.join(aims, sized["source"].eqNullSafe(aims["source"])).drop(aims["source"]).withColumn(
        # Divided, not multiplied: place * slices leaves a long above 2,048 slices.
        "slice", F.floor(F.col("place") / (F.lit(float(1 << 52)) / slices)).cast("long")
    )
    # Rows of one place (an id that many rows carry, or none) are cut further,
    # by the leading bits of their content hash.
    cell = ["rank", "slice", "place", "doc_id", "part"]
    rows = rows.withColumn("part", F.shiftright("row_hash", 56))
    cells = rows.groupBy(*cell).agg(F.sum("size").alias("words"))

    def before(words: str, window) -> Column:
        return F.coalesce(F.sum(words).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    slices_of = cells.groupBy("rank", "slice").agg(F.sum("words").alias("words"))
    slices_of = slices_of.select("rank", "slice", before("words", Window.partitionBy("rank").orderBy("slice")).alias("start"))
    # Most places are one row; only cells of several need its place inside.
    inside = Window.partitionBy(*cell).orderBy("row_hash")
    from_cell = before("words", Window.partitionBy("rank", "slice").orderBy("place", "doc_id", "part"))
    starts = cells.select(*cell, from_cell.alias("from_cell")).join(slices_of, ["rank", "slice"])
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) if c == "doc_id" else F.col(f"r.{c}") == F.col(f"s.{c}") for c in cell]
    on = same[0]
    for c in same[1:]:
        on = on & c
    placed = rows.withColumn("inside", before("size", inside)).alias("r").join(starts.alias("s"), on)
    return placed.select(
        "r.doc_id", "source", "size", "source_size", "r.rank", "target", (F.col("start") + F.col("from_cell") + F.col("inside")).alias("offered"), "row_hash"
    )


def passes(plan: DataFrame, most: int = MOST, schedules=SCHEDULES) -> DataFrame:
    """Adds ``taken`` (words over all passes) and ``passes``, an array of
    ``(take, position)``: the words of a pass and its training position."""
    budget = F.floor(F.col("target")).cast("long")
    each = []
    for k in range(int(most)):
        before = F.col("offered") + F.col("source_size") * k
        take = F.least(F.greatest(budget - before, F.lit(0)), F.col("size"))
        demand = F.when(F.col("target") > 0, F.least(before / F.col("target"), F.lit(1.0))).otherwise(F.lit(0.0))
        time = None
        for i, schedule in enumerate(schedules):
            here = _inverse(demand, schedule)
            time = here if time is None else F.when(F.col("rank") % len(schedules) == i, here).otherwise(time)
        each.append(F.struct(take.cast("long").alias("take"), time.alias("position")))
    some = F.filter(F.array(*each), lambda p: p["take"] > 0)
    return plan.withColumn("passes", some).withColumn(
        "taken", F.aggregate("passes", F.lit(0).cast("long"), lambda a, p: a + p["take"])
    )


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, schedules=SCHEDULES, slice_docs: int = SLICE) -> DataFrame:
    """``documents`` → one row per input row: ``doc_id, source, size,
    source_size, target, taken, position`` (of its first pass; null if the mix
    leaves it out), ``passes`` and ``row_hash``, range-sorted by position
    (rows left out come last, by id).  See `plan_mix` for nulls, ties and
    empty input."""
    done = passes(plan_mix(docs, weights, share, most, slice_docs), most, schedules)
    out = stored(done.withColumn("position", F.get("passes", F.lit(0))["position"]), "mix")
    order = [F.col("position").isNull(), F.col("position"), F.col("doc_id"), F.col("row_hash")]
    return out.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "doc_id", "source", "size", "source_size", "target", "taken", "position", "passes", "row_hash"
    )


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _first_words(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """The text up to its n-th word (null stays null)."""
    for text, take in texts:
        out = []
        for t, n in zip(text.to_pylist(), take.to_pylist()):
            end = None if t is None else next(islice(_WORD.finditer(t), n - 1, None), None)
            out.append(t if end is None else t[: end.end()])
        yield pa.array(out, pa.string())


def training_rows(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, schedules=SCHEDULES) -> DataFrame:
    """The documents as training reads them: one row per pass, range-sorted
    by position, with the columns of the input.  A pass that is cut (one per
    source at most) keeps the first words of its text, and ``n_chars``, if
    there, becomes its new length.  Rows equal in every column are joined to
    their passes as one text."""
    moved, names = positional(docs)
    text, key = f"_c{find(names, 'text')}", f"_c{find(names, 'doc_id')}"
    plan = passes(plan_mix(docs, weights, share, most), most, schedules)
    each = plan.select(
        F.col("doc_id").alias("_id"), F.col("row_hash").alias("_hash"), F.col("size").alias("_size"), F.explode("passes").alias("_pass")
    )
    same = Window.partitionBy(key, "_hash").orderBy(F.lit(1))
    once = moved.withColumn("_hash", row_hash(moved)).withColumn("_n", F.row_number().over(same)).filter("_n = 1").drop("_n")
    rows = once.join(each.withColumnRenamed("_hash", "_of"), F.col(key).eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_of")))
    cut = F.col("_pass.take") < F.col("_size")
    rows = rows.withColumn("_cut", F.arrow_udf(_first_words, "string")(F.when(cut, F.col(text)), F.col("_pass.take"))).withColumn(text, F.coalesce("_cut", F.col(text)))
    if any(n.lower() == "n_chars" for n in names):
        chars = f"_c{find(names, 'n_chars')}"
        kind = dict(moved.dtypes)[chars]
        rows = rows.withColumn(chars, F.when(cut, F.char_length(text).cast(kind)).otherwise(F.col(chars)))
    order = [F.col("_pass.position"), F.col("_id"), F.col("_hash")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*moved.columns).toDF(*names)
