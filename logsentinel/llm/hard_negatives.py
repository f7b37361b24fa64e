"""Hard negatives by slot-decomposed selection.

An anchor's positives are its best rows of the same label.  A positive with
score p asks for the best rows of other labels whose score lies in a window
from ``low`` to ``high`` per cent of p.  The windows of one anchor overlap, so
their upper limits, in descending order, cut the scores into disjoint slots;
each other-label row falls into one slot, whatever the number of windows.
Combiners keep the k best rows of each (anchor, slot).  The best k below an
upper limit are then the first k of its slot followed by all lower slots: one
merge per anchor, from the top, answers every window, and the lower limit only
cuts its end.

Anchors and rows are packed into blocks.  The blocks of rows are dealt into
cells of a bounded size; a task holds one cell and all blocks of anchors pass
by it, so nothing is joined or broadcast, and what moves is the rows once and
the anchors once a cell.  Scores are matrix products of a block of anchors and
slices of the cell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsentinel.llm.common import remove, stored, stored_at
from logsentinel.llm.vectors import LEAST, Best, integer_rows, longest, matrix, products

SCALE = 256
EVERY = 50
POSITIVES = 5
NEGATIVES = 3
#: The window of a negative's score, in per cent of the positive's.
LOW, HIGH = 50, 95
#: Rows and anchors in a block; blocks of anchors a task packs.
ROWS = 2048
ANCHORS = 512
PACKED = 8
#: Bytes of rows in a cell, which a task holds at once, and the blocks of rows
#: below which a cell is not divided only to keep more tasks busy.
CELL = 1 << 25
LEAST_BLOCKS = 4
#: Partitions for each cell, so that few cells share a task.
SPREAD = 4
#: Columns of the first and of the largest matrix product: the first ones give
#: floors, which leave little to gather from the others.
FIRST, MOST_COLUMNS = 128, 4096

_PACKED = "block long, n int, bytes long, ids binary, labels binary, rows binary"
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same integers in the narrowest type that holds them."""
    low, high = values.min(initial=0), values.max(initial=0)
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return values.astype(kind)


def _pack(size: int, dim: int):
    """(vec_id, label, v) rows → blocks of at most ``size`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), count()
        for b in batches:
            for at in range(0, b.num_rows, size):
                piece = b.slice(at, size)
                ids, labels = (np.asarray(piece.column(i).to_numpy(zero_copy_only=False), np.int64) for i in (0, 1))
                rows = _narrow(matrix(piece.column(2), dim)).tobytes()
                values = [[part << 32 | next(number)], [len(ids)], [len(rows)], [ids.tobytes()], [labels.tobytes()], [rows]]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], ["block", "n", "bytes", "ids", "labels", "rows"])

    return run


def _ints(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def _unpacked(data: bytes, n: int, dim: int) -> np.ndarray:
    """Rows of a block, in the type that `_narrow` chose."""
    return np.frombuffer(data, f"i{len(data) // (n * dim)}").reshape(n, dim)


def _marked(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`np.nonzero` of a mask of few true entries, eight looked at at once."""
    flat = mask.ravel()
    if flat.size % 8:
        at = np.flatnonzero(flat)
    else:
        near = np.flatnonzero(flat.view(np.uint64))
        at = (near[:, None] * 8 + np.arange(8)).ravel()
        at = at[flat[at]]
    return np.divmod(at, mask.shape[1])


class _Cell:
    """The rows of a cell in an order without meaning, or that by label."""

    def __init__(self, blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]], by_label: bool) -> None:
        ids, labels, rows = (np.concatenate(c) for c in zip(*blocks))
        order = np.random.default_rng(0).permutation(len(ids))
        if by_label:
            order = order[np.argsort(labels[order], kind="stable")]
        self.ids, self.labels, self.rows = ids[order], labels[order], rows[order]
        self.longest = max(longest(b[2]) for b in blocks)

    def slices(self, start: int, end: int) -> Iterator[slice]:
        size = FIRST
        while start < end:
            yield slice(start, min(start + size, end))
            start, size = start + size, min(2 * size, MOST_COLUMNS)


def _select(groups: int, k: int, dim: int, by_label: bool, gather: Callable):
    """Blocks of rows, then blocks of anchors of each cell → the k best of
    each (anchor row, group) in the cell.

    ``gather(cell, own ids, own labels, own rows, plan, best)`` adds the
    entries that count to ``best``."""
    fields = ["block", "place", "anchor_id", "slot", "score", "other"]

    def emit(block: int, own: np.ndarray, best: Best) -> pa.RecordBatch:
        place = best.group // groups
        cols = [np.full(len(place), block, np.int64), place, own[place], best.group % groups, best.score, best.id]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, blocks, held = None, [], None
        for b in batches:
            for i in range(b.num_rows):
                cell, asking, block, n, ids, labels, rows, plan = (c[i].as_py() for c in b.columns)
                if cell != at:
                    at, blocks, held = cell, [], None
                own, own_labels, own_rows = _ints(ids), _ints(labels), _unpacked(rows, n, dim)
                if not asking:
                    blocks.append((own, own_labels, own_rows))
                    continue
                if blocks:
                    held, blocks = _Cell(blocks, by_label), []
                if held is not None:
                    best = Best(n * groups, k)
                    gather(held, own, own_labels, own_rows, plan, best)
                    yield emit(block, own, best)

    return run


def _same_label(cell: _Cell, own, own_labels, own_rows, plan, best: Best) -> None:
    most = longest(own_rows) * cell.longest
    for label in np.unique(own_labels):
        places = np.flatnonzero(own_labels == label)
        for cut in cell.slices(*(int(np.searchsorted(cell.labels, label, side)) for side in ("left", "right"))):
            scores = products(own_rows[places], cell.rows[cut], most)
            at, col = _marked(scores >= best.floor[places].astype(scores.dtype)[:, None])
            place, others = places[at], cell.ids[cut][col]
            fine = own[place] != others
            best.add(place[fine], scores[at, col][fine].astype(np.int64), others[fine])


def _in_slots(positives: int):
    def gather(cell: _Cell, own, own_labels, own_rows, plan, best: Best) -> None:
        table = _ints(plan).reshape(len(own), positives + 1)
        places = np.flatnonzero(table[:, 0] > LEAST)
        limits, low = table[places, :positives], table[places, positives]
        asked, lowest = own_rows[places], places * positives + (limits > LEAST).sum(1) - 1
        most = longest(asked) * cell.longest
        for cut in cell.slices(0, len(cell.ids)):
            scores = products(asked, cell.rows[cut], most)
            # Once the lowest slot is full, no window reaches below its floor.
            floor = np.maximum(low, best.floor[lowest]).astype(scores.dtype)
            at, col = _marked((scores <= limits[:, 0].astype(scores.dtype)[:, None]) & (scores >= floor[:, None]))
            place, others = places[at], cell.ids[cut][col]
            fine = (own_labels[place] != cell.labels[cut][col]) & (own[place] != others)
            score, at = scores[at, col][fine].astype(np.int64), at[fine]
            slot = (limits[at] >= score[:, None]).sum(1) - 1
            best.add(place[fine] * positives + slot, score, others[fine])

    return gather


def _share(score: str, per_cent: int, up: bool) -> Column:
    """floor (or, with ``up``, ceiling) of per_cent / 100 of a score that is
    not negative, without leaving a long."""
    extra = 99 if up else 0
    return F.expr(f"({score} div 100) * {per_cent} + (({score} % 100) * {per_cent} + {extra}) div 100")


def _plans(positives: int):
    """Limits of every anchor of a block as one table: its slots' upper
    limits in descending order, then its lowest lower limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for n, places, highs, lows in zip(*(b.column(i).to_pylist() for i in (1, 2, 3, 4))):
                table = np.full((n, positives + 1), LEAST, np.int64)
                table[:, positives] = -LEAST  # no window: nothing is inside
                for place, high, low in zip(places, highs, lows):
                    limits = sorted(set(high), reverse=True)
                    table[place, : len(limits)] = limits
                    table[place, positives] = low
                out.append(table.tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["block", "plan"])

    return run


def mine(
    vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, every: int = EVERY,
    scale: int = SCALE, low: int = LOW, high: int = HIGH, turned: int | None = 7, classes: int = 10,
    rows: int = ROWS, anchors: int = ANCHORS,
) -> DataFrame:
    """``embeddings`` → ``(anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score)``.

    Anchors are the rows whose ``vec_id`` is divisible by ``every``; their
    positives the first ``positives`` other rows of the same label; each
    positive gets the first ``negatives`` rows of other labels whose score
    lies between ``low`` and ``high`` per cent of its own (both included).
    Higher integer inner products come first, ties by smaller ``vec_id``.
    Where ``turned`` divides ``vec_id``, the label first becomes
    ``(label + 1) % classes``.

    Rows with a null label, ``vec_id`` or vector, or a null or non-finite
    component, take no part.  Rows that repeat a ``vec_id`` all count, each as
    an anchor, positive or negative of its own, but never meet an anchor of
    their own id.  Vectors of different length are compared as if the shorter
    one went on with zeros; scores beyond a long stop at its limits.  A
    negative positive's window is empty; fewer rows than asked for give all;
    an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows_in = integer_rows(vectors, scale, "label").select("vec_id", F.col("label").cast("long").alias("label"), "v")
    if turned:
        moved = F.when(F.col("vec_id") % turned == 0, (F.col("label") + 1) % classes).otherwise(F.col("label"))
        rows_in = rows_in.withColumn("label", moved)
    clean, clean_path = stored_at(rows_in.filter("label IS NOT NULL"), "labelled")
    asking = F.col("vec_id") % every == 0
    dim, n_anchors = clean.agg(F.max(F.size("v")), F.count_if(asking)).first()
    if dim is None:
        remove(spark, clean_path)
        return spark.createDataFrame([], _RESULT)
    dim = max(dim, 1)

    blocks, blocks_path = stored_at(clean.mapInArrow(_pack(rows, dim), _PACKED), "negative_blocks")
    asked = clean.filter(asking).repartition(max(1, -(-n_anchors // (PACKED * anchors))))
    queries, queries_path = stored_at(asked.mapInArrow(_pack(anchors, dim), _PACKED), "anchors")
    remove(spark, clean_path)
    n_rows, n_bytes = blocks.agg(F.sum("n"), F.sum("bytes")).first()
    cells = max(-(-n_bytes // CELL), min(-(-n_rows // (LEAST_BLOCKS * rows)), 2 * spark.sparkContext.defaultParallelism))
    dealt = F.expr(f"cast(pmod(shiftright(block, 32) + (block & 4294967295), {cells}) as int)")

    def met(asked: DataFrame) -> DataFrame:
        """A cell's rows, then all anchors, cell after cell."""
        packed = "block", "n", "ids", "labels", "rows"
        held = blocks.select(dealt.alias("cell"), F.lit(False).alias("asking"), *packed, F.lit(None).cast("binary").alias("plan"))
        passing = asked.select(F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"), F.lit(True).alias("asking"), *packed, "plan")
        return held.union(passing).repartition(SPREAD * cells, "cell").sortWithinPartitions("cell", "asking")

    found = "block long, place long, anchor_id long, slot long, score long, other long"

    def first(df: DataFrame, k: int, *keys: str) -> DataFrame:
        best = Window.partitionBy(*keys).orderBy(F.desc("score"), "other")
        return df.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    # The positives, and with them the windows of every anchor.
    near = met(queries.withColumn("plan", F.lit(None).cast("binary"))).mapInArrow(_select(1, positives, dim, True, _same_label), found)
    windows = first(near, positives, "block", "place").filter("score >= 0").select(
        "block", "place", "anchor_id", F.col("other").alias("positive_id"), F.col("score").alias("positive_score"),
        _share("score", high, False).alias("high"), _share("score", low, True).alias("low"),
    )
    slots = Window.partitionBy("block", "place").orderBy(F.desc("high"))
    windows, windows_path = stored_at(windows.withColumn("slot", F.dense_rank().over(slots) - 1), "windows")

    # The best rows of other labels in every slot.
    per_anchor = windows.groupBy("block", "place").agg(F.collect_set("high").alias("highs"), F.min("low").alias("low"))
    per_block = per_anchor.groupBy("block").agg(F.collect_list(F.struct("place", "highs", "low")).alias("a"))
    plans = per_block.join(queries.select("block", "n").hint("merge"), "block").select(
        "block", "n", F.col("a.place").alias("places"), F.col("a.highs").alias("highs"), F.col("a.low").alias("lows")
    ).mapInArrow(_plans(positives), "block long, plan binary")
    in_slots = met(queries.join(plans.hint("merge"), "block")).mapInArrow(_select(positives, negatives, dim, False, _in_slots(positives)), found)
    kept = first(in_slots, negatives, "block", "place", "slot")

    # One descending list per anchor: slot after slot, so that the rows under
    # any upper limit are the list from that limit's slot on.
    merged = kept.groupBy("block", "place").agg(
        F.array_sort(F.collect_list(F.struct("slot", "rank", F.col("other").alias("id"), "score"))).alias("list")
    )
    taken = windows.join(merged.hint("merge"), ["block", "place"]).withColumn(
        "taken", F.slice(F.filter("list", lambda x: x["slot"] >= F.col("slot")), 1, negatives)
    )
    out = (
        taken.select("anchor_id", "positive_id", "positive_score", "low", F.posexplode("taken").alias("at", "t"))
        .filter("t.score >= low")
        .select(
            "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("t.id").alias("negative_id"),
            "positive_score", F.col("t.score").alias("negative_score"),
        )
    )
    result = stored(out, "hard_negatives")
    for path in (blocks_path, queries_path, windows_path):
        remove(spark, path)
    return result
