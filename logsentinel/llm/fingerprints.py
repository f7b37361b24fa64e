"""Document fingerprints by locally consistent parsing.

A text's bytes are parsed into phrases whose borders depend on a few
neighbouring symbols only: runs of one symbol become one symbol, rounds of
deterministic coin tossing give neighbouring symbols small, different labels,
and each local maximum of the labels starts a phrase.  A phrase's name is a
hash of its symbols; the names are the symbols of the next level.  Equal
substrings thus get equal names inside, wherever they stand.  The fingerprint
keeps, for each of four levels, the smallest hash of the phrase names in each
of 32 slots (above the first level each occurrence of a name counts by its
number, so a text of few phrases that repeat is told by how often they do);
the likeness of two fingerprints is the mean share of equal slots
over the levels that a text of that length fills.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsentinel.llm.common import pick

#: Levels whose phrases are sketched (a phrase of level 1 has about 3 bytes,
#: of level 2 about 12, of level 3 about 40, of level 4 about 140), slots of a
#: level, and filled slots from which a level counts.
LEVELS = (1, 2, 3, 4)
SLOTS = 32
ENOUGH = 4
#: Bytes parsed at once, and rows that a task takes out of a batch at once.
BLOCK = 1 << 18
ROWS = 256

_ONE = np.uint64(1)
_SEP_LABEL = 16
#: Sets a name's second, third ... occurrence apart from its first.
_TIMES = np.uint64(0xC2B2AE3D27D4EB4F)
_POWERS = np.ones(1 << 12, np.uint64)
with np.errstate(over="ignore"):
    _POWERS[1:] = np.cumprod(np.full((1 << 12) - 1, 0x9E3779B97F4A7C15, np.uint64))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _toss_table() -> np.ndarray:
    """Label from two small labels: twice the lowest bit in which they
    differ, plus that bit of the second."""
    a, b = np.arange(256)[:, None], np.arange(256)[None, :]
    differ = a ^ b
    low = np.bitwise_count((differ & -differ) - 1).astype(np.int64)
    return np.where(differ == 0, 0, 2 * low + (b >> low & 1)).astype(np.uint8).ravel()


_TOSS = _toss_table()


def _level(x: np.ndarray) -> np.ndarray:
    """Names of the phrases of a symbol string.  Texts are separated by the
    symbol 0, which stays a phrase of its own; nothing depends on symbols
    beyond it."""
    # Runs of one symbol become one symbol, so neighbours differ.
    start = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=start[1:])
    start |= x == 0
    at = np.flatnonzero(start)
    if len(at) < len(x):
        length = np.diff(np.append(at, len(x))).astype(np.uint64)
        x = x[at]
        many = length > 1
        x[many] = _mix(x[many] + length[many] * np.uint64(0xA24BAED4963EE407)) | _ONE
    sep = x == 0
    # First toss on 64-bit names, then two on small labels.
    differ = x[1:] ^ x[:-1]
    low = np.bitwise_count((differ & (~differ + _ONE)) - _ONE).astype(np.uint8)
    label = np.zeros(len(x), np.uint8)
    label[1:] = (low << 1) | ((x[1:] >> np.minimum(low, 63).astype(np.uint64)) & _ONE).astype(np.uint8)
    label[sep] = 128
    for mark in (16, _SEP_LABEL):
        pair = label[:-1].astype(np.uint16) << 8
        pair |= label[1:]
        label[1:] = _TOSS[pair]
        label[sep] = mark
    cut = np.zeros(len(x), bool)
    cut[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    cut |= sep
    cut[0] = True
    cut[1:] |= sep[:-1]
    starts = np.flatnonzero(cut)
    sizes = np.diff(np.append(starts, len(x)))
    place = np.arange(len(x)) - np.repeat(starts, sizes)
    names = np.add.reduceat(_mix(x) * _POWERS[place & 4095], starts)
    names = _mix(names + sizes.astype(np.uint64)) | _ONE
    names[sep[starts]] = 0
    return names


def _occurrence(names: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How many equal names of its text stand before each name."""
    key = names ^ _mix(doc.astype(np.uint64) + _ONE)
    order = np.argsort(key, kind="stable")
    ranked, at = key[order], np.arange(len(key))
    first = np.ones(len(key), bool)
    first[1:] = ranked[1:] != ranked[:-1]
    out = np.empty(len(key), np.uint64)
    out[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return out


def _sketch(texts: list[bytes]) -> np.ndarray:
    out = np.zeros((len(texts), len(LEVELS), SLOTS), np.uint16)
    x = np.frombuffer(b"\xff" + b"\xff".join(texts) + b"\xff", np.uint8).astype(np.uint64) + _ONE
    x[x == 256] = 0  # 0xFF is in no UTF-8 text
    for level in range(1, max(LEVELS) + 1):
        x = _level(x)
        if level in LEVELS:
            sep = x == 0
            doc = np.cumsum(sep) - 1
            names, doc = x[~sep], doc[~sep]
            if level > 1:
                names = names + _occurrence(names, doc) * _TIMES
            names = _mix(names + np.uint64(level))
            slot = (doc * SLOTS).astype(np.uint64) + (names & np.uint64(SLOTS - 1))
            value = np.maximum(names >> np.uint64(48), _ONE)
            ranked = np.sort(slot << np.uint64(16) | value)
            key = ranked >> np.uint64(16)
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            flat = out[:, LEVELS.index(level), :]
            flat[(key[first] // SLOTS).astype(int), (key[first] % SLOTS).astype(int)] = ranked[first] & np.uint64(0xFFFF)
    return out


def sketches(texts: list[str]) -> np.ndarray:
    """Fingerprints of texts as an array (text, level, slot); an empty text
    has only empty slots (0).  The result of a text does not depend on the
    others."""
    raw = [t.encode() for t in texts]
    parts, some, size = [np.zeros((0, len(LEVELS), SLOTS), np.uint16)], [], 0
    for i, t in enumerate(raw):
        some.append(t)
        size += len(t)
        if size >= BLOCK or i + 1 == len(raw):
            parts.append(_sketch(some))
            some, size = [], 0
    return np.concatenate(parts)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per pair of fingerprints, the mean over levels of the share of equal
    slots among those that either fills.  Levels above the first count from
    ``ENOUGH`` such slots; the first, whose short phrases also occur in
    unlike texts, counts if no other does.  Two empty fingerprints are alike."""
    used = ((a != 0) | (b != 0)).sum(2)
    share = ((a == b) & (a != 0)).sum(2) / np.maximum(used, 1)
    counts = used >= ENOUGH
    counts[:, 0] = ~counts[:, 1:].any(1)
    mean = (share * counts).sum(1) / counts.sum(1)
    return np.where(used[:, 0] == 0, 1.0, mean)


def _hex(sketch: np.ndarray) -> str:
    return sketch.astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the start of another."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n] if n else text


_COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_NAMES = [c.split()[0] for c in _COLUMNS.split(", ")]


def _rows(ids: list, texts: list[str], following: list[str], own: np.ndarray, after: np.ndarray) -> pa.RecordBatch:
    changed = [edited(t, n) for t, n in zip(texts, following)]
    other = sketches(changed)
    columns = (
        ids, [len(t) for t in texts], [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        [_hex(s) for s in own], [_hex(s) for s in other], likeness(own, other), likeness(own, after),
    )
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], _NAMES)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition sorted by (range, last, id): each with its
    successor.  A range ends with a copy of the next range's first row
    (``last``), which has no row of its own."""
    held: tuple | None = None  # the last row so far: id, text, fingerprint, last
    for b in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
        last, ids, texts = (c.to_pylist() for c in b.columns)
        at = 0
        while at < len(ids):
            end, size = at, 0
            while end < len(ids) and size < BLOCK:
                texts[end] = texts[end] or ""
                size += len(texts[end])
                end += 1
            prints = sketches(texts[at:end])
            rows: list[tuple] = [] if held is None else [held]
            rows += zip(ids[at:end], texts[at:end], prints, last[at:end])
            # A copy is only a successor; what follows it starts a new range.
            own = [i for i in range(len(rows) - 1) if not rows[i][3]]
            if own:
                yield _rows(
                    [rows[i][0] for i in own], [rows[i][1] for i in own], [rows[i + 1][1] for i in own],
                    np.stack([rows[i][2] for i in own]), np.stack([rows[i + 1][2] for i in own]),
                )
            held = rows[-1]
            at = end


#: Ids sampled per range to place the borders of the ranges.
SAMPLED = 25


def _borders(seen: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First id and text hash of the ranges after the first, from a sorted
    sample of ids.  An id that several borders fall on holds more rows than a
    range should: it starts one, and its rows are cut into as many by their
    text hash, which is spread evenly."""
    values, times = np.unique(seen[np.arange(1, n) * len(seen) // n], return_counts=True) if len(seen) and n > 1 else (np.zeros(0, np.int64),) * 2
    ids = np.repeat(values, times)
    hashes = [-(1 << 63) + (k << 64) // m for m in times.tolist() for k in range(m)]
    return ids.astype(np.int64), np.array(hashes, np.int64)


def _ranges(docs: DataFrame, n: int) -> Callable[[DataFrame], DataFrame]:
    """Adds to rows the number of their range in the order of ids and text
    hashes, of n about equal ones; rows without an id come first.  The borders
    come from a sample of ids (``SAMPLED`` per range); every row falls in one
    range whatever they are."""
    low = -(1 << 63)
    ids = docs.select(F.coalesce("doc_id", F.lit(low)).alias("doc_id"))
    share = min(1.0, SAMPLED * n / max(ids.count(), 1))
    border_ids, border_hashes = _borders(np.sort(np.array([r.doc_id for r in ids.sample(share, seed=1).collect()], np.int64)), n)

    def number(ids: pa.Array, orders: pa.Array) -> pa.Array:
        values, hashes = ids.fill_null(low).to_numpy(zero_copy_only=False), orders.to_numpy(zero_copy_only=False)
        first, end = np.searchsorted(border_ids, values, "left"), np.searchsorted(border_ids, values, "right")
        out = end.copy()
        for v in np.unique(values[first < end]):
            at = np.flatnonzero(values == v)
            i, j = first[at[0]], end[at[0]]
            out[at] = i + np.searchsorted(border_hashes[i:j], hashes[at], "right")
        return pa.array(out.astype(np.int32))

    def add(rows: DataFrame) -> DataFrame:
        if not len(border_ids):
            return rows.withColumn("range", F.lit(0))
        return rows.withColumn("range", F.arrow_udf(_one_batch(number), "int")("doc_id", "order"))

    return add


def _one_batch(function: Callable[[pa.Array, pa.Array], pa.Array]):
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for b in batches:
            yield function(*b)

    return run


def fingerprint_edits(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """``documents`` → one row per input row: ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The next document is the one that follows by ``doc_id`` (null ids first,
    rows that repeat an id by the hash of their text); after the last comes
    the first, so a single document follows itself.  Null texts are as empty;
    an empty text has the fingerprint of empty slots; equal texts have equal
    fingerprints; an empty table gives no rows; other columns are ignored.

    Ids, and where one holds many rows their text hashes, are cut into ranges
    (four times the shuffle partitions, where none are given).  Each range gets a copy of the first row of the next range with
    rows, so the texts are shuffled once and each range is done on its own.
    """
    docs = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").withColumn("order", F.xxhash64("text"))
    spark = docs.sparkSession
    n = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = _ranges(docs, n)(docs)
    # The first row of each range, by id and hash alone: two numbers a range.
    first = sorted(
        (r.range, r.first.doc_id, r.first.order)
        for r in ranged.groupBy("range").agg(F.min(F.struct("doc_id", "order")).alias("first")).collect()
    )
    if not first:
        return spark.createDataFrame([], _COLUMNS)
    before = [r[0] for r in first[-1:] + first[:-1]]
    heads = spark.createDataFrame([(b, *r[1:]) for b, r in zip(before, first)], "range int, head_id long, head_order long")
    copies = (
        docs.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head_id")) & F.col("order").eqNullSafe(F.col("head_order")))
        .dropDuplicates(["range"]).select("range", F.lit(True).alias("last"), "doc_id", "text", "order")
    )
    rows = ranged.select("range", F.lit(False).alias("last"), "doc_id", "text", "order").unionByName(copies)
    placed = rows.repartition("range").sortWithinPartitions("range", "last", F.col("doc_id").asc_nulls_first(), "order")
    return placed.select("last", "doc_id", "text").mapInArrow(_in_order, _COLUMNS)
