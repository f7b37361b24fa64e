"""Repeated lines: one copy stays, in the document with the smallest id.

Two Bloom filters look for the lines worth a shuffle.  Every document gives
the 64-bit hashes of its keys, eight bytes a line; they are dealt by their
leading bits over tasks, each of which holds the once-seen filter of its part
of the hashes.  A hash that the filter has already seen goes into the
twice-seen filter, whose size is fixed.  A second pass looks every line up in
the twice-seen filter: only suspected repeats are shuffled, with their text,
so that the documents that hold a key are told apart exactly and the first of
them is chosen.  A last pass drops the lines; the text of a document without
suspected lines never leaves its task.

A false alarm of either filter costs one shuffled line; it changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsentinel.llm.common import pick, stored_at

MIN_LETTERS = 10
#: Parts of the hashes (by their leading bits), and hashes that a task gathers
#: before it hands them on.
PARTS_LOG = 12
GATHER = 1 << 20
#: Bits of the twice-seen filter for each part: 2^28 bits, 32 MB, in all.  More
#: repeats than fill it make more lines suspected.
TWICE_LOG = 16
#: Positions of a hash in each filter; room per hash and first size of the
#: once-seen filter, which grows by slices of doubled size.
PROBES = 4
ROOM = 16
FIRST_LOG = 16

_STRIP = b"\x20\x09\x0a\x0b\x0c\x0d"


def line_keys(text: str | None) -> list[bytes]:
    """The key of every line: white space stripped at both ends, A-Z
    lower-cased, in UTF-8 (which lower-casing bytes leaves whole)."""
    return [line.strip(_STRIP) for line in (text or "").encode().lower().split(b"\n")]


def _counts(key: bytes, letters: int) -> bool:
    """Whether the key has the letters (code points) that make it count."""
    return len(key) >= letters and (len(key) >= 4 * letters or sum(b & 0xC0 != 0x80 for b in key) >= letters)


def _places(hashes: np.ndarray, log: int) -> Iterator[np.ndarray]:
    """Positions of hashes in a filter of 2^log bits, from the bits that do
    not choose the part."""
    h = hashes * np.uint64(0x9E3779B97F4A7C15)
    step = (h >> np.uint64(17)) | np.uint64(1)
    low = hashes & np.uint64((1 << (64 - PARTS_LOG)) - 1)
    for i in range(PROBES):
        yield ((low + np.uint64(i) * step) >> np.uint64(3)) & np.uint64((1 << log) - 1)


def _put(bits: np.ndarray, at: np.ndarray) -> None:
    """Set bits of a packed filter.  Where two of them share a byte, one
    assignment may lose the other, which is then set again."""
    while len(at):
        byte, bit = (at >> np.uint64(3)).astype(np.int64), np.left_shift(1, (at & np.uint64(7)).astype(np.uint8), dtype=np.uint8)
        bits[byte] |= bit
        at = at[bits[byte] & bit == 0]


def _has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


class OnceSeen:
    """Bloom filter that grows: a slice that is full is followed by one of
    twice its size, so the share of false alarms stays small whatever the
    number of hashes, at `ROOM` bits for each."""

    def __init__(self) -> None:
        self.slices: list[tuple[int, np.ndarray]] = []
        self.room = 0

    def add(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the (distinct) hashes were seen before; all are from now on."""
        seen = np.zeros(len(hashes), bool)
        for log, bits in self.slices:
            hit = np.ones(len(hashes), bool)
            for at in _places(hashes, log):
                hit &= _has(bits, at)
            seen |= hit
        new = hashes[~seen]
        while len(new):
            if not self.room:
                log = FIRST_LOG + len(self.slices)
                self.slices.append((log, np.zeros(1 << (log - 3), np.uint8)))
                self.room = (1 << log) // ROOM
            now, new = new[: self.room], new[self.room :]
            self.room -= len(now)
            log, bits = self.slices[-1]
            for at in _places(now, log):
                _put(bits, at)
        return seen


def _hash_rows(letters: int):
    """(text) rows → (part, hashes): the keys' hashes, gathered by part; one
    that several of a task's documents hold is given twice."""

    def hand_on(held: list[int]) -> pa.RecordBatch:
        found, times = np.unique(np.array(held, np.uint64), return_counts=True)
        found = np.repeat(found, np.minimum(times, 2))
        part = (found >> np.uint64(64 - PARTS_LOG)).astype(np.int32)
        ends = np.flatnonzero(np.r_[part[1:] != part[:-1], True]) + 1 if len(part) else np.empty(0, int)
        starts = np.r_[0, ends[:-1]] if len(ends) else ends
        rows = [found[a:b].tobytes() for a, b in zip(starts, ends)]
        return pa.RecordBatch.from_arrays([pa.array(part[starts], pa.int32()), pa.array(rows, pa.binary())], ["part", "hashes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        for b in batches:
            for text in b.column(0).to_pylist():
                held.extend(xxhash.xxh3_64_intdigest(k) for k in set(line_keys(text)) if _counts(k, letters))
                if len(held) >= GATHER:
                    yield hand_on(held)
                    held = []
        if held:
            yield hand_on(held)

    return run


def _two_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, hashes) rows, all of a part in this task → the twice-seen filter
    of every part with a repeat."""
    once, twice = OnceSeen(), {}
    for b in batches:
        rows = b.column(1).to_pylist()
        if not rows:
            continue
        found, times = np.unique(np.frombuffer(b"".join(rows), np.uint64), return_counts=True)
        again = found[once.add(found) | (times > 1)]
        part = again >> np.uint64(64 - PARTS_LOG)
        for p in np.unique(part).tolist():
            bits = twice.setdefault(p, np.zeros(1 << (TWICE_LOG - 3), np.uint8))
            for at in _places(again[part == p], TWICE_LOG):
                _put(bits, at)
    for p, bits in twice.items():
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([_folded(bits)], pa.binary())], ["part", "bits"])


def _folded(bits: np.ndarray) -> bytes:
    """The filter in as few bits as keep it at most an eighth full: halves are
    laid over each other, which is the filter of that size."""
    while len(bits) > 8 and int(np.bitwise_count(bits).sum()) * 16 <= len(bits) * 8:
        bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
    return bits.tobytes()


class TwiceSeen:
    """The twice-seen filters of all parts, as one array of bits."""

    def __init__(self, parts: dict[int, bytes]) -> None:
        sizes = np.zeros(1 << PARTS_LOG, np.int64)
        for p, bits in parts.items():
            sizes[p] = len(bits) * 8
        self.start = (np.cumsum(sizes) - sizes).astype(np.uint64)
        self.mask = np.maximum(sizes - 1, 0).astype(np.uint64)
        self.empty = sizes == 0
        self.bits = np.frombuffer(b"".join(parts[p] for p in sorted(parts)), np.uint8)

    def suspects(self, hashes: np.ndarray) -> np.ndarray:
        part = (hashes >> np.uint64(64 - PARTS_LOG)).astype(np.int64)
        hit = ~self.empty[part]
        hashes, part, left = hashes[hit], part[hit], np.flatnonzero(hit)
        fine = np.ones(len(left), bool)
        for place in _places(hashes, TWICE_LOG):
            fine &= _has(self.bits, self.start[part] + (place & self.mask[part]))
        hit[left[~fine]] = False
        return hit


def _looker(filters, letters: int):
    """A function from text to its suspected keys with their line numbers."""
    held: list[TwiceSeen] = []

    def look(text: str | None) -> tuple[int, dict[bytes, list[int]]]:
        if not held:
            held.append(TwiceSeen(filters.value))
        lines: dict[bytes, list[int]] = {}
        keys = line_keys(text)
        for i, key in enumerate(keys):
            lines.setdefault(key, []).append(i)
        long = [k for k in lines if _counts(k, letters)]
        if not long:
            return len(keys), {}
        hit = held[0].suspects(np.array([xxhash.xxh3_64_intdigest(k) for k in long], np.uint64))
        return len(keys), {k: lines[k] for k, h in zip(long, hit.tolist()) if h}

    return look


def _occurrences(filters, letters: int):
    """(row, doc_id, text) → one (row, doc_id, key, lines) per suspected key."""
    names = ["row", "doc_id", "key", "lines"]
    kinds = [pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = _looker(filters, letters)
        for b in batches:
            out: list[tuple] = []
            for row, doc_id, text in zip(*(c.to_pylist() for c in b.columns)):
                for key, lines in look(text)[1].items():
                    out.append((row, doc_id, key, lines))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

    return run


def _checked(filters, letters: int):
    """(row, doc_id, text) → the same with the number of lines and whether
    some are suspected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = _looker(filters, letters)
        for b in batches:
            found = [look(t) for t in b.column(2).to_pylist()]
            n, suspected = pa.array([f[0] for f in found], pa.int64()), pa.array([bool(f[1]) for f in found], pa.bool_())
            yield pa.RecordBatch.from_arrays([*b.columns, n, suspected], ["row", "doc_id", "text", "n_lines", "suspected"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, n_lines, drops) → the text without its dropped lines."""
    for b in batches:
        texts, dropped = [], []
        for text, drops in zip(b.column(1).to_pylist(), b.column(3).to_pylist()):
            gone = {i for lines in drops or () for i in lines}
            texts.append("\n".join(line for i, line in enumerate((text or "").split("\n")) if i not in gone) if gone else text or "")
            dropped.append(len(gone))
        cols = [b.column(0), b.column(2), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_lines", "n_dropped", "text"])


def twice_seen(docs: DataFrame, letters: int = MIN_LETTERS) -> dict[int, bytes]:
    """The twice-seen filter of ``(…, text)`` documents, by part of the
    hashes: at most 2^(PARTS_LOG + TWICE_LOG) bits, whatever the input."""
    hashes = docs.select("text").mapInArrow(_hash_rows(letters), "part int, hashes binary")
    built = hashes.repartition("part").select("part", "hashes").mapInArrow(_two_filters, "part int, bits binary")
    return {r.part: bytes(r.bits) for r in built.toLocalIterator()}


def drop_repeated(docs: DataFrame, letters: int = MIN_LETTERS) -> DataFrame:
    """``documents`` → ``(doc_id, n_lines, n_dropped, text)``, one row per row.

    Keys of at least ``letters`` code points that at least two documents hold
    lose all their lines but those in the smallest ``doc_id``.  A document is
    what carries one ``doc_id``: rows that repeat it keep or lose a key
    together, and null ids are one document, after all others.  A null or
    empty text is one empty line; a document may lose all its lines and keep
    an empty text; ``n_lines`` counts before dropping.  An empty table gives no
    rows.
    """
    spark: SparkSession = docs.sparkSession
    # Rows of equal id and text hold the same lines, so they share a list.
    body = F.coalesce("text", F.lit(""))
    rows = pick(docs, "doc_id", "text").select(
        F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), body).cast("binary"))).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"), body.alias("text"),
    )
    filters = spark.sparkContext.broadcast(twice_seen(rows, letters))
    found, _ = stored_at(
        rows.mapInArrow(_occurrences(filters, letters), "row binary, doc_id long, key binary, lines array<int>"), "suspected_lines"
    )
    # A hot key is one row per task before the shuffle.  Null ids come last.
    # The repeated keys are stored: a join of two plain shuffles is one whose
    # hot keys adaptive execution can split.
    repeated, _ = stored_at(
        found.groupBy("key").agg(
            F.min("doc_id").alias("keep"), F.max("doc_id").alias("last"), F.max(F.col("doc_id").isNull()).alias("nameless")
        ).filter("keep <> last OR (nameless AND keep IS NOT NULL)").select("key", "keep"), "repeated_lines"
    )
    drops = (
        found.join(repeated, "key")
        .filter(~F.col("doc_id").eqNullSafe(F.col("keep")))
        .groupBy("row").agg(F.collect_list("lines").alias("drops"))
    )
    checked = rows.mapInArrow(
        _checked(filters, letters), "row binary, doc_id long, text string, n_lines long, suspected boolean"
    )
    untouched = checked.filter("NOT suspected").select("doc_id", "n_lines", F.lit(0).cast("long").alias("n_dropped"), "text")
    cut = checked.filter("suspected").join(drops, "row", "left").select("doc_id", "text", "n_lines", "drops")
    return untouched.unionByName(cut.mapInArrow(_cut, "doc_id long, n_lines long, n_dropped long, text string"))
