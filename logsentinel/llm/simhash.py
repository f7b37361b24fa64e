"""SimHash near-duplicates through a byte-position inverted index.

A 64-bit fingerprint is eight positional bytes.  Fingerprints at ``d`` or
fewer differing bits agree in at least ``8 - d`` of them.  The inverted index
posts a fingerprint under several of its positional bytes at once, such that
every pair with the guaranteed number of matching bytes meets in a posting
list; in a list, the shared positional bytes of each pair are tallied, pairs
below the guarantee are left out and the rest is verified bit by bit.

Only distinct fingerprints are posted, so a group of copies is one posting.
A list answers with a spanning forest of its links, never with all its pairs.
A list above ``TALLY_LIMIT`` is posted again under ``8 - d`` bytes: its
members then share the guaranteed bytes by construction and differ in ``d``
free bytes only, so a list has at most 65,536 members, and these are linked
through their one-bit neighbours, which is exact for two bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsentinel.llm.common import find, pick, positional, row_hash, stored
from logsentinel.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Longest posting list that is tallied pair by pair (64 K pairs in memory).
TALLY_LIMIT = 256
#: Hashes taken at once, so that a very long text needs bounded memory.
BLOCK = 1 << 15

#: Four of the eight bytes: two of four two-byte groups.  Two differing bytes
#: touch two groups at most, so two groups of any linked pair are whole.
_GROUPS = [(0, 1), (2, 3), (4, 5), (6, 7)]
FOURS = [a + b for a, b in combinations(_GROUPS, 2)]
SIXES = list(combinations(range(8), 6))


def _mask(at: tuple[int, ...]) -> int:
    return sum(255 << 8 * i for i in at)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes | None, words: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of a UTF-8 text (null or no word: zero)."""
    from xxhash import xxh64_intdigest

    w = (text or b"").lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not w:
        return 0
    if len(w) < words:
        parts, n = [b" ".join(w)], 1
    else:
        n = len(w) - words + 1
        parts = map(b" ".join, zip(*(w[i : n + i] for i in range(words))))
    ones = np.zeros(64, np.int64)
    hashes = np.fromiter((xxh64_intdigest(s, seed) for s in parts), np.uint64, n)
    for at in range(0, n, BLOCK):
        block = hashes[at : at + BLOCK]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``(doc_id, fp long)``, one row per document; whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t, words, seed) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    docs = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return docs.mapInArrow(run, "doc_id long, fp long")


def _forest(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Label of each of a few fingerprints (sorted by id): the index of the
    first member of its component."""
    x = fps[:, None] ^ fps[None, :]
    tally = (x.view(np.uint8).reshape(len(fps), len(fps), 8) == 0).sum(2)
    near = (tally >= 8 - max_bits) & (np.bitwise_count(x) <= max_bits)
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(1)
        if (new == label).all():
            return label
        label = new


def _neighbours(fps: np.ndarray) -> np.ndarray:
    """As `_forest` for any number of fingerprints and two bits: fingerprints
    at two bits or fewer are those that share a value at one bit or fewer."""
    n = len(fps)
    free = np.bitwise_or.reduce(fps ^ fps[0])
    flips = np.array([0] + [1 << i for i in range(64) if int(free) >> i & 1], np.uint64)
    keys = (fps[:, None] ^ flips[None, :]).ravel()
    owner = np.repeat(np.arange(n), len(flips))
    _, key = np.unique(keys, return_inverse=True)
    label = np.arange(n)
    while True:
        low = np.full(key.max() + 1, n)
        np.minimum.at(low, key, label[owner])
        new = low[key].reshape(n, -1).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _runs(batches: Iterator[pa.RecordBatch], limit: int | None = None):
    """Posting lists of a partition sorted by (slot, part, rep): slot, ids,
    fingerprints and whether the list is above the limit.  Such a list comes
    in pieces, so it is never held whole."""
    held: list[np.ndarray] = []
    long = None  # the list above the limit that is still open
    for b in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        held = [np.concatenate([h, c]) for h, c in zip(held, cols)] if held else cols
        slot, part, rep, fp = held
        ends = np.append(0, np.flatnonzero((slot[1:] != slot[:-1]) | (part[1:] != part[:-1])) + 1)
        sizes = np.diff(ends)
        for i in np.flatnonzero((sizes > 1) | (np.arange(len(sizes)) == 0)):
            s, e = ends[i], ends[i + 1]
            rest = (slot[s], part[s]) == long
            if e - s > 1 or rest:
                yield slot[s], rep[s:e], fp[s:e], rest or bool(limit and e - s > limit)
        held = [h[ends[-1] :] for h in held]
        if len(held[0]) and limit and (len(held[0]) > limit or (held[0][0], held[1][0]) == long):
            long = (held[0][0], held[1][0])
            yield held[0][0], held[2], held[3], True
            held = []
    if held and len(held[0]) > 1:
        yield held[0][0], held[2], held[3], bool(limit and len(held[0]) > limit)


_EDGE = "kind int, slot int, part long, rep long, fp long, low long"


def _lists(limit: int, max_bits: int):
    """Answers of the posting lists: kind 0 is a link (rep, low), kind 1 a
    posting under six bytes of a list above the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "slot", "part", "rep", "fp", "low"]
        a, b, n = [], [], 0
        for slot, rep, fp, long in _runs(batches, limit):
            u = fp.view(np.uint64)
            if long:
                for k, six in enumerate(SIXES):
                    if set(FOURS[slot]) <= set(six):
                        part = (u & np.uint64(_mask(six))).view(np.int64)
                        m = len(u)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(m, 1, np.int32)), pa.array(np.full(m, k, np.int32)), pa.array(part), pa.array(rep), pa.array(fp), pa.nulls(m, pa.int64())], names
                        )
                continue
            label = _forest(u, max_bits)
            at = np.flatnonzero(label != np.arange(len(u)))
            if len(at):
                a.append(rep[at])
                b.append(rep[label[at]])
                n += len(at)
            if n > 10_000:
                yield _links(a, b, names)
                a, b, n = [], [], 0
        if n:
            yield _links(a, b, names)

    return run


def _links(a: list, b: list, names: list[str]) -> pa.RecordBatch:
    rep, low = np.concatenate(a), np.concatenate(b)
    none = pa.nulls(len(rep), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(len(rep), np.int32)), pa.array(np.zeros(len(rep), np.int32)), none, pa.array(rep), none, pa.array(low)], names
    )


def _refined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the lists under six bytes; a fingerprint that came in through
    several longer lists counts once."""
    for _, rep, fp, _ in _runs(batches):
        rep, first = np.unique(rep, return_index=True)
        if len(rep) > 1:
            label = _neighbours(fp[first].view(np.uint64))
            at = np.flatnonzero(label != np.arange(len(rep)))
            yield pa.RecordBatch.from_arrays([pa.array(rep[at]), pa.array(rep[label[at]])], ["u", "v"])


def _postings(distinct: DataFrame) -> DataFrame:
    keys: list[Column] = [
        F.struct(F.lit(k).alias("slot"), F.col("fp").bitwiseAND(F.lit(_signed(_mask(at)))).alias("part"))
        for k, at in enumerate(FOURS)
    ]
    return distinct.select(F.explode(F.array(*keys)).alias("k"), "rep", "fp").select("k.slot", "k.part", "rep", "fp")


def _grouped(postings: DataFrame) -> DataFrame:
    return postings.repartition("slot", "part").sortWithinPartitions("slot", "part", "rep")


def links(distinct: DataFrame, max_bits: int = MAX_BITS, limit: int = TALLY_LIMIT) -> DataFrame:
    """``(rep, fp)`` with distinct fingerprints → ``(u, v)`` links between
    reps that connect exactly the fingerprints at ``max_bits`` or fewer."""
    if max_bits != 2:
        raise ValueError("the index is laid out for two differing bits")
    found = stored(_grouped(_postings(distinct)).mapInArrow(_lists(limit, max_bits), _EDGE), "postings")
    plain = found.filter("kind = 0").select(F.col("rep").alias("u"), F.col("low").alias("v"))
    again = _grouped(found.filter("kind = 1").select("slot", "part", "rep", "fp"))
    return plain.unionByName(again.mapInArrow(_refined, "u long, v long"))


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED, limit: int = TALLY_LIMIT
) -> DataFrame:
    """``documents`` → ``(doc_id, fingerprint, component_id)``, one row per
    input row.

    Texts are lower-cased in A-Z; null and empty texts and texts without a
    word have fingerprint zero and link like any other; texts shorter than a
    shingle hash whole.  Rows with a null ``doc_id`` get their fingerprint and
    a null component.  Repeated rows share fingerprint and component.  An
    empty table gives no rows; other columns are ignored.
    """
    prints = stored(fingerprints(docs, words, seed), "simhash")
    distinct = stored(
        prints.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct"
    )
    comps = connected_components(links(distinct, max_bits, limit))
    whole = distinct.join(comps, F.col("rep") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")
    )
    # One fingerprint may hold a third of all rows: the class side has each
    # fingerprint once, so adaptive execution can split the document side.
    joined = prints.join(whole, "fp", "left")
    return joined.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """The documents with one of each near-duplicate component kept: the row
    with the smallest ``doc_id``, and of several rows of that id the one with
    the smallest content hash.  Rows without a ``doc_id`` stay.  Rows are told
    apart by their content, so unlike texts that carry one id are not taken
    for copies; of equal rows one stays.  Columns, their order and their names
    are unchanged."""
    moved, names = positional(docs)
    key, text = f"_c{find(names, 'doc_id')}", f"_c{find(names, 'text')}"
    rows = moved.filter(F.col(key).isNotNull()).withColumn("_hash", row_hash(moved))
    # The content hash goes through the operator in place of the id.
    near = near_duplicates(rows.select(F.col("_hash").alias("doc_id"), F.col(text).alias("text")), **params)
    ids = rows.select("_hash", F.col(key).cast("long").alias("_id")).distinct()
    keep = (
        near.select(F.col("doc_id").alias("_hash"), "component_id").distinct().join(ids, "_hash")
        .groupBy("component_id").agg(F.min_by("_hash", F.struct("_id", "_hash")).alias("_keep"))
    )
    once = rows.join(keep.select(F.col("_keep").alias("_hash")), "_hash", "left_semi")
    # Equal rows: one stays; the limit is also applied before the shuffle.
    only = Window.partitionBy("_hash").orderBy(key)
    kept = once.withColumn("_n", F.row_number().over(only)).filter("_n = 1")
    return kept.select(*moved.columns).unionByName(moved.filter(F.col(key).isNull())).toDF(*names)
