"""Exact top-k inner products over norm-sorted vectors.

Vectors become integers.  All vectors are range-sorted by descending length
and packed into blocks; queries are packed into blocks too.  The longest
vectors give every query a first threshold, its k-th best score so far.  By
Cauchy-Schwarz no vector shorter than threshold / query length can pass it,
so a query block meets only a prefix of the blocks.  Inside a pair of blocks,
partial sums over the leading SVD-rotated coordinates plus the product of the
residual lengths bound each score from above; survivors are scored exactly.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsentinel.llm.common import stored
from logsentinel.llm.vectors import Best, integer_rows, products

SCALE = 1024
K = 10
EVERY = 100
#: Vectors and queries in a block.
ROWS = 2048
QUERIES = 512
#: Numbers in the bounded sample that fits the rotation, and in the head that
#: gives the first thresholds.
SAMPLE = 1 << 20
HEAD = 1 << 18
#: Leading rotated coordinates, as a share of all.
LEADING = 0.25
#: Blocks of queries whose best a task holds at once.
OPEN = 8


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v array<long>, length)`` of the vectors that take part (see
    `vectors.integer_rows`); rows that repeat a ``vec_id`` all do."""
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return integer_rows(vectors, scale).withColumn("length", F.sqrt(square))


def _matrix(rows: list, dim: int) -> np.ndarray:
    """Integer rows, shorter ones filled with zeros."""
    out = np.zeros((len(rows), dim), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _kth(scores: np.ndarray, k: int) -> float:
    return float(np.partition(scores, -k)[-k]) if len(scores) >= k else -np.inf


_BLOCK = "part long, block long, n int, longest double, ids binary, rows binary"
_QUERY = "qblock long, n int, ids binary, rows binary, floors binary, reach double"


def _pack(size: int, dim: int, last: Column | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, ids, rows, longest = TaskContext.get().partitionId(), count(), [], [], []

        def block() -> pa.RecordBatch:
            values = [[part], [part << 32 | next(number)], [len(ids)], [max(longest)], [np.array(ids, np.int64).tobytes()], [_matrix(rows, dim).tobytes()]]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.binary(), pa.binary()]
            out = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], ["part", "block", "n", "longest", "ids", "rows"])
            ids.clear(), rows.clear(), longest.clear()
            return out

        for b in batches:
            for i, v, length in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                ids.append(i)
                rows.append(v)
                longest.append(length)
                if len(ids) == size:
                    yield block()
        if ids:
            yield block()

    return run


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """``embeddings`` → ``(query_id, rank, vec_id, score)``: for each row
    whose ``vec_id`` is divisible by ``every``, the k largest integer inner
    products with the other rows, ties to the smaller ``vec_id``.

    See `integer_vectors` for the rows that take part.  Every row counts,
    also where a ``vec_id`` is repeated: as a candidate of every query of
    another id, and as a query, the queries of one id giving one list (in
    which a row found by two of them stands twice).  Vectors of different
    length are compared as if the shorter one went on with zeros; vectors
    without components score 0.  Scores beyond a long stop at its limits.
    Fewer rows than k give all; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    clean = stored(integer_vectors(vectors, scale), "vectors")
    seen = clean.agg(F.max(F.size("v"))).first()[0]
    none = "query_id long, rank int, vec_id long, score long"
    if seen is None:
        return spark.createDataFrame([], none)
    dim = max(seen, 1)

    # Bounded inputs of the bounds: a sample for the rotation (it changes
    # speed, never results) and the longest vectors.
    sample = clean.orderBy(F.xxhash64("vec_id")).limit(max(dim, SAMPLE // dim)).select("v").collect()
    x = _matrix([r.v for r in sample], dim).astype(np.float64)
    rotation = np.linalg.svd(x.T @ x)[0]
    lead = max(1, int(dim * LEADING))
    head = clean.orderBy(F.desc("length"), "vec_id").limit(max(k + 1, HEAD // dim)).select("vec_id", "v").collect()
    head_ids, head_rows = np.array([r.vec_id for r in head], np.int64), _matrix([r.v for r in head], dim)

    order = [F.desc("length"), F.col("vec_id")]
    sorted_rows = clean.repartitionByRange(*order).sortWithinPartitions(*order)
    packed = stored(sorted_rows.mapInArrow(_pack(ROWS, dim), _BLOCK), "blocks")
    # The longest vector of every range.
    ranges = packed.groupBy("part").agg(F.max("longest").alias("top"))
    last = ranges.agg(F.max("part")).first()[0]

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k-th best score of each query among the longest vectors, and
        the length below which no vector can pass any of them."""
        for b in batches:
            out = []
            for block, n, ids, rows in zip(*(b.column(i).to_pylist() for i in (1, 2, 4, 5))):
                own, q = np.frombuffer(ids, np.int64), np.frombuffer(rows, np.int64).reshape(n, dim)
                low = np.empty(n)
                for i, s in enumerate(products(q, head_rows)):
                    low[i] = _kth(s[head_ids != own[i]], k)
                length = np.sqrt((q.astype(np.float64) ** 2).sum(1))
                need = np.where(length > 0, low / np.maximum(length, 1e-300), np.where(low <= 0, -np.inf, np.inf))
                out.append((block, n, ids, rows, low.tobytes(), float(need.min())))
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.float64()]
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["qblock", "n", "ids", "rows", "floors", "reach"])

    asked = clean.filter(F.col("vec_id") % every == 0)
    queries = stored(asked.mapInArrow(_pack(QUERIES, dim), _BLOCK).mapInArrow(floors, _QUERY), "queries")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k best of each query among the blocks that this task meets;
        what it has found raises the thresholds for the blocks to come."""
        held: OrderedDict[int, tuple[np.ndarray, np.ndarray, Best]] = OrderedDict()

        def emit(own: np.ndarray, low: np.ndarray, best: Best) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (own[best.group], best.id, best.score)], ["query_id", "vec_id", "score"])

        for b in batches:
            for block, qn, qi, qr, ql, cn, ci, cr in zip(*(c.to_pylist() for c in b.columns)):
                if block not in held:
                    if len(held) == OPEN:
                        yield emit(*held.popitem(last=False)[1])
                    held[block] = (np.frombuffer(qi, np.int64), np.frombuffer(ql, np.float64), Best(qn, k))
                own, first, best = held[block]
                others = np.frombuffer(ci, np.int64)
                q, c = np.frombuffer(qr, np.int64).reshape(qn, dim), np.frombuffer(cr, np.int64).reshape(cn, dim)
                low = np.maximum(first, best.floor)
                alive = _alive(q, c, low, rotation, lead)
                rows, cols = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
                if not len(rows):
                    continue
                scores = products(q[rows], c[cols])
                at, other = np.nonzero((scores >= first[rows][:, None]) & (own[rows][:, None] != others[cols]))
                best.add(rows[at], scores[at, other].astype(np.int64), others[cols[other]])
        for kept in held.values():
            yield emit(*kept)

    # A block of queries meets the ranges whose longest vector it can reach,
    # and in them the blocks.
    slim = queries.select("qblock", "reach", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))).alias("part"))
    reached = slim.join(ranges, "part").filter(F.col("top") * (1 + 1e-9) >= F.col("reach")).select("qblock", "part")
    wanted = reached.join(queries, "qblock").select(
        "qblock", "part", F.col("n").alias("qn"), F.col("ids").alias("qids"), F.col("rows").alias("qrows"), "floors", "reach"
    )
    met = wanted.join(packed, "part").filter(F.col("longest") * (1 + 1e-9) >= F.col("reach"))
    found = met.select("qblock", "qn", "qids", "qrows", "floors", "n", "ids", "rows").mapInArrow(pairs, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _alive(q: np.ndarray, c: np.ndarray, low: np.ndarray, rotation: np.ndarray, lead: int) -> np.ndarray:
    """Pairs whose upper bound reaches the query's threshold."""
    qr, cr = q.astype(np.float64) @ rotation, c.astype(np.float64) @ rotation
    q_rest, c_rest = np.sqrt((qr[:, lead:] ** 2).sum(1)), np.sqrt((cr[:, lead:] ** 2).sum(1))
    q_all, c_all = np.sqrt((qr**2).sum(1)), np.sqrt((cr**2).sum(1))
    with np.errstate(over="ignore", invalid="ignore"):
        bound = qr[:, :lead] @ cr[:, :lead].T + q_rest[:, None] * c_rest[None, :]
        slack = 1e-9 * q_all[:, None] * c_all[None, :] + 1e-6
        return ~(bound + slack < low[:, None])
