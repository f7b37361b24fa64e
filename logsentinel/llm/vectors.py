"""Integer vectors for the operators on embeddings: cleaning, packing, exact
inner products and the k best of many groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsentinel.llm.common import pick

#: Scores stop at the limits of a long (the lower one negates safely).
LEAST, MOST = -(1 << 63) + 1, (1 << 63) - 1


def integer_rows(vectors: DataFrame, scale: int, *others: str) -> DataFrame:
    """``(vec_id long, v array<long>, *others)`` of the rows that take part:
    ``vec_id`` and vector not null, no null or non-finite component.  Each
    component x becomes ``floor(scale * x)`` (x as double); what goes beyond
    2^62 stops there."""
    v = F.col("v")
    bad: Column = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = pick(vectors, "vec_id", "embedding", *others).select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"), *others
    ).filter(F.col("vec_id").isNotNull() & v.isNotNull() & ~bad)
    limit = float(1 << 62)
    whole = F.transform(v, lambda x: F.floor(F.least(F.greatest(x * float(scale), F.lit(-limit)), F.lit(limit))))
    return rows.select("vec_id", whole.alias("v"), *others)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of an Arrow column of integer lists, shorter ones filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if (sizes == dim).all():
        return flat.reshape(len(sizes), dim).astype(np.int64)
    out = np.zeros((len(sizes), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def longest(a: np.ndarray) -> float:
    """The largest length of an integer matrix's rows."""
    return float(np.sqrt((a.astype(np.float64) ** 2).sum(1).max(initial=0)))


def products(a: np.ndarray, b: np.ndarray, most: float | None = None) -> np.ndarray:
    """Exact inner products of all rows of two integer matrices.  By
    Cauchy-Schwarz no partial sum exceeds the product of the largest lengths
    (``most``, if known already), which tells the narrowest number type that
    holds them all; beyond a long they stop at its limits."""
    most = 1.0001 * (longest(a) * longest(b) if most is None else most)
    if most < 2.0**24:
        return a.astype(np.float32) @ b.astype(np.float32).T
    if most < 2.0**53:
        return a.astype(np.float64) @ b.astype(np.float64).T
    if most < 2.0**63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, LEAST, MOST).astype(np.int64)


class Best:
    """The k highest (score, id) of each of many groups, ties to the smaller
    id; what cannot enter is dropped on arrival."""

    def __init__(self, groups: int, k: int) -> None:
        self.k = k
        self.floor = np.full(groups, LEAST, np.int64)
        self.group, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))

    def add(self, group: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        fine = score >= self.floor[group]
        if not fine.any():
            return
        group, score, ident = (np.concatenate(p) for p in (
            (self.group, group[fine]), (self.score, score[fine]), (self.id, ident[fine])
        ))
        order = np.lexsort((ident, -score, group))
        sorted_group = group[order]
        first = np.flatnonzero(np.r_[True, sorted_group[1:] != sorted_group[:-1]])
        place = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
        order, place = order[place < self.k], place[place < self.k]
        self.group, self.score, self.id = group[order], score[order], ident[order]
        full = place == self.k - 1
        self.floor[self.group[full]] = self.score[full]
