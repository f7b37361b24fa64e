"""Connected components of an edge table, as Spark jobs.

Alternating large-star and small-star rounds: each round is a grouped minimum
(combined map-side) and one join; edges always point from a node to a smaller
one, and a node of high degree never sees its neighbours in one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsentinel.llm.common import remove, stored_at


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.filter("v > u").join(low, "u").filter("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    # Edges point down (u > v) here: the smaller neighbours of u are its v.
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return low.select("u", F.col("m").alias("v")).unionByName(moved).distinct()


def _sign(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """``(u long, v long)`` links → ``(node, component)``, the smallest node
    reachable; nodes without a link to another node do not appear.

    Self links, repeated links and null ends are ignored; no links give no
    rows.  Each round is written to the shared folder.  The number of rounds
    is logarithmic in the size of the largest component.
    """
    down = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, path = stored_at(down, "edges")
    before, sign = None, _sign(now)
    while sign != before and sign[0]:
        now, new_path = stored_at(_small_star(_large_star(now)), "edges")
        remove(edges.sparkSession, path)
        path = new_path
        before, sign = sign, _sign(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
