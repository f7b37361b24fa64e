"""Stored rollups of the batch layer.

A rollup holds, per period (a day unless told otherwise), the statistics of
`batch.batch_summary` in a form that can be merged: sums and counts in place
of averages.  Any span of time is then answered from the rows of the whole
periods inside it and, where it begins or ends within a period, from the log
of those edges alone; the log of closed periods is not read again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsentinel import rules
from logsentinel.functions.expressions import fold
from logsentinel.operators.batch import in_period

DAY = 24 * 3600
_KEYS = ("grouping", "threat_label", "source_ip")
_SUMS = ("event_count", "bytes_count", "total_bytes", "threat_count", "malicious_count", "suspicious_count", "threat_bytes", "sqli", "xss")


def period_sums(
    logs: DataFrame, seconds: int = DAY, time_col: str = "timestamp", fold_case: bool = True,
    sqli_pattern: str = rules.BATCH_SQLI_PATTERN, xss_pattern: str = rules.BATCH_XSS_PATTERN,
) -> DataFrame:
    """One scan and one shuffle: per period, one row for every label, for
    every source address and for the whole.  Rows without a time belong to no
    period, as they belong to no span."""
    path = F.lower(F.col("request_path"))
    prepared = logs.select(
        F.window(time_col, f"{seconds} seconds")["start"].alias("period"), fold("threat_label", fold_case).alias("threat_label"), "source_ip",
        "bytes_transferred", path.rlike(sqli_pattern).alias("_sqli"), path.rlike(xss_pattern).alias("_xss"),
    )
    label, size = F.col("threat_label"), F.col("bytes_transferred")
    threat = label.isin(rules.MALICIOUS, rules.SUSPICIOUS)
    return prepared.groupingSets(
        [["period", "threat_label"], ["period", "source_ip"], ["period"]], "period", "threat_label", "source_ip"
    ).agg(
        F.grouping_id().alias("grouping"),
        F.count(F.lit(1)).alias("event_count"), F.count(size).alias("bytes_count"), F.sum(size).alias("total_bytes"),
        F.min(size).alias("min_bytes"), F.max(size).alias("max_bytes"),
        F.count_if(threat).alias("threat_count"), F.count_if(label == rules.MALICIOUS).alias("malicious_count"),
        F.count_if(label == rules.SUSPICIOUS).alias("suspicious_count"), F.sum(F.when(threat, size)).alias("threat_bytes"),
        F.count_if("_sqli").alias("sqli"), F.count_if("_xss").alias("xss"),
    )


def merged(sums: DataFrame) -> DataFrame:
    """Sums of any periods → the columns of `batch.batch_summary`, for its
    ``*_from_summary`` functions."""
    whole = sums.groupBy(*_KEYS).agg(
        *[F.sum(c).alias(c) for c in _SUMS], F.min("min_bytes").alias("min_bytes"), F.max("max_bytes").alias("max_bytes")
    )
    return whole.withColumn("avg_bytes", F.try_divide(F.col("total_bytes").cast("double"), F.col("bytes_count")))


def _floor(text: str, seconds: int) -> dt.datetime:
    at, zero = dt.datetime.fromisoformat(text), dt.datetime(1970, 1, 1)
    return zero + dt.timedelta(seconds=(at - zero) // dt.timedelta(seconds=seconds) * seconds)


def _span(start: str, end: str, seconds: int) -> tuple[dt.datetime, dt.datetime]:
    """First and end of the whole periods inside a span."""
    first, last = _floor(start, seconds), _floor(end, seconds)
    return first if first == dt.datetime.fromisoformat(start) else first + dt.timedelta(seconds=seconds), last


def extend(spark: SparkSession, logs: DataFrame, path: str, until: str, seconds: int = DAY, time_col: str = "timestamp") -> None:
    """Add the closed periods before ``until`` that the stored rollup lacks:
    those after its last one (all, at first).  Every period is a folder of its
    own that a repeated run replaces, so an interrupted run is run again.  A
    rollup has one length of period, and takes a period's rows when it is
    closed; rows that come later are not in it."""
    end = _floor(until, seconds)
    try:
        last = spark.read.parquet(path).agg(F.max("period")).first()[0]
    except AnalysisException:  # no rollup yet
        last = None
    start = None if last is None else (last + dt.timedelta(seconds=seconds)).isoformat(sep=" ")
    sums = period_sums(in_period(logs, start, end.isoformat(sep=" "), time_col), seconds, time_col)
    (
        sums.withColumn("at", F.date_format("period", "yyyyMMdd-HHmmss")).hint("rebalance", "at")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("at").parquet(path)
    )


def span_summary(
    rollup: DataFrame, logs: DataFrame | None, start: str, end: str, seconds: int = DAY, time_col: str = "timestamp"
) -> DataFrame:
    """The summary of ``start <= time < end`` from a stored rollup that holds
    the whole periods inside; the edges, if any, come from ``logs``."""
    first, last = _span(start, end, seconds)
    text = lambda t: t.isoformat(sep=" ")
    folder = F.date_format(F.lit(text(first)).cast("timestamp_ntz"), "yyyyMMdd-HHmmss")
    folder_end = F.date_format(F.lit(text(last)).cast("timestamp_ntz"), "yyyyMMdd-HHmmss")
    parts = [rollup.filter((F.col("at") >= folder) & (F.col("at") < folder_end)).drop("at", "period")]
    edges = [(start, min(text(first), end)), (max(text(last), start), end)] if first <= last else [(start, end)]
    for a, b in edges:
        if dt.datetime.fromisoformat(a) < dt.datetime.fromisoformat(b):
            if logs is None:
                raise ValueError(f"{a} to {b} is not a whole period: the log is needed")
            parts.append(period_sums(in_period(logs, a, b, time_col), seconds, time_col).drop("period"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return merged(out)
