"""Batch-layer detections (B1–B4) over a LOG table.

Each is one scan with a partial (map-side) aggregate before its shuffle, so a
source IP holding a large share of the rows is combined inside each task and
never lands on one reducer as raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsentinel import rules
from logsentinel.functions.expressions import fold


def in_period(
    logs: DataFrame, start: str | None = None, end: str | None = None, time_col: str = "timestamp", date_col: str = "log_date"
) -> DataFrame:
    """The rows with ``start <= time < end`` (either may be left out), for any
    of the batch detectors.  Where the table is laid out by date, the bounds
    also go to the date column, so other days are not read."""
    for bound, below in ((start, False), (end, True)):
        if bound is not None:
            at = F.lit(bound).cast(dict(logs.dtypes)[time_col])
            logs = logs.filter(F.col(time_col) < at if below else F.col(time_col) >= at)
            if date_col in logs.columns:
                day = F.lit(bound[:10]).cast("date")
                logs = logs.filter(F.col(date_col) <= day if below else F.col(date_col) >= day)
    return logs


def top_malicious_ips(logs: DataFrame, n: int = 10, fold_case: bool = True) -> DataFrame:
    """B1: the ``n`` source IPs with most malicious/suspicious events.

    Ties on ``threat_count`` are broken by ``source_ip`` so the cut at rank
    ``n`` is deterministic.  ``orderBy + limit`` plans as a top-k
    (``TakeOrderedAndProject``): each task keeps ``n`` rows, nothing is
    globally sorted.
    """
    lab = fold("threat_label", fold_case)
    return (
        logs.filter(lab.isin(rules.MALICIOUS, rules.SUSPICIOUS))
        .groupBy("source_ip")
        .agg(
            F.count(F.lit(1)).alias("threat_count"),
            F.count_if(lab == rules.MALICIOUS).alias("malicious_count"),
            F.count_if(lab == rules.SUSPICIOUS).alias("suspicious_count"),
            F.sum("bytes_transferred").alias("total_bytes"),
        )
        .orderBy(F.desc("threat_count"), F.asc("source_ip"))
        .limit(n)
    )


def port_scan(
    logs: DataFrame,
    window: str = "5 minutes",
    min_targets: int = 20,
    protocol: str = "TCP",
    time_col: str = "event_ts",
    order: bool = False,
) -> DataFrame:
    """B2: per source IP and tumbling window, distinct destinations and
    connections; keep windows with strictly more than ``min_targets``
    destinations.

    The protocol filter is an equality on a raw column, so it is pushed into
    the Parquet scan.  ``countDistinct`` plans as a two-level aggregate: the
    first shuffle is keyed by (ip, window, dest_ip), which spreads one busy
    scanner over many tasks.
    """
    out = (
        logs.filter(F.col("protocol") == protocol)
        .groupBy("source_ip", F.window(time_col, window).alias("window"))
        .agg(
            F.countDistinct("dest_ip").alias("distinct_targets"),
            F.count(F.lit(1)).alias("connection_count"),
        )
        .filter(F.col("distinct_targets") > min_targets)
        .select(
            "source_ip",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "distinct_targets",
            "connection_count",
        )
    )
    return out.orderBy(F.desc("distinct_targets"), "source_ip", "window_start") if order else out


def port_scan_final(
    logs: DataFrame, window: str = "5 minutes", min_targets: int = 20, protocol: str = "TCP", time_col: str = "event_ts"
) -> DataFrame:
    """B2 for a stream, where a distinct count is refused: exact, by two
    chained aggregates.  The first keeps one row per address, window and
    target (with its connections), which also takes the repeats out; the
    second counts them when the watermark has closed the window.  In append
    mode every scan comes once, and both states are evicted.  On a table it
    gives the rows of `port_scan`.

    The first state is keyed by target as well, so a scanner of many targets
    is spread over the state partitions, and the second holds one short row
    per address and window."""
    targets = (
        logs.filter(F.col("protocol") == protocol)
        .groupBy(F.window(time_col, window).alias("w"), "source_ip", "dest_ip")
        .agg(F.count(F.lit(1)).alias("connections"))
    )
    return (
        targets.groupBy("source_ip", F.window(F.window_time("w"), window).alias("window"))
        .agg(F.count("dest_ip").alias("distinct_targets"), F.sum("connections").alias("connection_count"))
        .filter(F.col("distinct_targets") > min_targets)
        .select(
            "source_ip", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
            "distinct_targets", "connection_count",
        )
    )


def sqli_xss_totals(
    logs: DataFrame,
    sqli_pattern: str = rules.BATCH_SQLI_PATTERN,
    xss_pattern: str = rules.BATCH_XSS_PATTERN,
) -> DataFrame:
    """Total SQLi and XSS rows, always exactly two rows.

    One scan and one global aggregate (both counts together) instead of two
    filtered counts; a row matching both families counts in both totals.
    """
    path = F.lower(F.col("request_path"))
    totals = logs.agg(
        F.count_if(path.rlike(sqli_pattern)).alias("sqli"),
        F.count_if(path.rlike(xss_pattern)).alias("xss"),
    )
    return totals.select(
        F.expr(f"stack(2, '{rules.SQLI}', sqli, '{rules.XSS}', xss) AS (attack_type, count)")
    ).orderBy(F.desc("count"), "attack_type")


def sqli_events(logs: DataFrame, pattern: str = rules.BATCH_SQLI_PATTERN) -> DataFrame:
    """Rows whose lower-cased path matches the batch SQLi rule."""
    return logs.filter(F.lower(F.col("request_path")).rlike(pattern)).withColumn(
        "attack_type", F.lit(rules.SQLI)
    )


def xss_events(logs: DataFrame, pattern: str = rules.BATCH_XSS_PATTERN) -> DataFrame:
    """Rows whose lower-cased path matches the batch XSS rule."""
    return logs.filter(F.lower(F.col("request_path")).rlike(pattern)).withColumn(
        "attack_type", F.lit(rules.XSS)
    )


def bytes_by_threat_label(logs: DataFrame, fold_case: bool = True) -> DataFrame:
    """Bytes statistics per (case-folded) threat label; a null label is
    its own group.  The output has one row per label, so the final sort is
    over a handful of rows."""
    return (
        logs.groupBy(fold("threat_label", fold_case).alias("threat_label"))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.sum("bytes_transferred").alias("total_bytes"),
            F.avg("bytes_transferred").alias("avg_bytes"),
            F.min("bytes_transferred").alias("min_bytes"),
            F.max("bytes_transferred").alias("max_bytes"),
        )
        .orderBy(F.desc("total_bytes"), "threat_label")
    )


# ---------------------------------------------------------------------------
# B1 + B3 + B4 in one pass, for when the batch layer produces all results
# ---------------------------------------------------------------------------

BY_LABEL, BY_IP, TOTAL = 1, 2, 3  # grouping_id() of the three grouping sets


def batch_summary(
    logs: DataFrame,
    fold_case: bool = True,
    sqli_pattern: str = rules.BATCH_SQLI_PATTERN,
    xss_pattern: str = rules.BATCH_XSS_PATTERN,
) -> DataFrame:
    """One scan and one shuffle for B1, B3 and B4: an aggregate over the
    grouping sets (label), (source_ip) and () carrying every statistic the
    three need.  The path patterns are evaluated once per row, before the
    grouping-set expansion.  The result has one row per label, per source IP
    and one total row (``grouping`` tells them apart); derive the results
    from it with the ``*_from_summary`` functions after writing it once."""
    lab = fold("threat_label", fold_case)
    path = F.lower(F.col("request_path"))
    prepared = logs.select(
        lab.alias("threat_label"),
        "source_ip",
        "bytes_transferred",
        path.rlike(sqli_pattern).alias("_sqli"),
        path.rlike(xss_pattern).alias("_xss"),
    )
    label = F.col("threat_label")
    threat = label.isin(rules.MALICIOUS, rules.SUSPICIOUS)
    return prepared.groupingSets(
        [["threat_label"], ["source_ip"], []], "threat_label", "source_ip"
    ).agg(
        F.grouping_id().alias("grouping"),
        F.count(F.lit(1)).alias("event_count"),
        F.sum("bytes_transferred").alias("total_bytes"),
        F.avg("bytes_transferred").alias("avg_bytes"),
        F.min("bytes_transferred").alias("min_bytes"),
        F.max("bytes_transferred").alias("max_bytes"),
        F.count_if(threat).alias("threat_count"),
        F.count_if(label == rules.MALICIOUS).alias("malicious_count"),
        F.count_if(label == rules.SUSPICIOUS).alias("suspicious_count"),
        F.sum(F.when(threat, F.col("bytes_transferred"))).alias("threat_bytes"),
        F.count_if(F.col("_sqli")).alias("sqli"),
        F.count_if(F.col("_xss")).alias("xss"),
    )


def top_malicious_ips_from_summary(summary: DataFrame, n: int = 10) -> DataFrame:
    """B1 from ``batch_summary``: same rows as ``top_malicious_ips``."""
    return (
        summary.filter((F.col("grouping") == BY_IP) & (F.col("threat_count") > 0))
        .select(
            "source_ip",
            "threat_count",
            "malicious_count",
            "suspicious_count",
            F.col("threat_bytes").alias("total_bytes"),
        )
        .orderBy(F.desc("threat_count"), F.asc("source_ip"))
        .limit(n)
    )


def sqli_xss_totals_from_summary(summary: DataFrame) -> DataFrame:
    """B3 from ``batch_summary``: always two rows (zeros on empty input,
    where a grouped aggregate has no total row)."""
    total = summary.filter(F.col("grouping") == TOTAL).agg(
        F.coalesce(F.sum("sqli"), F.lit(0)).cast("bigint").alias("sqli"),
        F.coalesce(F.sum("xss"), F.lit(0)).cast("bigint").alias("xss"),
    )
    return total.select(
        F.expr(f"stack(2, '{rules.SQLI}', sqli, '{rules.XSS}', xss) AS (attack_type, count)")
    ).orderBy(F.desc("count"), "attack_type")


def bytes_by_threat_label_from_summary(summary: DataFrame) -> DataFrame:
    """B4 from ``batch_summary``: same rows as ``bytes_by_threat_label``."""
    return (
        summary.filter(F.col("grouping") == BY_LABEL)
        .select("threat_label", "event_count", "total_bytes", "avg_bytes", "min_bytes", "max_bytes")
        .orderBy(F.desc("total_bytes"), "threat_label")
    )
