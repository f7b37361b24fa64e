"""Serving queries (V1–V14) over the stored result tables and alert table.

Each HTTP route of the original query layer becomes a function of
DataFrames.  Whole-table statistics (min/max of a table, KPI values) are
scalar subqueries (``DataFrame.scalar()``): one global aggregate each, no
cross join and no driver round trip.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsentinel import rules
from logsentinel.functions.expressions import reputation_score, threat_level
from logsentinel.schema import ALERT_COLUMNS
from logsentinel.sources import readers


# ---------------------------------------------------------------------------
# Batch-layer routes
# ---------------------------------------------------------------------------


def ip_reputation(top: DataFrame) -> DataFrame:
    """V1 + V2: reputation score and threat level for every TOP_IP row.

    min/max of ``threat_count`` over the whole table are one struct-valued
    scalar subquery, projected once as a column so that the score
    expression reads its fields instead of re-running the subquery."""
    stats = top.select(
        F.struct(F.min("threat_count").alias("lo"), F.max("threat_count").alias("hi"))
    ).scalar()
    scored = (
        top.withColumn("_stats", stats)
        .withColumn(
            "reputation_score",
            reputation_score("threat_count", "malicious_count", "_stats.lo", "_stats.hi"),
        )
        .drop("_stats")
    )
    return scored.withColumn("threat_level", threat_level("reputation_score"))


def threats_top(top: DataFrame) -> DataFrame:
    """V4: the top-threats list (``ip`` renamed, score and level)."""
    rep = ip_reputation(top)
    return rep.select(
        F.col("source_ip").alias("ip"),
        "threat_count",
        "malicious_count",
        "suspicious_count",
        "total_bytes",
        F.col("reputation_score").alias("score"),
        "threat_level",
    ).orderBy(F.desc("score"), F.asc("ip"))


def ip_lookup(
    requested: DataFrame,
    top: DataFrame,
    alerts: DataFrame | None = None,
    ip_col: str = "ip",
) -> DataFrame:
    """V3: look up many IPs at once.

    Found IPs get their TOP_IP counts, score, level and action (``BLOCK`` at
    score >= 75, else ``MONITOR``); the rest are ``clean``.  The speed-layer
    part is the number of current alerts and their highest score.  The alert
    table is first cut to the requested IPs by a left-semi join, so its
    latest emissions and counts are worked out for those only; alerts without
    a ``batch_id`` are taken as current already.  How each join runs is left
    to the planner's size limits and to adaptive execution.
    """
    rep = ip_reputation(top).select(
        F.col("source_ip").alias(ip_col),
        "threat_count",
        "malicious_count",
        "suspicious_count",
        "total_bytes",
        "reputation_score",
        "threat_level",
    )
    out = requested.select(ip_col).join(rep, ip_col, "left")
    found = F.col("reputation_score").isNotNull()
    out = out.select(
        "*",
        F.when(found, F.lit("threat")).otherwise(F.lit("clean")).alias("status"),
        F.when(found, F.when(F.col("reputation_score") >= rules.BLOCK_AT_SCORE, F.lit("BLOCK"))
               .otherwise(F.lit("MONITOR"))).alias("action"),
    )
    if alerts is not None:
        asked = requested.select(F.col(ip_col).alias("source_ip"))
        theirs = alerts.join(asked, "source_ip", "left_semi")
        per_ip = (current_alerts(theirs) if "batch_id" in alerts.columns else theirs).groupBy(F.col("source_ip").alias(ip_col)).agg(
            F.count(F.lit(1)).alias("active_alerts"),
            F.max("threat_score").alias("max_alert_score"),
        )
        out = out.join(per_ip, ip_col, "left").withColumn(
            "active_alerts", F.coalesce(F.col("active_alerts"), F.lit(0).cast("bigint"))
        )
    return out


def threats_port_scans(port_scans: DataFrame) -> DataFrame:
    """V5: port-scan list with ``ip`` and window bounds as text."""
    fmt = "yyyy-MM-dd HH:mm:ss"
    return port_scans.select(
        F.col("source_ip").alias("ip"),
        F.date_format("window_start", fmt).alias("window_start"),
        F.date_format("window_end", fmt).alias("window_end"),
        "distinct_targets",
        "connection_count",
    )


def threats_bytes(bytes_tbl: DataFrame) -> DataFrame:
    """V6: bytes list with the average rounded to 2 places (HALF_UP)."""
    return bytes_tbl.select(
        "threat_label",
        "event_count",
        "total_bytes",
        F.round("avg_bytes", 2).alias("avg_bytes"),
        "min_bytes",
        "max_bytes",
    )


def threats_sqli_xss(totals: DataFrame) -> DataFrame:
    """SQLi/XSS totals list."""
    return totals.select("attack_type", "count")


# ---------------------------------------------------------------------------
# Speed-layer routes over the alert table
# ---------------------------------------------------------------------------


def current_alerts(
    alerts: DataFrame, key: tuple[str, ...] = ("source_ip", "window_start", "alert_type")
) -> DataFrame:
    """The latest emission per alert key: of the latest run (where the
    alerts have one; a null run is the oldest), of its latest batch, and of
    equals one fixed by the row's hash.

    Update mode re-emits a growing window (count 3, later 6); summing all
    emissions over-counts.  A run starts its batches at 0 again, so the run
    comes before the batch.  ``max_by`` is a partial aggregate, so a key
    emitted in many batches is combined map-side.
    """
    order = [c for c in ("run", "batch_id") if c in alerts.columns]
    rest = [c for c in alerts.columns if c not in key and c not in order]
    latest = alerts.groupBy(*key).agg(
        F.max_by(F.struct(*order, *rest), F.struct(*order, F.xxhash64(*rest))).alias("latest")
    )
    return latest.select(*key, "latest.*").select(*alerts.columns)


def alert_feed(
    alerts: DataFrame, as_of: Column | str | None = None, lookback: str = "24 hours"
) -> DataFrame:
    """V7: all alerts, missing score = 0, highest score first, then by IP,
    window and type (whole groups share a score: the further keys spread them
    over the sort's partitions and fix the order).  With
    ``as_of`` only alerts whose window ended within ``lookback`` of it."""
    out = alerts.select(*ALERT_COLUMNS).withColumn(
        "threat_score", F.coalesce(F.col("threat_score"), F.lit(0).cast("bigint"))
    )
    if as_of is not None:
        ref = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
        out = out.filter(
            F.try_to_timestamp(F.col("window_end")) >= ref - F.expr(f"INTERVAL {lookback}")
        )
    return out.orderBy(F.desc("threat_score"), "source_ip", "window_start", "alert_type")


def _distinct_with_null(col: str) -> Column:
    """Distinct values counting a null as one value (like a Python set)."""
    return F.countDistinct(col) + F.max(F.col(col).isNull().cast("int")).cast("bigint")


def alert_summary(alerts: DataFrame) -> DataFrame:
    """V8: total alerts and distinct source IPs (one row)."""
    return alerts.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(_distinct_with_null("source_ip"), F.lit(0).cast("bigint")).alias("unique_ips"),
    )


def alert_counts_by_type(alerts: DataFrame) -> DataFrame:
    """V8: alerts per type, a missing type reported as UNKNOWN."""
    return alerts.groupBy(
        F.coalesce(F.col("alert_type"), F.lit("UNKNOWN")).alias("alert_type")
    ).agg(F.count(F.lit(1)).alias("count"))


def alert_stats(alerts: DataFrame) -> DataFrame:
    """V9: one row of speed-layer counters and the top attacker (IP of the
    highest-scored alert; ties go to the smallest IP)."""
    at = F.col("alert_type")
    score = F.coalesce(F.col("threat_score"), F.lit(0).cast("bigint"))
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(at == rules.BRUTE_FORCE).alias("brute_force_count"),
        F.count_if(at.isin(rules.SQLI, rules.XSS)).alias("sqli_xss_count"),
        F.count_if(at == rules.VOLUME_ANOMALY).alias("volume_anomaly_count"),
        F.count_if(F.col("severity") == rules.CRITICAL).alias("critical_count"),
        F.coalesce(_distinct_with_null("source_ip"), F.lit(0).cast("bigint")).alias(
            "unique_attacker_ips"
        ),
        F.min_by("source_ip", F.struct(-score, F.col("source_ip"))).alias("top_attacker"),
    )


# ---------------------------------------------------------------------------
# KPIs, availability, dashboard panels
# ---------------------------------------------------------------------------


def _one_row(base: DataFrame | None) -> DataFrame:
    """Exactly one row to hang scalar subqueries on: a global aggregate of
    one of the inputs (one row even when that table is empty)."""
    if base is None:
        raise ValueError("at least one input table is required")
    return base.agg(F.count(F.lit(1)).alias("_rows"))


def _table_stats(df: DataFrame | None, aggs: dict[str, Column]) -> Column:
    """All statistics needed from one table as one struct-valued scalar
    subquery (a missing table gives nulls)."""
    if df is None:
        return F.struct(*[F.lit(None).cast("bigint").alias(k) for k in aggs])
    return df.select(F.struct(*[a.alias(k) for k, a in aggs.items()])).scalar()


def _zero(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(0).cast("bigint"))


def _attack_aggs() -> dict[str, Column]:
    return {
        t: F.sum(F.when(F.col("attack_type") == t, F.col("count")))
        for t in (rules.SQLI, rules.XSS)
    }


def _label_aggs() -> dict[str, Column]:
    return {
        lab: F.sum(F.when(F.col("threat_label") == lab, F.col("event_count")))
        for lab in (rules.MALICIOUS, rules.SUSPICIOUS, rules.BENIGN)
    }


def threat_kpis(
    totals: DataFrame | None, bytes_tbl: DataFrame | None, top: DataFrame | None
) -> DataFrame:
    """One flat row of scalar KPIs; a missing table reads as 0.  One
    scalar subquery per table, each projected once."""
    base = next((d for d in (totals, bytes_tbl, top) if d is not None), None)
    stats = _one_row(base).select(
        _table_stats(totals, _attack_aggs()).alias("_t"),
        _table_stats(bytes_tbl, _label_aggs()).alias("_b"),
        _table_stats(top, {"n": F.count(F.lit(1))}).alias("_top"),
    )
    return stats.select(
        _zero(f"_t.{rules.SQLI}").alias("sqli_count"),
        _zero(f"_t.{rules.XSS}").alias("xss_count"),
        _zero(f"_b.{rules.MALICIOUS}").alias("malicious_events"),
        _zero(f"_b.{rules.SUSPICIOUS}").alias("suspicious_events"),
        _zero(f"_b.{rules.BENIGN}").alias("benign_events"),
        _zero("_top.n").alias("top_ip_count"),
    )


def result_table_stats(spark: SparkSession, tables: Mapping[str, str], alert_dir: str | None = None) -> DataFrame:
    """Per result table, whether it is present, its row count (0 when
    missing) and the error text (null when present).  Counting is a distributed aggregate per table."""
    parts = []
    for name, path in tables.items():
        parts.append(_availability(spark, name, *readers.read_result_table(spark, path)))
    if alert_dir is not None:
        alerts, error = None, None
        try:
            alerts = readers.read_alerts(spark, alert_dir, missing_ok=False)
        except AnalysisException as exc:
            error = f"missing alert table at {alert_dir}: {exc.getCondition() or exc}"
        parts.append(_availability(spark, "brute_force_alerts", alerts, error))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _availability(spark: SparkSession, name: str, df: DataFrame | None, error: str | None = None) -> DataFrame:
    if df is None:
        return spark.range(1).select(
            F.lit(name).alias("table_name"),
            F.lit(False).alias("available"),
            F.lit(0).cast("bigint").alias("row_count"),
            F.lit(error).cast("string").alias("error"),
        )
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"),
        F.lit(True).alias("available"),
        "row_count",
        F.lit(None).cast("string").alias("error"),
    )


def dashboard_panels(
    top: DataFrame | None,
    totals: DataFrame | None,
    bytes_tbl: DataFrame | None,
    alerts: DataFrame | None,
) -> DataFrame:
    """The stat-panel expressions as one row: ``$count`` of the top
    list, ``$sum(count)`` of SQLi/XSS, events by label, and the summed alert
    ``count`` overall and per alert type.  One scalar subquery per table."""
    base = next((d for d in (totals, bytes_tbl, top, alerts) if d is not None), None)
    at = F.col("alert_type")
    alert_aggs = {
        "total": F.sum("count"),
        rules.BRUTE_FORCE: F.sum(F.when(at == rules.BRUTE_FORCE, F.col("count"))),
        rules.XSS: F.sum(F.when(at == rules.XSS, F.col("count"))),
        rules.SQLI: F.sum(F.when(at == rules.SQLI, F.col("count"))),
    }
    stats = _one_row(base).select(
        _table_stats(top, {"n": F.count(F.lit(1))}).alias("_top"),
        _table_stats(totals, _attack_aggs()).alias("_t"),
        _table_stats(bytes_tbl, _label_aggs()).alias("_b"),
        _table_stats(alerts, alert_aggs).alias("_a"),
    )
    return stats.select(
        _zero("_top.n").alias("top_ip_count"),
        _zero(f"_t.{rules.SQLI}").alias("sqli_detections"),
        _zero(f"_t.{rules.XSS}").alias("xss_detections"),
        _zero(f"_b.{rules.MALICIOUS}").alias("malicious_events"),
        _zero(f"_b.{rules.BENIGN}").alias("benign_events"),
        _zero(f"_b.{rules.SUSPICIOUS}").alias("suspicious_events"),
        _zero("_a.total").alias("alert_event_total"),
        _zero(f"_a.{rules.BRUTE_FORCE}").alias("brute_force_alert_events"),
        _zero(f"_a.{rules.XSS}").alias("xss_alert_events"),
        _zero(f"_a.{rules.SQLI}").alias("sqli_alert_events"),
    )


def dashboard_bytes_series(bytes_tbl: DataFrame) -> DataFrame:
    """Chart series in the fixed order malicious, suspicious, benign;
    absent labels are skipped; display label has its first letter upper."""
    rank = None
    for i, label in enumerate(rules.LABEL_SERIES_ORDER):
        cond = F.col("threat_label") == label
        rank = F.when(cond, F.lit(i)) if rank is None else rank.when(cond, F.lit(i))
    lab = F.col("threat_label")
    return (
        bytes_tbl.withColumn("series_rank", rank)
        .filter(F.col("series_rank").isNotNull())
        .select(
            "series_rank",
            "threat_label",
            F.concat(F.upper(F.substring(lab, 1, 1)), F.substring(lab, 2, 1 << 20)).alias(
                "display_label"
            ),
            "total_bytes",
            "event_count",
            F.round("avg_bytes", 2).alias("avg_bytes"),
        )
        .orderBy("series_rank")
    )
