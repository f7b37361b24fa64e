"""Speed-layer detections.

Every function is a pure ``(DataFrame, params) → DataFrame``: it reads no
clock unless asked to, never collects, and runs unchanged on a batch table or
on a streaming frame (where the watermark comes from the decoder).  Filters
come before the window so the sliding-window ``Expand`` only sees rows that
can alert.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsentinel import rules
from logsentinel.functions.expressions import (
    attack_type_of,
    event_score,
    fold,
    rlike_any,
    window_bounds,
)
from logsentinel.operators import panes


def _time(time_col: str | Column | None) -> Column:
    """Event-time column, or processing time when ``None``."""
    if time_col is None:
        return F.current_timestamp()
    return F.col(time_col) if isinstance(time_col, str) else time_col


def _alert(
    count: Column,
    target_ip: Column,
    protocol: Column,
    alert_type: Column,
    severity: str,
    threat_score: Column,
) -> list[Column]:
    return [
        F.col("source_ip"),
        *window_bounds("window"),
        count.alias("count"),
        target_ip.alias("target_ip"),
        protocol.alias("protocol"),
        alert_type.alias("alert_type"),
        F.lit(severity).alias("severity"),
        threat_score.cast("bigint").alias("threat_score"),
    ]


def brute_force_sliding(
    logs: DataFrame,
    time_col: str = "event_ts",
    action: str = "failed",
    protocols: tuple[str, ...] = rules.BRUTE_FORCE_PROTOCOLS,
    window: str = "1 minute",
    slide: str = "30 seconds",
    min_count: int = 5,
) -> DataFrame:
    """Failed logins per source IP in sliding windows, ``count >=
    min_count``; score ``count * 10`` (not capped).

    The target and protocol are those of the window's earliest event (ties
    broken by the values themselves), via ``min_by`` instead of the
    order-dependent ``first``.
    """
    t = _time(time_col)
    first = F.min_by(
        F.struct("dest_ip", "protocol"), F.struct(t, F.col("dest_ip"), F.col("protocol"))
    )
    return (
        logs.filter((F.col("action") == action) & F.col("protocol").isin(*protocols))
        .groupBy(F.window(t, window, slide).alias("window"), "source_ip")
        .agg(F.count(F.lit(1)).alias("count"), first.alias("first"))
        .filter(F.col("count") >= min_count)
        .select(
            *_alert(
                F.col("count"),
                F.col("first.dest_ip"),
                F.col("first.protocol"),
                F.lit(rules.BRUTE_FORCE),
                rules.HIGH,
                F.col("count") * rules.BRUTE_FORCE_SCORE_PER_EVENT,
            )
        )
    )


def brute_force_text(
    raw: DataFrame,
    time_col: str | None = None,
    window: str = "1 minute",
    min_count: int = 5,
    text: str = rules.FAILED_LOGIN_TEXT,
    ip_pattern: str = rules.RAW_SOURCE_IP_PATTERN,
    raw_col: str = "raw_log",
) -> DataFrame:
    """Raw text lines containing ``failed login`` (case-folded) per IP
    (taken by regex; no match → '') and tumbling window, ``count >=
    min_count``.  ``time_col=None`` windows on processing time, as the
    original job did; pass an event-time column for reproducible output."""
    return (
        raw.filter(F.lower(F.col(raw_col)).contains(text))
        .withColumn("source_ip", F.regexp_extract(F.col(raw_col), ip_pattern, 1))
        .groupBy(F.window(_time(time_col), window).alias("window"), "source_ip")
        .agg(F.count(F.lit(1)).alias("count"))
        .filter(F.col("count") >= min_count)
        .select(*window_bounds("window"), "source_ip", "count")
    )


def brute_force_tumbling(
    logs: DataFrame,
    time_col: str = "event_ts",
    action: str = "blocked",
    window: str = "1 minute",
    more_than: int = 5,
    detected_at: Column | None = None,
) -> DataFrame:
    """D3: blocked actions per IP and tumbling minute, ``count > more_than``
    (strict).  ``detected_at`` defaults to the current time."""
    return (
        logs.filter(F.col("action") == action)
        .groupBy("source_ip", F.window(_time(time_col), window).alias("window"))
        .agg(F.count(F.lit(1)).alias("count"))
        .filter(F.col("count") > more_than)
        .select(
            "source_ip",
            *window_bounds("window", as_text=False),
            F.col("count").alias("failed_attempts"),
            F.lit(rules.BRUTE_FORCE).alias("threat_type"),
            (detected_at if detected_at is not None else F.current_timestamp()).alias(
                "detected_at"
            ),
        )
    )


def attack_tagging(
    logs: DataFrame,
    sqli_pattern: str = rules.STREAM_SQLI_PATTERN,
    xss_pattern: str = rules.STREAM_XSS_PATTERN,
    columns: tuple[str, ...] = ("request_path", "user_agent"),
) -> DataFrame:
    """Row-level SQLi/XSS flags over path OR agent, flagged rows only.

    Flags follow SQL three-valued logic: a null path with a non-matching
    agent gives a null flag; the row is kept when either flag is true.
    Catalyst pushes the filter below the flag projection, so the patterns
    run once per row in the filter and again only for the (rare) rows that
    pass it.
    """
    return (
        logs.withColumn("is_sqli", rlike_any(list(columns), sqli_pattern))
        .withColumn("is_xss", rlike_any(list(columns), xss_pattern))
        .filter(F.col("is_sqli") | F.col("is_xss"))
        .withColumn("attack_type", attack_type_of("is_sqli"))
    )


def attack_signatures_sliding(
    logs: DataFrame,
    time_col: str = "event_ts",
    window: str = "1 minute",
    slide: str = "30 seconds",
    sqli_pattern: str = rules.STREAM_SQLI_PATTERN,
    xss_pattern: str = rules.STREAM_XSS_PATTERN,
) -> DataFrame:
    """Tagged rows per sliding window, IP and attack type (SQLi wins when
    both match); CRITICAL, score 90."""
    tagged = attack_tagging(logs, sqli_pattern, xss_pattern)
    return (
        tagged.groupBy(
            F.window(_time(time_col), window, slide).alias("window"), "source_ip", "attack_type"
        )
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            *_alert(
                F.col("count"),
                F.lit(""),
                F.lit("HTTP"),
                F.col("attack_type"),
                rules.CRITICAL,
                F.lit(rules.SIGNATURE_ALERT_SCORE),
            )
        )
    )


def signature_match(
    logs: DataFrame,
    path_literals: tuple[str, ...] = rules.SIGNATURE_PATH_LITERALS,
    agent_literals: tuple[str, ...] = rules.SIGNATURE_AGENT_LITERALS,
) -> DataFrame:
    """Literal, case-sensitive signature match on path or agent
    (stateless, append)."""
    cond = None
    for col, lits in (("request_path", path_literals), ("user_agent", agent_literals)):
        for lit in lits:
            term = F.col(col).contains(lit)
            cond = term if cond is None else (cond | term)
    return logs.filter(cond).select(
        "timestamp",
        "source_ip",
        "request_path",
        "user_agent",
        F.lit(rules.SIGNATURE_ATTACK).alias("threat_type"),
    )


def volume_sliding(
    logs: DataFrame,
    time_col: str = "event_ts",
    window: str = "10 seconds",
    slide: str = "5 seconds",
    more_than_bytes: int = rules.VOLUME_BYTES_THRESHOLD,
) -> DataFrame:
    """Bytes per IP in sliding windows above 10 MiB; HIGH, score 70.

    On a table, events are first summed in tumbling panes of the slide, of
    which the window must be a multiple, so the sliding window copies panes
    instead of events.  On a stream, whose update mode allows one aggregate,
    it copies events."""
    t, total, count = _time(time_col), F.sum("bytes_transferred"), F.count(F.lit(1))
    if not logs.isStreaming:
        logs = logs.groupBy(F.window(t, slide).alias("pane"), "source_ip").agg(total.alias("bytes_transferred"), count.alias("events"))
        t, count = F.window_time("pane"), F.sum("events")
    return (
        logs.groupBy(F.window(t, window, slide).alias("window"), "source_ip")
        .agg(total.alias("total_bytes"), count.alias("count"))
        .filter(F.col("total_bytes") > more_than_bytes)
        .select(
            *_alert(
                F.col("count"),
                F.lit(""),
                F.lit("TCP"),
                F.lit(rules.VOLUME_ANOMALY),
                rules.HIGH,
                F.lit(rules.VOLUME_ALERT_SCORE),
            )
        )
    )


def volume_tumbling(
    logs: DataFrame,
    time_col: str = "event_ts",
    window: str = "10 seconds",
    more_than_bytes: int = rules.VOLUME_BYTES_THRESHOLD,
) -> DataFrame:
    """Bytes per IP in tumbling windows above 10 MiB."""
    return (
        logs.groupBy("source_ip", F.window(_time(time_col), window).alias("window"))
        .agg(F.sum("bytes_transferred").alias("total_bytes"))
        .filter(F.col("total_bytes") > more_than_bytes)
        .select(
            "source_ip",
            *window_bounds("window", as_text=False),
            "total_bytes",
            F.lit(rules.ABNORMAL_VOLUME).alias("threat_type"),
        )
    )


def threat_score_by_ip(logs: DataFrame, fold_case: bool = False, order: bool = True) -> DataFrame:
    """Summed per-event points per IP over all time (raw-case labels by
    default: 'Malicious' scores 0 unless ``fold_case``).  Most IPs share a
    score; the IP as second sort key spreads them over the sort's tasks."""
    out = (
        logs.withColumn("event_score", event_score("threat_label", fold_case))
        .groupBy("source_ip")
        .agg(F.sum("event_score").cast("bigint").alias("total_threat_score"))
    )
    return out.orderBy(F.desc("total_threat_score"), "source_ip") if order else out


def threat_store(
    logs: DataFrame, stored_at: Column | None = None, fold_case: bool = False
) -> DataFrame:
    """malicious/suspicious rows projected to the stored-threat shape."""
    lab = fold("threat_label", fold_case)
    return logs.filter(lab.isin(rules.MALICIOUS, rules.SUSPICIOUS)).select(
        F.col("source_ip").alias("ip_source"),
        F.col("timestamp").alias("last_seen"),
        F.col("threat_label").alias("attack_type"),
        (stored_at if stored_at is not None else F.current_timestamp()).alias("stored_at"),
    )


ALERT_DETECTORS = {
    "brute_force": brute_force_sliding,
    "sqli_xss": attack_signatures_sliding,
    "volume": volume_sliding,
}


def all_alerts(logs: DataFrame, time_col: str = "event_ts", with_label: bool = False) -> DataFrame:
    """D10 (batch form): the three alert detectors as one ALERT frame, from
    one scan (see `panes`)."""
    found = panes.alerts(panes.merge_panes(panes.pane_sums(logs, time_col)))
    return found if with_label else found.drop("label")
