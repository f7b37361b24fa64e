"""The three alert detectors (D1, D4, D6) from one pass over the log.

Events are first aggregated in tumbling panes of five seconds, the longest
span of which every window bound of the detectors is a multiple.  Neighbouring
panes are then merged into the sliding minutes of the brute-force and attack
rules; a minute also holds, pane by pane, the byte sums from which the volume
rule's ten-second windows follow.  So there is one scan, one decode and one
raw-row aggregate, and the rows that the sliding windows double are panes, not
events.

`pane_sums` → `merge_panes` → `alerts` is the batch form, and on a stream the
append form (two chained stateful operators, the second keyed by
``window_time``; a window's alerts come once, when the watermark has passed
it).  `sliding_sums` → `alerts` is the stream's update form: chained operators
cannot update, so the minutes are summed directly, and every alert carries the
time of its last change so that a micro-batch emits only what it changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsentinel import rules
from logsentinel.functions.expressions import WINDOW_TEXT_FORMAT, rlike_any

#: Seconds of a pane; panes of a volume window, of a slide and of a minute.
PANE = 5
BURST, SLIDE, LENGTH = 2, 6, 12

_MINUTE, _STEP = f"{PANE * LENGTH} seconds", f"{PANE * SLIDE} seconds"


def _seconds(n: int) -> Column:
    return F.expr(f"INTERVAL {n} SECONDS")


def _flagged(
    logs: DataFrame, time_col: str, action: str = "failed", protocols: tuple[str, ...] = rules.BRUTE_FORCE_PROTOCOLS,
    sqli_pattern: str = rules.STREAM_SQLI_PATTERN, xss_pattern: str = rules.STREAM_XSS_PATTERN,
) -> DataFrame:
    """What the detectors need of a log row: time, address, bytes, the failed
    login's target, and the attack flags in the rules' three-valued logic."""
    columns = ["request_path", "user_agent"]
    failed = F.coalesce((F.col("action") == action) & F.col("protocol").isin(*protocols), F.lit(False))
    flagged = logs.select(
        F.col(time_col).alias("t"), "source_ip", "bytes_transferred", failed.alias("failed"),
        F.when(failed, F.col("dest_ip")).alias("dest_ip"), F.when(failed, F.col("protocol")).alias("protocol"),
        F.coalesce(rlike_any(columns, sqli_pattern), F.lit(False)).alias("sqli"),
        F.coalesce(rlike_any(columns, xss_pattern), F.lit(False)).alias("xss"),
    )
    return flagged.withColumn("xss", F.col("xss") & ~F.col("sqli"))


def pane_sums(logs: DataFrame, time_col: str = "event_ts", **rule) -> DataFrame:
    """One row per pane, address and failed-login target.  The target is part
    of the key, so every buffer is a number and the raw rows go through a hash
    aggregate; which target came first is settled when panes are merged."""
    return (
        _flagged(logs, time_col, **rule)
        .groupBy(F.window("t", f"{PANE} seconds").alias("pane"), "source_ip", "failed", "dest_ip", "protocol")
        .agg(
            F.count(F.lit(1)).alias("events"), F.sum("bytes_transferred").alias("bytes"), F.min("t").alias("first_t"),
            F.count_if("sqli").alias("sqli"), F.count_if("xss").alias("xss"),
        )
    )


def _first(t: str) -> Column:
    """Target and protocol of the earliest failed login, ties by their values."""
    return F.min(F.when(F.col("failed"), F.struct(F.col(t).alias("t"), "dest_ip", "protocol")))


def _place(time: Column) -> Column:
    """Which pane of its minute-long window a time lies in.  A column of its
    own, so that it is worked out once per row."""
    return F.floor(F.pmod(F.second(time) - F.second(F.col("window.start")), F.lit(PANE * LENGTH)) / PANE)


def merge_panes(panes: DataFrame) -> DataFrame:
    """Neighbouring panes → sliding minutes, with events and bytes by pane."""
    minutes = panes.withColumn("window", F.window(F.window_time("pane"), _MINUTE, _STEP)).withColumn("place", _place(F.col("pane.start")))
    at = [F.col("place") == i for i in range(LENGTH)]
    return minutes.groupBy("window", "source_ip").agg(
        F.sum(F.when(F.col("failed"), F.col("events"))).alias("failed"), _first("first_t").alias("first"),
        F.sum("sqli").alias("sqli"), F.sum("xss").alias("xss"),
        *[F.sum(F.when(a, F.col("events"))).alias(f"events_{i}") for i, a in enumerate(at)],
        *[F.sum(F.when(a, F.col("bytes"))).alias(f"bytes_{i}") for i, a in enumerate(at)],
    )


def sliding_sums(logs: DataFrame, time_col: str = "event_ts", **rule) -> DataFrame:
    """The columns of `merge_panes` in one stateful aggregate over the log,
    and when each part was last changed (the time of its micro-batch)."""
    minutes = _flagged(logs, time_col, **rule).withColumn("window", F.window("t", _MINUTE, _STEP))
    minutes = minutes.withColumn("now", F.current_timestamp())
    minutes = minutes.withColumn("place", _place(F.col("t")))
    at = [F.col("place") == i for i in range(LENGTH)]

    def changed(condition: Column) -> Column:
        return F.max(F.when(condition, F.col("now")))

    return minutes.groupBy("window", "source_ip").agg(
        F.count_if("failed").alias("failed"), _first("t").alias("first"),
        F.count_if("sqli").alias("sqli"), F.count_if("xss").alias("xss"),
        *[F.count_if(a).alias(f"events_{i}") for i, a in enumerate(at)],
        *[F.sum(F.when(a, F.col("bytes_transferred"))).alias(f"bytes_{i}") for i, a in enumerate(at)],
        changed(F.col("failed")).alias("failed_at"), changed(F.col("sqli")).alias("sqli_at"), changed(F.col("xss")).alias("xss_at"),
        *[changed(a).alias(f"changed_{i}") for i, a in enumerate(at)],
    )


def alerts(
    minutes: DataFrame, changed_only: bool = False, min_failed: int = 5, more_than_bytes: int = rules.VOLUME_BYTES_THRESHOLD
) -> DataFrame:
    """ALERT rows with their detector's ``label`` from sliding minutes; with
    ``changed_only`` those that the current micro-batch changed."""
    none = F.lit(None).cast("timestamp")

    def alert(condition, label, kind, severity, count, score, target=F.lit(""), protocol=F.lit("HTTP"), offset=0, panes=LENGTH, changed=()):
        if changed_only:
            last = F.greatest(*[F.col(c) for c in changed], none)
            condition = condition & (last == F.col("now"))
        start = F.col("window.start") + _seconds(PANE * offset)
        return F.when(condition, F.struct(
            F.date_format(start, WINDOW_TEXT_FORMAT).alias("window_start"),
            F.date_format(start + _seconds(PANE * panes), WINDOW_TEXT_FORMAT).alias("window_end"),
            count.cast("bigint").alias("count"), target.alias("target_ip"), protocol.alias("protocol"), F.lit(kind).alias("alert_type"),
            F.lit(severity).alias("severity"), score.cast("bigint").alias("threat_score"), F.lit(label).alias("label"),
        ))

    def total(name: str, i: int) -> Column:
        return sum((F.coalesce(f"{name}_{k}", F.lit(0)) for k in range(i + 1, i + BURST)), F.coalesce(f"{name}_{i}", F.lit(0)))

    failed, score = F.col("failed"), F.lit(rules.SIGNATURE_ALERT_SCORE)
    found = [
        alert(failed >= min_failed, "brute_force", rules.BRUTE_FORCE, rules.HIGH, failed, failed * rules.BRUTE_FORCE_SCORE_PER_EVENT,
              F.col("first.dest_ip"), F.col("first.protocol"), changed=("failed_at",)),
        alert(F.col("sqli") > 0, "sqli_xss", rules.SQLI, rules.CRITICAL, F.col("sqli"), score, changed=("sqli_at",)),
        alert(F.col("xss") > 0, "sqli_xss", rules.XSS, rules.CRITICAL, F.col("xss"), score, changed=("xss_at",)),
        # A volume window belongs to the minute whose first half it starts in,
        # and lies within it.
        *[
            alert(total("bytes", i) > more_than_bytes, "volume", rules.VOLUME_ANOMALY, rules.HIGH, total("events", i),
                  F.lit(rules.VOLUME_ALERT_SCORE), protocol=F.lit("TCP"), offset=i, panes=BURST,
                  changed=[f"changed_{k}" for k in range(i, i + BURST)])
            for i in range(SLIDE)
        ],
    ]
    if changed_only:
        minutes = minutes.withColumn("now", F.current_timestamp())
    return minutes.select("source_ip", F.inline(F.array_compact(F.array(*found))))


def stream_alerts(logs: DataFrame, final: bool = False, time_col: str = "event_ts") -> DataFrame:
    """The three detectors of a decoded stream as one query's frame: for
    update mode, or with ``final`` for append mode."""
    if final:
        return alerts(merge_panes(pane_sums(logs, time_col)))
    return alerts(sliding_sums(logs, time_col), changed_only=True)
