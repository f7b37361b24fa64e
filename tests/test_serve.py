"""Serving-layer rules on hand-made result tables."""

from logsentinel.operators import serve


def _top(spark, rows):
    return spark.createDataFrame(
        rows,
        "source_ip string, threat_count bigint, malicious_count bigint, suspicious_count bigint, total_bytes bigint",
    )


def test_reputation_scaling_bonus_and_cap(spark):
    top = _top(spark, [
        ("a", 100, 0, 100, 1),   # max count, no bonus -> 99
        ("b", 10, 3, 7, 1),      # min count, ratio 0.3 exactly -> no bonus -> 50
        ("c", 55, 30, 25, 1),    # 50 + 0.5*49 = 74.5 -> 74, bonus -> 84
        ("d", 100, 90, 10, 1),   # 99 + 10 capped -> 99
    ])
    got = {r.source_ip: (r.reputation_score, r.threat_level) for r in serve.ip_reputation(top).collect()}
    assert got == {"a": (99, "CRITICAL"), "b": (50, "MEDIUM"), "c": (84, "HIGH"), "d": (99, "CRITICAL")}


def test_reputation_flat_counts_score_75(spark):
    top = _top(spark, [("a", 5, 0, 5, 1), ("b", 5, 5, 0, 1)])
    got = {r.source_ip: r.reputation_score for r in serve.ip_reputation(top).collect()}
    assert got == {"a": 75, "b": 85}


def test_threat_level_cut_offs(spark):
    from logsentinel.functions import threat_level

    df = spark.createDataFrame([(s,) for s in (39, 40, 64, 65, 84, 85)], "s int")
    assert [r.l for r in df.select(threat_level("s").alias("l")).collect()] == [
        "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL"]


def test_ip_lookup_found_clean_and_alerts(spark):
    top = _top(spark, [("a", 100, 0, 100, 1), ("b", 10, 0, 10, 1)])
    req = spark.createDataFrame([("a",), ("b",), ("z",)], "ip string")
    alerts = spark.createDataFrame(
        [("a", "w", "BRUTE_FORCE", 60), ("a", "w2", "SQLi", 90), ("z", "w", "XSS", 90)],
        "source_ip string, window_start string, alert_type string, threat_score bigint",
    )
    got = {r.ip: r for r in serve.ip_lookup(req, top, alerts).collect()}
    assert (got["a"].status, got["a"].action, got["a"].active_alerts, got["a"].max_alert_score) == (
        "threat", "BLOCK", 2, 90)
    assert (got["b"].status, got["b"].action, got["b"].reputation_score) == ("threat", "MONITOR", 50)
    assert (got["z"].status, got["z"].action, got["z"].threat_level, got["z"].active_alerts) == (
        "clean", None, None, 1)


def _alerts(spark, rows):
    return spark.createDataFrame(
        rows,
        "source_ip string, window_start string, window_end string, count bigint, target_ip string, "
        "protocol string, alert_type string, severity string, threat_score bigint, label string, batch_id bigint",
    )


def test_current_alerts_keeps_latest_emission(spark):
    a = _alerts(spark, [
        ("1", "12:00:00", "12:01:00", 3, "", "HTTP", "SQLi", "CRITICAL", 90, "sqli_xss", 180),
        ("1", "12:00:00", "12:01:00", 6, "", "HTTP", "SQLi", "CRITICAL", 90, "sqli_xss", 186),
        ("1", "12:00:00", "12:01:00", 2, "", "HTTP", "XSS", "CRITICAL", 90, "sqli_xss", 180),
    ])
    cur = sorted((r.alert_type, r["count"], r.batch_id) for r in serve.current_alerts(a).collect())
    assert cur == [("SQLi", 6, 186), ("XSS", 2, 180)]
    panels = serve.dashboard_panels(None, None, None, a).collect()[0]
    assert panels.alert_event_total == 11 and panels.sqli_alert_events == 9
    assert serve.dashboard_panels(None, None, None, serve.current_alerts(a)).collect()[0].alert_event_total == 8


def test_alert_feed_summary_stats(spark):
    a = _alerts(spark, [
        ("1", "2024-01-01 00:00:00", "2024-01-01 00:01:00", 6, "t", "SSH", "BRUTE_FORCE", "HIGH", 60, "b", 0),
        ("2", "2024-01-01 00:00:00", "2024-01-01 00:01:00", 1, "", "HTTP", "SQLi", "CRITICAL", 90, "s", 0),
        ("0", "2024-01-02 00:00:00", "2024-01-02 00:01:00", 1, "", "HTTP", "XSS", "CRITICAL", 90, "s", 0),
        (None, "2024-01-02 00:00:00", "2024-01-02 00:01:00", 1, "", "HTTP", None, None, None, "s", 0),
    ])
    feed = serve.alert_feed(a).collect()
    assert [r.threat_score for r in feed] == [90, 90, 60, 0]
    recent = serve.alert_feed(a, as_of="2024-01-02 12:00:00").collect()
    assert len(recent) == 2
    s = serve.alert_summary(a).collect()[0]
    assert (s.total, s.unique_ips) == (4, 4)  # a null IP counts as one value
    by_type = {r.alert_type: r["count"] for r in serve.alert_counts_by_type(a).collect()}
    assert by_type == {"BRUTE_FORCE": 1, "SQLi": 1, "XSS": 1, "UNKNOWN": 1}
    st = serve.alert_stats(a).collect()[0]
    assert (st.total_alerts, st.brute_force_count, st.sqli_xss_count, st.volume_anomaly_count,
            st.critical_count, st.unique_attacker_ips, st.top_attacker) == (4, 1, 2, 0, 2, 4, "0")


def test_kpis_and_missing_tables(spark):
    totals = spark.createDataFrame([("SQLi", 7), ("XSS", 3)], "attack_type string, count bigint")
    k = serve.threat_kpis(totals, None, None).collect()[0]
    assert (k.sqli_count, k.xss_count, k.malicious_events, k.top_ip_count) == (7, 3, 0, 0)


def test_result_table_stats_reports_missing(spark, tmp_path):
    p = str(tmp_path / "present")
    spark.range(3).write.parquet(p)
    out = {r.table_name: (r.available, r.row_count) for r in serve.result_table_stats(
        spark, {"present": p, "absent": str(tmp_path / "absent")}, str(tmp_path / "no_alerts")).collect()}
    assert out == {"present": (True, 3), "absent": (False, 0), "brute_force_alerts": (False, 0)}


def test_bytes_series_fixed_order_and_skips_absent(spark):
    b = spark.createDataFrame(
        [("benign", 3, 30, 10.005, 1, 20), ("malicious", 1, 50, 50.0, 50, 50), ("other", 1, 1, 1.0, 1, 1)],
        "threat_label string, event_count bigint, total_bytes bigint, avg_bytes double, min_bytes bigint, max_bytes bigint",
    )
    out = serve.dashboard_bytes_series(b).collect()
    assert [(r.threat_label, r.display_label) for r in out] == [("malicious", "Malicious"), ("benign", "Benign")]


def test_fmt_num(spark):
    from logsentinel.functions import fmt_num

    df = spark.createDataFrame([(999,), (1500,), (2_500_000,), (3_040_000_000,), (None,)], "n bigint")
    assert [r.s for r in df.select(fmt_num("n").alias("s")).collect()] == ["999", "1.5K", "2.5M", "3.0B", None]
