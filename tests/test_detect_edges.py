"""Hand-made rows for the edges of the speed-layer rules."""

from pyspark.sql import functions as F

from logsentinel.operators import detect
from logsentinel.sources import adapters, readers
from tests.conftest import log_rows


def _failed(n, ip, start=0.0, step=1.0, **kw):
    base = dict(action="failed", protocol="SSH")
    return [{**base, "source_ip": ip, "sec": start + i * step, **kw} for i in range(n)]


def test_brute_force_sliding_threshold_is_inclusive(spark):
    rows = _failed(4, "1.1.1.4", start=1) + _failed(5, "1.1.1.5", start=1) + _failed(6, "1.1.1.6", start=1)
    out = detect.brute_force_sliding(log_rows(spark, rows)).collect()
    ips = {r.source_ip for r in out}
    assert ips == {"1.1.1.5", "1.1.1.6"}
    # every burst inside [0 s, 30 s) lies in two sliding windows
    assert sorted((r.source_ip, r.window_start) for r in out) == [
        ("1.1.1.5", "2023-12-31 23:59:30"), ("1.1.1.5", "2024-01-01 00:00:00"),
        ("1.1.1.6", "2023-12-31 23:59:30"), ("1.1.1.6", "2024-01-01 00:00:00"),
    ]
    r = next(r for r in out if r.source_ip == "1.1.1.6")
    assert (r["count"], r.threat_score, r.severity, r.alert_type) == (6, 60, "HIGH", "BRUTE_FORCE")


def test_brute_force_sliding_first_target_is_earliest_event(spark):
    rows = [
        dict(source_ip="9.9.9.9", action="failed", protocol="FTP", dest_ip="172.16.0.9", sec=5),
        dict(source_ip="9.9.9.9", action="failed", protocol="SSH", dest_ip="172.16.0.1", sec=1),
    ] + _failed(4, "9.9.9.9", start=10, dest_ip="172.16.0.5")
    out = detect.brute_force_sliding(log_rows(spark, rows)).filter(
        F.col("window_start") == "2024-01-01 00:00:00"
    ).collect()
    assert [(r.target_ip, r.protocol, r["count"]) for r in out] == [("172.16.0.1", "SSH", 6)]


def test_brute_force_sliding_ignores_other_protocols_and_actions(spark):
    rows = _failed(6, "2.2.2.2", protocol="TCP") + [
        dict(source_ip="3.3.3.3", action="blocked", protocol="SSH", sec=i) for i in range(6)
    ]
    assert detect.brute_force_sliding(log_rows(spark, rows)).count() == 0


def test_burst_across_a_window_boundary(spark):
    # 3 events before 00:00:30 and 3 after: the window starting 00:00:00
    # holds all 6, the neighbours hold 3 each.
    rows = _failed(3, "4.4.4.4", start=27) + _failed(3, "4.4.4.4", start=31)
    out = detect.brute_force_sliding(log_rows(spark, rows)).collect()
    assert [(r.window_start, r["count"]) for r in out] == [("2024-01-01 00:00:00", 6)]


def test_brute_force_tumbling_is_strict(spark):
    rows = []
    for n, ip in ((5, "5.5.5.5"), (6, "6.6.6.6")):
        rows += [dict(source_ip=ip, action="blocked", sec=i) for i in range(n)]
    out = detect.brute_force_tumbling(log_rows(spark, rows), detected_at=F.lit(None)).collect()
    assert [(r.source_ip, r.failed_attempts) for r in out] == [("6.6.6.6", 6)]


def test_brute_force_text_rule(spark):
    def line(ip, msg):
        return f'{{"timestamp":"x","source_ip":"{ip}","message":"{msg}"}}'

    rows = [(line("7.7.7.7", "FAILED LOGIN attempt"), 1)] * 5 + [(line("8.8.8.8", "failed login"), 1)] * 4
    rows += [("no ip here, failed login", 1)] * 5 + [(line("7.7.7.7", "ok"), 1)] * 3
    df = spark.createDataFrame(rows, "value string, sec int").withColumn(
        "ts", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,sec)")
    )
    decoded = readers.decode_raw_text(df)
    assert decoded.filter(F.col("source_ip") == "").count() == 5
    out = detect.brute_force_text(df.withColumnRenamed("value", "raw_log"), time_col="ts").collect()
    assert sorted((r.source_ip, r["count"]) for r in out) == [("", 5), ("7.7.7.7", 5)]


def test_attack_tagging_null_semantics_and_sqli_priority(spark):
    rows = [
        dict(event_id=0, request_path=None, user_agent="sqlmap/1.7.8#stable"),  # null OR true
        dict(event_id=1, request_path="/a?x=<script>", user_agent=None),  # xss only, sqli null
        dict(event_id=2, request_path=None, user_agent=None),  # both null -> dropped
        dict(event_id=3, request_path="/q?id=1 UNION SELECT 1 <script>", user_agent="x"),  # both
        dict(event_id=4, request_path="/index.html", user_agent="Mozilla/5.0"),  # neither
        dict(event_id=5, request_path=None, user_agent="curl"),  # null OR false -> dropped
    ]
    out = {r.event_id: r for r in detect.attack_tagging(log_rows(spark, rows)).collect()}
    assert set(out) == {0, 1, 3}
    assert (out[0].is_sqli, out[0].attack_type) == (True, "SQLi")
    assert (out[1].is_sqli, out[1].is_xss, out[1].attack_type) == (None, True, "XSS")
    assert (out[3].is_sqli, out[3].is_xss, out[3].attack_type) == (True, True, "SQLi")


def test_attack_signatures_sliding_counts_overlap_once_as_sqli(spark):
    rows = [dict(request_path="/q?id=1 UNION SELECT 1 <script>", sec=1)] * 2 + [
        dict(request_path="<script>", sec=2)
    ]
    out = detect.attack_signatures_sliding(log_rows(spark, rows)).filter(
        F.col("window_start") == "2024-01-01 00:00:00"
    ).collect()
    got = sorted((r.alert_type, r["count"], r.threat_score, r.severity, r.target_ip, r.protocol) for r in out)
    assert got == [("SQLi", 2, 90, "CRITICAL", "", "HTTP"), ("XSS", 1, 90, "CRITICAL", "", "HTTP")]


def test_signature_match_is_literal_and_case_sensitive(spark):
    rows = [
        dict(event_id=0, request_path="/x?' OR '1'='1"),
        dict(event_id=1, request_path="/x?' or '1'='1"),  # wrong case
        dict(event_id=2, user_agent="nikto/2.1.6"),
        dict(event_id=3, user_agent="SQLMAP"),  # wrong case
        dict(event_id=4, request_path="<SCRIPT>"),  # wrong case
        dict(event_id=5, request_path="<script>"),
    ]
    out = detect.signature_match(log_rows(spark, rows)).collect()
    assert sorted(r.request_path or "" for r in out) == ["/index.html", "/x?' OR '1'='1", "<script>"]
    assert {r.threat_type for r in out} == {"SIGNATURE_ATTACK"}


def test_volume_threshold_is_strict(spark):
    limit = 10 * 1024 * 1024
    rows = [dict(source_ip="a", bytes_transferred=limit, sec=1),
            dict(source_ip="b", bytes_transferred=limit, sec=1),
            dict(source_ip="b", bytes_transferred=1, sec=2)]
    out = detect.volume_sliding(log_rows(spark, rows)).collect()
    assert {r.source_ip for r in out} == {"b"}
    assert all(r.threat_score == 70 and r.alert_type == "VOLUME_ANOMALY" for r in out)
    tum = detect.volume_tumbling(log_rows(spark, rows)).collect()
    assert [(r.source_ip, r.total_bytes) for r in tum] == [("b", limit + 1)]


def test_threat_score_raw_case_by_default(spark):
    rows = [dict(source_ip="x", threat_label="malicious"), dict(source_ip="x", threat_label="Malicious"),
            dict(source_ip="x", threat_label="suspicious"), dict(source_ip="x", threat_label=None)]
    df = log_rows(spark, rows)
    assert detect.threat_score_by_ip(df).collect()[0].total_threat_score == 15
    assert detect.threat_score_by_ip(df, fold_case=True).collect()[0].total_threat_score == 25


def test_threat_store_projection(spark):
    rows = [dict(threat_label="malicious"), dict(threat_label="benign"), dict(threat_label="Suspicious")]
    out = detect.threat_store(log_rows(spark, rows), stored_at=F.lit("t")).collect()
    assert [(r.attack_type, r.stored_at) for r in out] == [("malicious", "t")]


def test_all_alerts_is_union_of_three_detectors(spark):
    from tests.conftest import SF_SMALL

    lv = adapters.load_log_view(spark, SF_SMALL)
    parts = sum(fn(lv).count() for fn in detect.ALERT_DETECTORS.values())
    assert detect.all_alerts(lv).count() == parts
