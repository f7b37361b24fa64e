"""The command-line jobs end to end on a clean log table."""

from pyspark.sql import functions as F

from logsentinel import jobs
from logsentinel.operators import batch
from logsentinel.sources import adapters
from tests.conftest import SF_SMALL


def test_batch_job_then_serving_routes(spark, tmp_path, capsys):
    clean = adapters.load_log_view(spark, SF_SMALL).withColumn("timestamp", F.col("event_ts")).drop(
        "event_ts", "event_id")
    logs_path = str(tmp_path / "clean_logs.parquet")
    clean.write.parquet(logs_path)
    out = str(tmp_path / "results")
    paths = jobs.run_batch(spark, logs_path, out)
    assert set(paths) == {"top_malicious_ips", "port_scan_detection", "sqli_xss_detection",
                          "bytes_volume_by_threat_label"}
    got = {r.attack_type: r["count"] for r in spark.read.parquet(paths["sqli_xss_detection"]).collect()}
    want = {r.attack_type: r["count"] for r in batch.sqli_xss_totals(clean).collect()}
    assert got == want
    capsys.readouterr()
    jobs.run_serve(spark, out, None, "kpis", [])
    text = capsys.readouterr().out
    assert '"sqli_count":%d' % want["SQLi"] in text
    jobs.run_serve(spark, out, None, "ip", ["10.0.0.1", "203.0.113.9"])
    text = capsys.readouterr().out
    assert '"status":"clean"' in text


def test_profile_job_prints_sections(spark, tmp_path, capsys):
    p = str(tmp_path / "raw.csv")
    adapters.with_dirty_timestamp(adapters.load_log_view(spark, SF_SMALL)).write.option(
        "header", "true").csv(p)
    jobs.main(["profile", "--csv", p])
    text = capsys.readouterr().out
    for section in ("# shape", "# types", "# missing values", "# duplicates", "# sample"):
        assert section in text
    assert '"row_count":1000' in text


def test_stream_job_available_now(spark, tmp_path):
    from logsentinel.operators import detect, serve
    from logsentinel.sources import readers

    logs = adapters.load_log_view(spark, SF_SMALL)
    src = str(tmp_path / "in")
    adapters.to_json_lines(logs).write.text(src)
    alerts, ckpt = str(tmp_path / "alerts"), str(tmp_path / "ckpt")
    assert jobs.main(["stream", "--json-dir", src, "--alerts", alerts, "--checkpoint", ckpt,
                      "--available-now"]) == 0
    current = serve.current_alerts(readers.read_alerts(spark, alerts))
    assert current.count() == detect.all_alerts(logs).count()


def test_every_serve_route_runs(spark, tmp_path, capsys):
    from logsentinel.operators import detect
    from logsentinel.sources import sinks

    lv = adapters.load_log_view(spark, SF_SMALL)
    clean = lv.withColumn("timestamp", F.col("event_ts")).drop("event_ts", "event_id")
    logs_path = str(tmp_path / "clean")
    clean.write.parquet(logs_path)
    out = str(tmp_path / "results")
    jobs.run_batch(spark, logs_path, out)
    alerts = str(tmp_path / "alerts")
    sinks.labelled_alert_writer(alerts)(detect.all_alerts(lv, with_label=True), 0)
    for route in ("top", "ip", "port-scans", "bytes", "sqli-xss", "stats", "kpis", "streaming",
                  "streaming-stats"):
        capsys.readouterr()
        jobs.run_serve(spark, out, alerts, route, ["10.0.0.1"])
        assert capsys.readouterr().out.strip(), route


def test_normalize_job(spark, tmp_path, capsys):
    raw = str(tmp_path / "raw.csv")
    adapters.with_dirty_timestamp(adapters.load_log_view(spark, SF_SMALL)).write.option(
        "header", "true").csv(raw)
    out = str(tmp_path / "clean.parquet")
    assert jobs.main(["normalize", "--csv", raw, "--out", out]) == 0
    clean = spark.read.parquet(out)
    assert dict(clean.dtypes)["timestamp"] == "timestamp_ntz"
    assert clean.count() == 1000
    assert clean.filter(F.col("timestamp").isNull()).count() == 1000 // 89  # every 89th text is bad


def test_rule_job_presets(spark, tmp_path):
    logs = adapters.load_log_view(spark, SF_SMALL)
    src = str(tmp_path / "in")
    adapters.to_json_lines(logs).write.text(src)
    store = str(tmp_path / "store")
    assert jobs.main(["rule", "--rule", "threat_store", "--json-dir", src, "--checkpoint",
                      str(tmp_path / "ck1"), "--out", store, "--available-now"]) == 0
    from logsentinel.operators import detect

    assert spark.read.parquet(store).count() == detect.threat_store(logs).count()
    for rule in ("signature_match", "threat_score", "brute_force_tumbling"):
        assert jobs.main(["rule", "--rule", rule, "--json-dir", src, "--checkpoint",
                          str(tmp_path / f"ck_{rule}"), "--available-now"]) == 0
