"""Stream = batch: the detectors as Structured Streaming queries through the
micro-batch alert sink, compared with their batch forms."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from logsentinel.operators import detect, serve
from logsentinel.schema import ALERT_COLUMNS
from logsentinel.sources import adapters, readers
from logsentinel.streaming import runner
from tests.conftest import SF_SMALL


def _write_ordered_files(folder, line_groups):
    """One file per group, written one after another so that the file
    source (which orders by modification time) replays them in order."""
    os.makedirs(folder, exist_ok=True)
    for i, lines in enumerate(line_groups):
        with open(os.path.join(folder, f"part-{i:03d}.json"), "w", encoding="utf-8") as fh:
            fh.write("\n".join(lines) + "\n")
        time.sleep(0.05)


def _key_set(df):
    return sorted(tuple(r[c] for c in ALERT_COLUMNS + ["label"]) for r in df.collect())


def test_stream_equals_batch_over_ordered_micro_batches(spark, tmp_path):
    logs = adapters.load_log_view(spark, SF_SMALL)
    rows = adapters.to_json_lines(logs.orderBy("event_id")).collect()
    lines = [r.value for r in rows]
    chunk = len(lines) // 5 + 1
    src_dir = str(tmp_path / "in")
    _write_ordered_files(src_dir, [lines[i:i + chunk] for i in range(0, len(lines), chunk)])

    out_dir, ckpt = str(tmp_path / "alerts"), str(tmp_path / "ckpt")
    qs = runner.start_alert_queries(
        runner.text_file_source(spark, src_dir, max_files_per_trigger=1), out_dir, ckpt,
        trigger={"availableNow": True})
    runner.await_all(qs)

    emitted = readers.read_alerts(spark, out_dir)
    current = serve.current_alerts(emitted)
    expected = detect.all_alerts(logs, with_label=True)
    assert emitted.count() > current.count()  # growing windows were re-emitted
    assert emitted.select("batch_id").distinct().count() >= 5
    assert _key_set(current) == _key_set(expected)


def test_union_mode_matches_separate_queries(spark, tmp_path):
    logs = adapters.load_log_view(spark, SF_SMALL)
    src_dir = str(tmp_path / "in")
    _write_ordered_files(src_dir, [[r.value for r in adapters.to_json_lines(logs).collect()]])
    out_dir = str(tmp_path / "alerts")
    qs = runner.start_alert_queries(
        runner.text_file_source(spark, src_dir), out_dir, str(tmp_path / "ckpt"),
        trigger={"availableNow": True}, union=True, name_prefix="union_test")
    assert [q.name for q in qs] == ["union_test_all"]
    runner.await_all(qs)
    current = serve.current_alerts(readers.read_alerts(spark, out_dir))
    assert _key_set(current) == _key_set(detect.all_alerts(logs, with_label=True))


def _event(sec, ip, action="failed", protocol="SSH"):
    ts = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=sec)
    return (
        f'{{"timestamp":"{ts.isoformat()}","source_ip":"{ip}","dest_ip":"172.16.0.1",'
        f'"protocol":"{protocol}","action":"{action}","bytes_transferred":10}}'
    )


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    # Spark filters late input with the watermark of the *previous* batch:
    # the watermark set after batch 0 drops late rows from batch 2 on, so the
    # late file comes third.
    src_dir = str(tmp_path / "in")
    on_time = [_event(600 + i, "10.0.0.1") for i in range(6)]  # 00:10:00
    still_on_time = [_event(610 + i, "10.0.0.1") for i in range(2)]
    late = [_event(i, "10.0.0.2") for i in range(6)]  # 00:00:00, > 2 min behind
    _write_ordered_files(src_dir, [on_time, still_on_time, late])
    out_dir = str(tmp_path / "alerts")
    qs = runner.start_alert_queries(
        runner.text_file_source(spark, src_dir, max_files_per_trigger=1), out_dir,
        str(tmp_path / "ckpt"), trigger={"availableNow": True},
        detectors={"brute_force": detect.brute_force_sliding})
    runner.await_all(qs)
    ips = {r.source_ip for r in readers.read_alerts(spark, out_dir).collect()}
    assert ips == {"10.0.0.1"}


def test_restart_from_checkpoint_does_not_duplicate(spark, tmp_path):
    src_dir = str(tmp_path / "in")
    _write_ordered_files(src_dir, [[_event(i, "10.0.0.3") for i in range(6)]])
    out_dir, ckpt = str(tmp_path / "alerts"), str(tmp_path / "ckpt")
    det = {"brute_force": detect.brute_force_sliding}
    src = runner.text_file_source(spark, src_dir)
    runner.await_all(runner.start_alert_queries(src, out_dir, ckpt, {"availableNow": True}, detectors=det))
    first = readers.read_alerts(spark, out_dir).count()
    runner.await_all(runner.start_alert_queries(src, out_dir, ckpt, {"availableNow": True}, detectors=det))
    assert readers.read_alerts(spark, out_dir).count() == first == 2


def test_threat_store_stream_appends(spark, tmp_path):
    src_dir = str(tmp_path / "in")
    lines = [
        '{"timestamp":"2024-01-01T00:00:00","source_ip":"1.1.1.1","threat_label":"malicious"}',
        '{"timestamp":"2024-01-01T00:00:01","source_ip":"1.1.1.2","threat_label":"benign"}',
        '{"timestamp":"2024-01-01T00:00:02","source_ip":"1.1.1.3","threat_label":"suspicious"}',
    ]
    _write_ordered_files(src_dir, [lines])
    out = str(tmp_path / "store")
    q = runner.start_threat_store(runner.text_file_source(spark, src_dir), out, str(tmp_path / "ck"),
                                  {"availableNow": True})
    runner.await_all([q])
    got = sorted((r.ip_source, r.attack_type) for r in spark.read.parquet(out).collect())
    assert got == [("1.1.1.1", "malicious"), ("1.1.1.3", "suspicious")]


def test_complete_mode_threat_score_to_memory(spark, tmp_path):
    src_dir = str(tmp_path / "in")
    _write_ordered_files(src_dir, [[
        '{"source_ip":"a","threat_label":"malicious"}', '{"source_ip":"a","threat_label":"suspicious"}',
        '{"source_ip":"b","threat_label":"Malicious"}']])
    q = runner.start_detector(
        runner.text_file_source(spark, src_dir), detect.threat_score_by_ip, str(tmp_path / "ck"),
        "complete", memory_table="threat_scores_test", trigger={"availableNow": True}, watermark=None)
    runner.await_all([q])
    got = {r.source_ip: r.total_threat_score for r in spark.table("threat_scores_test").collect()}
    assert got == {"a": 15, "b": 0}



def test_parquet_log_stream_equals_batch(spark, tmp_path):
    logs = adapters.load_log_view(spark, SF_SMALL)
    clean = logs.withColumn("timestamp", F.col("event_ts")).drop("event_ts", "event_id")
    src_dir = str(tmp_path / "parquet_in")
    clean.write.parquet(src_dir)
    out_dir = str(tmp_path / "alerts")
    qs = runner.start_alert_queries(
        runner.table_file_source(spark, src_dir, clean.schema), out_dir, str(tmp_path / "ckpt"),
        trigger={"availableNow": True}, decode=lambda df: readers.with_event_time(df, "timestamp"))
    runner.await_all(qs)
    current = serve.current_alerts(readers.read_alerts(spark, out_dir))
    assert _key_set(current) == _key_set(detect.all_alerts(logs, with_label=True))


def test_raw_text_brute_force_on_processing_time_complete_mode(spark, tmp_path):
    src_dir = str(tmp_path / "in")
    lines = [f'{{"timestamp":"2026-05-19 20:07","source_ip":"192.168.1.{ip}",'
             f'"message":"failed login attempt"}}' for ip in [0] * 6 + [1] * 4]
    lines += ['{"source_ip":"192.168.1.9","message":"login ok"}'] * 7
    _write_ordered_files(src_dir, [lines])
    q = runner.start_detector(
        runner.text_file_source(spark, src_dir), detect.brute_force_text, str(tmp_path / "ck"),
        "complete", memory_table="raw_text_bf_test", trigger={"availableNow": True},
        decode=readers.decode_raw_text)
    runner.await_all([q])
    got = sorted((r.source_ip, r["count"]) for r in spark.table("raw_text_bf_test").collect())
    assert got == [("192.168.1.0", 6)]  # 4 lines from .1 stay below the threshold (>= 5)


@pytest.mark.parametrize(
    "name,detector,mode",
    [
        ("d3", lambda df: detect.brute_force_tumbling(df, detected_at=F.lit(None).cast("timestamp")), "update"),
        ("d5", detect.signature_match, "append"),
        ("d7", detect.volume_tumbling, "update"),
    ],
)
def test_other_detectors_stream_equals_batch(spark, tmp_path, name, detector, mode):
    logs = adapters.load_log_view(spark, SF_SMALL)
    src_dir = str(tmp_path / "in")
    _write_ordered_files(src_dir, [[r.value for r in adapters.to_json_lines(logs).collect()]])
    table = f"stream_eq_{name}"
    q = runner.start_detector(runner.text_file_source(spark, src_dir), detector, str(tmp_path / "ck"),
                              mode, memory_table=table, trigger={"availableNow": True})
    runner.await_all([q])
    streamed = spark.table(table).drop("detected_at")
    batch_out = detector(logs).drop("detected_at")
    cols = [c for c in batch_out.columns]
    as_text = [F.col(c).cast("string").alias(c) for c in cols]
    assert sorted(map(tuple, streamed.select(*as_text).collect())) == sorted(
        map(tuple, batch_out.select(*as_text).collect()))


def test_await_all_stops_the_others_on_failure(spark, tmp_path):
    src_dir = str(tmp_path / "in")
    _write_ordered_files(src_dir, [[_event(i, "10.0.0.5") for i in range(3)]])

    def broken(df):
        return df.select(F.expr("raise_error('boom')").alias("x"))

    slow = runner.start_detector(runner.text_file_source(spark, src_dir), detect.signature_match,
                                 str(tmp_path / "ck1"), "append", memory_table="await_slow",
                                 trigger={"processingTime": "1 hour"})
    bad = runner.start_detector(runner.text_file_source(spark, src_dir), broken,
                                str(tmp_path / "ck2"), "append", memory_table="await_bad",
                                trigger={"availableNow": True})
    with pytest.raises(Exception):
        runner.await_all([bad, slow])
    assert not slow.isActive and not bad.isActive


def test_stream_equals_batch_sf001_ten_batches(spark, tmp_path):
    from tests.conftest import SF_MID

    logs = adapters.load_log_view(spark, SF_MID)
    lines = [r.value for r in adapters.to_json_lines(logs.orderBy("event_id")).collect()]
    chunk = len(lines) // 10
    src_dir = str(tmp_path / "in")
    _write_ordered_files(src_dir, [lines[i:i + chunk] for i in range(0, len(lines), chunk)])
    out_dir = str(tmp_path / "alerts")
    qs = runner.start_alert_queries(
        runner.text_file_source(spark, src_dir, max_files_per_trigger=1), out_dir,
        str(tmp_path / "ckpt"), trigger={"availableNow": True})
    runner.await_all(qs)
    emitted = readers.read_alerts(spark, out_dir)
    current = serve.current_alerts(emitted)
    assert emitted.select("batch_id").distinct().count() >= 10
    assert emitted.count() > current.count()
    assert _key_set(current) == _key_set(detect.all_alerts(logs, with_label=True))


def test_await_any_returns_when_one_detector_ends(spark, tmp_path):
    src_dir = str(tmp_path / "in")
    _write_ordered_files(src_dir, [[_event(i, "10.0.0.7") for i in range(6)]])
    long_running = runner.start_detector(
        runner.text_file_source(spark, src_dir), detect.signature_match, str(tmp_path / "ck1"),
        "append", memory_table="await_any_long", trigger={"processingTime": "1 hour"})
    try:
        assert runner.await_any(spark, timeout_s=2) is False  # nothing has ended yet
        short = runner.start_detector(
            runner.text_file_source(spark, src_dir), detect.signature_match, str(tmp_path / "ck2"),
            "append", memory_table="await_any_short", trigger={"availableNow": True})
        assert runner.await_any(spark, timeout_s=120) is True
        assert not short.isActive and long_running.isActive
    finally:
        long_running.stop()


def test_state_partitions_are_those_of_the_stream_session(spark, tmp_path):
    src_dir = str(tmp_path / "in")
    _write_ordered_files(src_dir, [[_event(i, "10.0.0.8") for i in range(6)]])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    ckpt = str(tmp_path / "ckpt")
    own = runner.stream_session(spark, 3)
    qs = runner.start_alert_queries(
        runner.text_file_source(own, src_dir), str(tmp_path / "alerts"), ckpt,
        trigger={"availableNow": True}, detectors={"brute_force": detect.brute_force_sliding})
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    runner.await_all(qs)
    offsets = open(os.path.join(ckpt, "brute_force", "offsets", "0"), encoding="utf-8").read()
    assert '"spark.sql.shuffle.partitions":"3"' in offsets


def test_run_id_belongs_to_the_checkpoint(spark, tmp_path):
    first = runner.run_id(spark, str(tmp_path / "a"))
    assert runner.run_id(spark, str(tmp_path / "a")) == first
    assert runner.run_id(spark, str(tmp_path / "b")) > first
