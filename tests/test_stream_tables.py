"""The stream's further tables: port scans, dead letters, current alerts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from logsentinel.operators import batch, serve
from logsentinel.plans import catalog
from logsentinel.sources import adapters, manifest, readers
from logsentinel.streaming import current, runner
from tests.conftest import SF_MID, SF_SMALL, log_rows
from tests.test_streaming import _write_ordered_files


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- port scans ------------------------------------------------------------


def test_port_scan_of_a_stream_equals_the_batch_and_its_state_goes(spark, tmp_path):
    logs = adapters.load_log_view(spark, SF_MID)
    lines = [r.value for r in adapters.to_json_lines(logs.orderBy("event_id")).collect()]
    src_dir = str(tmp_path / "in")
    _write_ordered_files(src_dir, [*[lines[i : i + 2500] for i in range(0, len(lines), 2500)], [adapters.CLOSING_LINE]])
    query = runner.start_port_scan(
        runner.text_file_source(spark, src_dir, max_files_per_trigger=1), str(tmp_path / "out"), str(tmp_path / "ckpt"), {"availableNow": True})
    runner.await_all([query])
    want = batch.port_scan(logs)
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    got = spark.read.parquet(str(tmp_path / "out")).withColumns(times)
    assert _rows(got) == _rows(want) and want.count() > 3
    held = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress]
    dropped = sum(s["numRowsRemoved"] for p in query.recentProgress for s in p["stateOperators"])
    assert max(held) > 100 and held[-1] <= 2 and dropped >= max(held) - 2  # the closing event's state stays


@pytest.mark.parametrize("least", (1, 2))
def test_port_scan_forms_agree_on_edges(spark, least):
    """Null targets and addresses, repeats, window bounds."""
    rows = [dict(sec=s, source_ip=ip, dest_ip=d, protocol=p) for s in (0, 299.999, 300, 600) for ip in ("a", None)
            for d in ("x", "x", "y", None, f"z{s}") for p in ("TCP", "tcp", "TCP", None)]
    logs = log_rows(spark, rows)
    assert _rows(batch.port_scan_final(logs, min_targets=least)) == _rows(batch.port_scan(logs, min_targets=least)) != []


# ---- dead letters ----------------------------------------------------------

LINES = {
    '{"source_ip":"1.1.1.1","timestamp":"2024-01-01T00:00:00","bytes_transferred":7}': None,
    '{"source_ip":"1.1.1.2","timestamp":"2024-01-01T00:00:00","bytes_transferred":"many"}': None,
    '{"source_ip":"1.1.1.3","timestamp":"soon"}': None,
    '{"source_ip":"1.1.1.4","unknown":{"a":[1]}}': None,
    '{"source_ip":"1.1.1.5", "timestamp": "2024-01-': readers.NOT_A_RECORD,
    "plain text": readers.NOT_A_RECORD,
    "[1, 2]": readers.NOT_A_RECORD,
    "17": readers.NOT_A_RECORD,
    "{}": readers.NO_KNOWN_FIELD,
    '{"level":"info"}': readers.NO_KNOWN_FIELD,
    '{"source_ip":null}': readers.NO_KNOWN_FIELD,
    " \t": readers.BLANK,
    "": readers.BLANK,
}


def test_every_line_is_a_record_or_a_reject(spark):
    raw = spark.createDataFrame([(v,) for v in [*LINES, None]], "value string")
    out = readers.decode_log_json_checked(raw, watermark=None).collect()
    assert len(out) == len(LINES) + 1
    rejects = sorted((r.rejected_line, r.reject_reason) for r in out if r.reject_reason)
    assert rejects == sorted([*((v, why) for v, why in LINES.items() if why), ("", readers.BLANK)])
    records = {r.source_ip: r for r in out if not r.reject_reason}
    assert set(records) == {f"1.1.1.{i}" for i in range(1, 5)} and all(r.rejected_line is None for r in records.values())
    assert records["1.1.1.2"].bytes_transferred is None and records["1.1.1.3"].event_ts is None
    plain = readers.decode_log_json(raw, watermark=None).filter("source_ip IS NOT NULL").collect()
    assert sorted(r.source_ip for r in plain) == sorted(records)


def test_counts_in_progress_events_and_sink_agree(spark, tmp_path):
    src_dir = str(tmp_path / "in")
    lines = list(LINES) * 5
    _write_ordered_files(src_dir, [lines[:20], lines[20:]])
    src = runner.text_file_source(spark, src_dir, max_files_per_trigger=1)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    query = runner.start_checked_decode(src, out, ckpt, {"availableNow": True})
    runner.await_all([query])
    seen = [p["observedMetrics"]["decode"] for p in query.recentProgress if "decode" in p["observedMetrics"]]
    rejects = sum(v is not None for v in LINES.values()) * 5
    assert [sum(m[k] for m in seen) for k in ("lines", "records", "rejects")] == [len(lines), len(lines) - rejects, rejects]
    assert runner.read_records(spark, out).count() == len(lines) - rejects and runner.read_rejects(spark, out).count() == rejects
    assert {r.batch_id for r in runner.read_rejects(spark, out).collect()} == {0, 1}
    runner.await_all([runner.start_checked_decode(src, out, ckpt, {"availableNow": True})])  # a restart adds nothing
    assert runner.read_rejects(spark, out).count() == rejects


# ---- current alerts --------------------------------------------------------


def _emissions(spark, rows):
    """(address, window, count) rows of one batch."""
    return spark.createDataFrame(
        [(ip, w, w, n, "", "TCP", "VOLUME_ANOMALY", "HIGH", 70, "volume") for ip, w, n in rows],
        "source_ip string, window_start string, window_end string, count bigint, target_ip string, protocol string, alert_type string, "
        "severity string, threat_score bigint, label string")


def _buckets(spark, root):
    return current._latest(spark, root)[1].get("versions", {})


def test_table_equals_the_view_after_every_batch(spark, tmp_path):
    root = str(tmp_path / "current")
    assert current.read_current(spark, root).collect() == []
    batches = [
        ("0000000000001-a", 0, [("a", "w1", 3), ("b", "w1", 1), (None, "w1", 2)]), ("0000000000001-a", 1, [("a", "w1", 6), ("c", "w2", 1)]),
        ("0000000000001-a", 2, []), ("0000000000001-a", 1, [("a", "w1", 6), ("c", "w2", 1)]),  # nothing new; a replay
        ("0000000000002-b", 0, [("a", "w1", 4), (None, "w1", 5)]), ("0000000000001-a", 3, [("a", "w1", 99), ("d", "w3", 1)]),  # a late batch of the old run
    ]
    emitted = None
    for run, batch_id, rows in batches:
        before = _buckets(spark, root)
        df = _emissions(spark, rows)
        current.batch_merger(root, run, buckets=8)(df, batch_id)
        new = df.withColumn("run", F.lit(run)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        emitted = new if emitted is None else emitted.unionByName(new)
        got, want = current.read_current(spark, root), serve.current_alerts(emitted)
        assert _rows(got.select(want.columns)) == _rows(want)
        after = _buckets(spark, root)
        changed = {b for b in after if after[b] != before.get(b)}
        touched = {str(r[0]) for r in df.select(F.pmod(F.xxhash64(*current.KEY), F.lit(8)).cast("int")).distinct().collect()}
        assert changed == touched and len(touched) < 8
    assert {r.source_ip: r["count"] for r in current.read_current(spark, root).collect()} == {"a": 4, "b": 1, "c": 1, "d": 1, None: 5}
    folders = lambda: manifest.matching(spark, f"{root}/version=*/bucket=*")
    many, rows_before = len(folders()), _rows(current.read_current(spark, root))
    assert current.drop_old_versions(spark, root, keep=1) > 0
    assert len(folders()) == len(_buckets(spark, root)) < many and _rows(current.read_current(spark, root)) == rows_before


def test_an_unfinished_merge_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "current")
    merge = current.batch_merger(root, "0000000000001-a", "volume", buckets=4)
    merge(_emissions(spark, [("a", "w", 1)]).drop("label"), 0)
    put = manifest.put
    monkeypatch.setattr(manifest, "put", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        merge(_emissions(spark, [("a", "w", 2)]).drop("label"), 1)
    assert [r["count"] for r in current.read_current(spark, root).collect()] == [1]
    monkeypatch.setattr(manifest, "put", put)
    merge(_emissions(spark, [("a", "w", 2)]).drop("label"), 1)
    assert [r["count"] for r in current.read_current(spark, root).collect()] == [2]


def test_merger_as_the_sink_of_a_stream(spark, tmp_path):
    from logsentinel.operators import detect, panes

    logs = adapters.load_log_view(spark, SF_SMALL)
    lines = [r.value for r in adapters.to_json_lines(logs.orderBy("event_id")).collect()]
    src_dir, root = str(tmp_path / "in"), str(tmp_path / "current")
    _write_ordered_files(src_dir, [lines[:500], lines[500:]])
    query = runner.start_detector(
        runner.text_file_source(spark, src_dir, max_files_per_trigger=1), panes.stream_alerts, str(tmp_path / "ckpt"), "update",
        sink=current.batch_merger(root, "0000000000001-a", buckets=8), trigger={"availableNow": True})
    runner.await_all([query])
    want = detect.all_alerts(logs, with_label=True)
    assert _rows(current.read_current(spark, root).select(want.columns)) == _rows(want)


def test_manifests_are_written_whole(spark, tmp_path):
    path = str(tmp_path / "m" / "1.json")
    manifest.put(spark, path, json.dumps({"é": 1}))
    manifest.put(spark, path, json.dumps({"é": 2}))
    assert json.loads(manifest.get(spark, path)) == {"é": 2}
    assert [n for n in os.listdir(tmp_path / "m") if not n.startswith(".")] == ["1.json"]


# ---- the stream's files ----------------------------------------------------


def _events(spark, ids, path):
    rows = [(i, 7 * k, "error" if k % 3 else "view", float(k % 200), '{"k": %d}' % (k % 90)) for k, i in enumerate(ids)]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string, value double, props string").repartition(3).write.parquet(path)


def _lines_by_file(spark, sf_dir):
    """The times of each file's lines, in the order in which a stream takes the files."""
    root = catalog.stored_json_stream(spark, sf_dir)
    files = sorted((p for p in os.scandir(f"{root}/data") if p.name.endswith(".txt")), key=lambda p: p.stat().st_mtime_ns)
    return [[json.loads(line).get("timestamp") for line in open(p.path)] for p in files]


def test_files_of_a_period_hold_ranges_of_it(spark, tmp_path, monkeypatch):
    """Events of a window lie together, so partial sums shrink them before the
    shuffle; files and state partitions grow with the table."""
    _events(spark, [*range(3000), None, None], f"{tmp_path}/events.parquet")
    one = manifest.size(spark, f"{tmp_path}/events.parquet") // catalog.STREAM_PERIODS // 4
    assert catalog.state_partitions(spark, str(tmp_path)) == catalog.STATE_PARTITIONS
    monkeypatch.setattr(catalog, "STREAM_FILE_BYTES", one)
    files = _lines_by_file(spark, str(tmp_path))
    assert len(files) == 4 * catalog.STREAM_PERIODS and all(files)
    want = [r.timestamp for r in adapters.load_log_view(spark, str(tmp_path)).select("timestamp").collect()]
    assert sorted(map(str, want)) == sorted(str(t) for f in files for t in f)
    ranges = [(min(t), max(t)) for t in ([t for t in f if t] for f in files) if t]
    for k in range(0, len(files), 4):
        period = sorted(ranges[k : k + 4])
        assert all(a[1] <= b[0] for a, b in zip(period, period[1:]))
    assert max(r[1] for r in ranges[:4]) < min(r[0] for r in ranges[4:8]) and max(r[1] for r in ranges[4:8]) < min(r[0] for r in ranges[8:])
    monkeypatch.setattr(catalog, "STREAM_FILE_BYTES", one // 16)
    assert catalog.state_partitions(spark, str(tmp_path)) > catalog.STATE_PARTITIONS


def test_an_id_of_many_rows_is_spread_and_small_periods_keep_the_count(spark, tmp_path, monkeypatch):
    """A stream that takes a period's number of files at a time stays in step
    though a period has fewer events than files; no file holds all repeats."""
    _events(spark, [5] * 2000 + [None] * 1000 + [10**9], f"{tmp_path}/events.parquet")
    monkeypatch.setattr(catalog, "STREAM_FILE_BYTES", manifest.size(spark, f"{tmp_path}/events.parquet") // catalog.STREAM_PERIODS // 3)
    files = _lines_by_file(spark, str(tmp_path))
    assert len(files) == 3 * catalog.STREAM_PERIODS
    sizes = [len(f) for f in files]
    assert sum(sizes[:3]) == 3000 and max(sizes) < 2000 and sum(sizes[3:6]) == 0 and sum(sizes[6:]) == 1
