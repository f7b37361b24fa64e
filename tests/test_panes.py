"""The detectors from one pass: same rows as each detector alone, one scan,
and on a stream the same emissions from one decode."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from logsentinel.operators import detect, panes
from logsentinel.schema import ALERT_COLUMNS
from logsentinel.sources import adapters, readers
from logsentinel.streaming import runner
from tests.conftest import SF_MID, SF_SMALL, log_rows
from tests.test_streaming import _event, _write_ordered_files


def _bag(df, *more):
    return collections.Counter(tuple(r[c] for c in (*ALERT_COLUMNS, "label", *more)) for r in df.collect())


def _one_by_one(logs):
    out = None
    for label, detector in detect.ALERT_DETECTORS.items():
        part = detector(logs).withColumn("label", F.lit(label))
        out = part if out is None else out.unionByName(part)
    return out


@pytest.mark.parametrize("sf", (SF_SMALL, SF_MID))
def test_same_alerts_as_the_detectors_alone(spark, sf):
    logs = adapters.load_log_view(spark, sf)
    assert _bag(detect.all_alerts(logs, with_label=True)) == _bag(_one_by_one(logs))


@pytest.mark.parametrize("seed", range(4))
def test_random_edges(spark, seed):
    """Nulls, window bounds hit exactly, ties for the first target, rows that
    match both families, volumes just at and above the limit."""
    rng = random.Random(seed)
    rows = [
        dict(
            sec=rng.choice([0, 4.999999, 5, 9.5, 25, 29.999, 30, 31, 55, 59.999999, 60, 90, 301]) + rng.choice([0, 0, 120]),
            source_ip=rng.choice(["a", "b", None]), action=rng.choice(["failed", "failed", "failed", "allowed", None]),
            protocol=rng.choice(["SSH", "HTTP", "TCP", None]), dest_ip=rng.choice(["x", "y", None]),
            bytes_transferred=rng.choice([None, 0, 10 * 1024 * 1024, 10 * 1024 * 1024 + 1, 6_000_000, 7]),
            request_path=rng.choice([None, "/a", "/?q=union select", "/<script>x", "/<script>or 1=1"]),
            user_agent=rng.choice([None, "sqlmap", "Mozilla"]),
        )
        for _ in range(120)
    ]
    logs = log_rows(spark, rows)
    logs = logs.unionByName(logs.limit(3).withColumn("event_ts", F.lit(None).cast("timestamp_ntz")))
    got = _bag(detect.all_alerts(logs, with_label=True))
    assert got == _bag(_one_by_one(logs)) and got
    # The sliding form of the stream gives the same sums.
    assert _bag(panes.alerts(panes.sliding_sums(logs))) == got


def test_empty_log(spark):
    assert detect.all_alerts(log_rows(spark, [{}]).limit(0)).collect() == []


def test_one_scan_and_no_raw_row_is_doubled(spark):
    logs = adapters.load_log_view(spark, SF_SMALL)
    plan = detect.all_alerts(logs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    raw = plan[plan.rindex("HashAggregate"):]  # children follow their parent
    assert "Expand" in plan and "Expand" not in raw and "SortAggregate" not in raw
    volume = detect.volume_sliding(logs)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in volume and "Expand" not in volume[volume.rindex("HashAggregate"):]


def _plan_of(query) -> str:
    return query._jsq.query().toString() if not hasattr(query._jsq, "explainInternal") else query._jsq.explainInternal(False)


def test_stream_decodes_each_line_once_and_emits_the_same(spark, tmp_path):
    """Micro-batch by micro-batch, the one query emits what the three do."""
    logs = adapters.load_log_view(spark, SF_SMALL)
    lines = [r.value for r in adapters.to_json_lines(logs.orderBy("event_id")).collect()]
    src_dir = str(tmp_path / "in")
    _write_ordered_files(src_dir, [lines[i : i + 300] for i in range(0, len(lines), 300)])
    found = {}
    for union in (False, True):
        src = runner.text_file_source(spark, src_dir, max_files_per_trigger=1)
        out = str(tmp_path / f"alerts{union}")
        queries = runner.start_alert_queries(src, out, str(tmp_path / f"ckpt{union}"), {"availableNow": True}, union=union)
        runner.await_all(queries)
        found[union] = _bag(readers.read_alerts(spark, out), "batch_id")
    assert found[True] == found[False] and len({k[-1] for k in found[True]}) > 2
    plan = _plan_of(queries[0])
    assert plan.count("from_json") == 1 and plan.count("StateStoreSave") == 1


def test_final_alerts_come_once_and_state_goes(spark, tmp_path):
    """Append mode over chained aggregates: every window once, after the
    watermark; a last far event closes them all and the state is evicted."""
    logs = adapters.load_log_view(spark, SF_SMALL)
    lines = [r.value for r in adapters.to_json_lines(logs.orderBy("event_id")).collect()]
    src_dir = str(tmp_path / "in")
    _write_ordered_files(src_dir, [lines[:500], lines[500:], [_event(10**6, "closing", "allowed", "TCP")]])
    out = str(tmp_path / "alerts")
    (query,) = runner.start_alert_queries(
        runner.text_file_source(spark, src_dir, max_files_per_trigger=1), out, str(tmp_path / "ckpt"),
        {"availableNow": True}, union=True, final=True)
    runner.await_all([query])
    assert _bag(readers.read_alerts(spark, out)) == _bag(detect.all_alerts(logs, with_label=True))
    plan = _plan_of(query)
    assert plan.count("from_json") == 1 and plan.count("StateStoreSave") == 2
    last = query.lastProgress["stateOperators"]
    assert all(s["numRowsTotal"] <= 2 for s in last)  # only the closing event's
