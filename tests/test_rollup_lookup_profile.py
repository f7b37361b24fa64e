"""Stored rollups, the lookup layout, the profile on the way, mixed CSV
layouts and what the sinks print."""

import os

import pytest
from pyspark.sql import functions as F

from logsentinel import jobs
from logsentinel.operators import batch, profile, rollup
from logsentinel.schema import LOG_COLUMNS
from logsentinel.sources import adapters, readers, sinks
from tests.conftest import SF_MID, SF_SMALL


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- rollups ---------------------------------------------------------------

SPANS = [  # whole periods; an edge at each end; within one period; across a bound; empty; beyond the data
    ("2024-01-01 00:05:00", "2024-01-01 00:15:00"), ("2024-01-01 00:01:10", "2024-01-01 00:13:50"), ("2024-01-01 00:06:00", "2024-01-01 00:07:00"),
    ("2024-01-01 00:04:00", "2024-01-01 00:06:00"), ("2024-01-01 00:05:00", "2024-01-01 00:05:00"), ("2023-12-31 00:00:00", "2024-01-02 00:00:00"),
]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rollup") / "r")
    logs = adapters.load_log_view(spark, SF_MID)
    for until in ("2024-01-01 00:07:00", "2024-01-01 00:07:00", "2024-01-01 01:00:00"):  # in steps, one of them repeated
        rollup.extend(spark, logs, path, until, 300, "event_ts")
    return logs, path


@pytest.mark.parametrize("start,end", SPANS)
def test_span_equals_the_direct_queries(spark, stored, start, end):
    logs, path = stored
    summary = rollup.span_summary(spark.read.parquet(path), logs, start, end, 300, "event_ts").persist()
    direct = batch.in_period(logs, start, end, "event_ts")
    for name in ("top_malicious_ips", "sqli_xss_totals", "bytes_by_threat_label"):
        assert _rows(getattr(batch, f"{name}_from_summary")(summary)) == _rows(getattr(batch, name)(direct)), name
    summary.unpersist()


def test_whole_periods_read_no_log(spark, stored):
    _, path = stored
    summary = rollup.span_summary(spark.read.parquet(path), None, *SPANS[0], 300, "event_ts")
    assert batch.bytes_by_threat_label_from_summary(summary).count() == 3
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(at" in plan
    assert len([d for d in os.listdir(path) if d.startswith("at=")]) == 4
    with pytest.raises(ValueError, match="whole period"):
        rollup.span_summary(spark.read.parquet(path), None, *SPANS[1], 300, "event_ts")


def test_rollup_and_span_jobs(spark, tmp_path, capsys):
    logs = adapters.load_log_view(spark, SF_MID).withColumn("timestamp", F.col("event_ts")).drop("event_ts")
    logs.write.parquet(str(tmp_path / "logs"))
    common = ["--rollup", str(tmp_path / "r"), "--logs", str(tmp_path / "logs"), "--seconds", "300"]
    jobs.main(["rollup", *common, "--until", "2024-01-01 01:00:00"])
    jobs.main(["span", *common, "--start", "2024-01-01 00:01:00", "--end", "2024-01-01 00:10:00"])
    out = capsys.readouterr().out
    assert "# top malicious addresses" in out and '"attack_type":"SQLi"' in out and '"threat_label":"benign"' in out


# ---- lookup layout ---------------------------------------------------------


def _scanned(df) -> int:
    """Rows that the scans of an executed query gave."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") and "Adaptive" in plan.getClass().getName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_skips_row_groups(spark, tmp_path):
    n = 60_000
    table = spark.range(n).select(F.format_string("10.%d.%d.%d", F.col("id") % 7, F.col("id") % 251, F.col("id") % 199).alias("source_ip"),
                                  F.md5(F.col("id").cast("string")).alias("rest"))
    path, plain = str(tmp_path / "lookup"), str(tmp_path / "plain")
    sinks.write_lookup(table, path, group_bytes=1 << 16, keys=2000)
    table.repartition(8).write.option("parquet.block.size", str(1 << 16)).parquet(plain)
    ip = "10.4.46.7"  # row 12,345
    one = spark.read.parquet(path).filter(F.col("source_ip") == ip)
    assert _rows(one) == _rows(table.filter(F.col("source_ip") == ip)) != []
    assert _scanned(spark.read.parquet(path).filter(F.col("source_ip") == ip)) < n / 10
    assert _scanned(spark.read.parquet(plain).filter(F.col("source_ip") == ip)) == n  # unsorted: ranges and dictionaries rule nothing out
    # An address inside a row group's range but not in the table: the filter's work.
    absent = spark.read.parquet(path).filter(F.col("source_ip") == "10.4.46.7x")
    assert absent.count() == 0 and _scanned(spark.read.parquet(path).filter(F.col("source_ip") == "10.4.46.7x")) == 0


# ---- N1 with N2-N4 ---------------------------------------------------------


def test_profile_on_the_way_equals_the_profiles(spark, tmp_path):
    csv = str(tmp_path / "csv")
    adapters.with_dirty_timestamp(adapters.load_log_view(spark, SF_SMALL)).write.option("header", "true").option("escape", '"').csv(csv)
    got = profile.normalize_and_profile(spark, csv, str(tmp_path / "out")).collect()
    raw, typed = readers.read_raw_csv(spark, csv), readers.read_log_csv(spark, csv)
    assert sorted(((r.position, r.column_name, r.data_type) for r in got), key=repr) == _rows(profile.profile_types(raw))
    assert {r.column_name: r.null_count for r in got} == {r.column_name: r.null_count for r in profile.profile_nulls(typed).collect()}
    assert {r.row_count for r in got} == {profile.profile_shape(typed).first().row_count} and len(got) == len(LOG_COLUMNS)
    want = profile.normalize_csv_to_parquet(spark, csv, str(tmp_path / "plain"))
    assert _rows(spark.read.parquet(str(tmp_path / "out")).select(want.columns)) == _rows(want)


# ---- S1 --------------------------------------------------------------------

HEADER = "timestamp,source_ip,dest_ip,dest_port,protocol,action,threat_label,log_type,bytes_transferred,user_agent,request_path"


def _folder(tmp_path, files):
    folder = tmp_path / "mixed"
    os.makedirs(folder)
    for name, text in files.items():
        (folder / name).write_text(text)
    return str(folder)


def test_files_are_read_by_their_own_header(spark, tmp_path):
    folder = _folder(tmp_path, {
        "a.csv": f"{HEADER}\n2024-01-01,1.1.1.1,2.2.2.2,22,SSH,failed,benign,ids,5,agent,/a\n",
        "b.csv": "request_path,user_agent,bytes_transferred,log_type,threat_label,action,protocol,dest_ip,source_ip,timestamp\n"
                 '"/b,\nc",NA,6,ids,malicious,failed,SSH,2.2.2.2,1.1.1.2,2024-01-02\n',
        "c.csv": "", "d.csv": HEADER + "\n", "_SUCCESS": "", ".hidden.csv": "x,y\n1,2\n",
    })
    got = {r.source_ip: r for r in readers.read_log_csv(spark, folder).collect()}
    assert set(got) == {"1.1.1.1", "1.1.1.2"}
    assert (got["1.1.1.1"].protocol, got["1.1.1.1"].dest_port, got["1.1.1.1"].bytes_transferred) == ("SSH", 22, 5)
    b = got["1.1.1.2"]
    assert (b.protocol, b.action, b.threat_label, b.bytes_transferred, b.dest_port, b.request_path, b.user_agent) == (
        "SSH", "failed", "malicious", 6, None, "/b,\nc", None)
    assert sorted(readers.read_raw_csv(spark, folder).columns) == sorted(LOG_COLUMNS)


def test_one_file_of_another_layout_fails(spark, tmp_path):
    folder = _folder(tmp_path, {"a.csv": HEADER + "\n", "b.csv": HEADER + ",extra\n" + "x," * 11 + "x\n"})
    with pytest.raises(ValueError, match="extra"):
        readers.read_log_csv(spark, folder)


def test_single_lines_are_split_and_normalised(spark, tmp_path, capsys):
    rows = "".join(f"2024-01-01 00:00:{i % 60:02d},1.1.1.{i % 9},2.2.2.2,22,SSH,failed,benign,ids,{i},agent,/a\n" for i in range(4000))
    folder = _folder(tmp_path, {"a.csv": f"{HEADER}\n{rows}"})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        tasks = {m: readers.read_log_csv(spark, folder, multi_line=m).select(F.spark_partition_id()).distinct().count() for m in (True, False)}
        assert tasks[True] == 1 and tasks[False] > 3
        jobs.main(["normalize", "--csv", folder, "--out", str(tmp_path / "out"), "--single-line", "--profile"])
        assert '"null_count":0,"row_count":4000' in capsys.readouterr().out
        jobs.main(["profile", "--csv", folder, "--single-line"])
        assert '"row_count":4000' in capsys.readouterr().out
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4000


# ---- K2 --------------------------------------------------------------------


def test_preview_prints_the_rows_whole(spark, capsys):
    sinks.preview(spark.createDataFrame([(f"r{i}", "long " * 20) for i in range(3)], "name string, text string").orderBy("name"), 2)
    lines = capsys.readouterr().out.splitlines()
    text = "long " * 20
    assert [line for line in lines if line.startswith("|")] == [f"|name|text{' ' * 96}|", f"|r0  |{text}|", f"|r1  |{text}|"]
    assert lines[-2:] == ["only showing top 2 rows", ""] or "only showing top 2 rows" in lines[-1]


def test_console_prints_every_batch(tmp_path):
    """In a process of its own: the console is the JVM's."""
    import subprocess
    import sys

    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "x.txt").write_text("hello " * 30 + "\nsecond row\n")
    script = (
        "from logsentinel.session import build_session\nfrom logsentinel.sources import sinks\n"
        "spark = build_session('local[1]', 1)\n"
        f"q = sinks.start_console(spark.readStream.text('{tmp_path}/in'), 'append', {{'availableNow': True}}, '{tmp_path}/ck')\n"
        "q.awaitTermination()\nassert q.exception() is None\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True, timeout=300, check=True).stdout
    rows = [line.strip("|").rstrip() for line in out.splitlines() if line.startswith("|")]
    assert "Batch: 0" in out and rows == ["value", ("hello " * 30).rstrip(), "second row"]
