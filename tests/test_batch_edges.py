"""Hand-made rows for the batch-layer rules and the profiler."""

from logsentinel.operators import batch, profile
from tests.conftest import log_rows


def test_top_ips_case_folds_and_breaks_ties_by_ip(spark):
    rows = []
    for i in range(12):  # 12 IPs with 2 threats each: a tie across rank 10
        rows += [dict(source_ip=f"10.0.0.{i:02d}", threat_label="Malicious", bytes_transferred=5),
                 dict(source_ip=f"10.0.0.{i:02d}", threat_label="SUSPICIOUS", bytes_transferred=7)]
    rows += [dict(source_ip="10.0.0.99", threat_label="benign")] * 5
    out = batch.top_malicious_ips(log_rows(spark, rows)).collect()
    assert [r.source_ip for r in out] == [f"10.0.0.{i:02d}" for i in range(10)]
    r = out[0]
    assert (r.threat_count, r.malicious_count, r.suspicious_count, r.total_bytes) == (2, 1, 1, 12)


def test_port_scan_threshold_is_strict(spark):
    rows = [dict(source_ip="s20", protocol="TCP", dest_ip=f"d{i}", sec=i) for i in range(20)]
    rows += [dict(source_ip="s21", protocol="TCP", dest_ip=f"d{i}", sec=i) for i in range(21)]
    rows += [dict(source_ip="s21", protocol="TCP", dest_ip="d0", sec=30)]  # repeat target
    rows += [dict(source_ip="u", protocol="tcp", dest_ip=f"d{i}", sec=i) for i in range(30)]  # case
    out = batch.port_scan(log_rows(spark, rows)).collect()
    assert [(r.source_ip, r.distinct_targets, r.connection_count) for r in out] == [("s21", 21, 22)]


def test_sqli_xss_totals_always_two_rows_and_overlap_counts_twice(spark):
    none = batch.sqli_xss_totals(log_rows(spark, [dict(request_path="/ok")])).collect()
    assert sorted((r.attack_type, r["count"]) for r in none) == [("SQLi", 0), ("XSS", 0)]
    rows = [dict(request_path="/a?q=1 UNION SELECT x <SCRIPT>"), dict(request_path=None),
            dict(request_path="/b?q=--")]
    out = {r.attack_type: r["count"] for r in batch.sqli_xss_totals(log_rows(spark, rows)).collect()}
    assert out == {"SQLi": 2, "XSS": 1}


def test_bytes_by_label_null_label_is_a_group(spark):
    rows = [dict(threat_label="Benign", bytes_transferred=10), dict(threat_label="benign", bytes_transferred=30),
            dict(threat_label=None, bytes_transferred=5)]
    out = {r.threat_label: r for r in batch.bytes_by_threat_label(log_rows(spark, rows)).collect()}
    assert set(out) == {"benign", None}
    b = out["benign"]
    assert (b.event_count, b.total_bytes, b.avg_bytes, b.min_bytes, b.max_bytes) == (2, 40, 20.0, 10, 30)


def test_profile_duplicates_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x"), (2, "y")], "a int, b string")
    r = profile.profile_duplicates(df).collect()[0]
    assert (r.duplicate_rows, r.distinct_rows) == (2, 3)
    assert profile.profile_duplicates(df, ["a"]).collect()[0].duplicate_rows == 3


def test_profile_nulls_and_shape(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert {r.column_name: r.null_count for r in profile.profile_nulls(df).collect()} == {"a": 1, "b": 2}
    r = profile.profile_shape(df).collect()[0]
    assert (r.row_count, r.column_count) == (2, 2)


def test_profile_types_come_from_the_data(spark):
    rows = [("1", "1", "1.5", "True", "x", None, "7"), ("-2", None, "2e3", "False", "3", None, "x")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g string")
    got = [(r.position, r.column_name, r.data_type) for r in profile.profile_types(df).collect()]
    kinds = ["bigint", "double", "double", "boolean", "string", "double", "string"]
    assert got == [(i, c, k) for i, (c, k) in enumerate(zip("abcdefg", kinds))]


def test_normalize_bad_and_null_timestamps(spark):
    df = spark.createDataFrame(
        [("2026-05-22T12:03:00.123456",), ("2026-05-19 20:07",), ("nope",), (None,)], "timestamp string"
    )
    out = [r.timestamp for r in profile.normalize_logs(df).collect()]
    assert out[0].microsecond == 123456 and out[1].minute == 7
    assert out[2] is None and out[3] is None


def test_one_pass_summary_gives_the_same_results(spark, tmp_path):
    from tests.conftest import SF_SMALL
    from logsentinel.sources import adapters

    lv = adapters.load_log_view(spark, SF_SMALL)
    p = str(tmp_path / "summary")
    batch.batch_summary(lv).write.parquet(p)
    s = spark.read.parquet(p)
    for standalone, derived in (
        (batch.top_malicious_ips(lv), batch.top_malicious_ips_from_summary(s)),
        (batch.sqli_xss_totals(lv), batch.sqli_xss_totals_from_summary(s)),
        (batch.bytes_by_threat_label(lv), batch.bytes_by_threat_label_from_summary(s)),
    ):
        assert derived.dtypes == standalone.dtypes
        assert sorted(map(tuple, derived.collect())) == sorted(map(tuple, standalone.collect()))


def test_one_pass_summary_edges(spark):
    rows = [dict(source_ip="a", threat_label="Malicious", bytes_transferred=5, request_path="/x?<script>"),
            dict(source_ip="a", threat_label="benign", bytes_transferred=7),
            dict(source_ip=None, threat_label=None, bytes_transferred=None)]
    s = batch.batch_summary(log_rows(spark, rows))
    top = batch.top_malicious_ips_from_summary(s).collect()
    assert [(r.source_ip, r.threat_count, r.total_bytes) for r in top] == [("a", 1, 5)]
    labels = {r.threat_label: r.event_count for r in batch.bytes_by_threat_label_from_summary(s).collect()}
    assert labels == {"malicious": 1, "benign": 1, None: 1}
    assert {r.attack_type: r["count"] for r in batch.sqli_xss_totals_from_summary(s).collect()} == {
        "SQLi": 0, "XSS": 1}
    empty = batch.sqli_xss_totals_from_summary(batch.batch_summary(log_rows(spark, rows).limit(0)))
    assert sorted((r.attack_type, r["count"]) for r in empty.collect()) == [("SQLi", 0), ("XSS", 0)]


def test_csv_round_trip_keeps_commas_and_quotes(spark, tmp_path):
    from logsentinel.sources import readers
    from logsentinel.schema import LOG_COLUMNS

    rows = [dict(request_path='/s?q=a,b"c\'d', user_agent='Mozilla/5.0 (X11; Linux, "x")'),
            dict(request_path=None, user_agent=None)]
    df = log_rows(spark, rows).select(*LOG_COLUMNS)
    p = str(tmp_path / "raw.csv")
    df.write.option("header", "true").option("escape", '"').csv(p)
    back = readers.read_log_csv(spark, p)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    norm = profile.normalize_logs(back).collect()
    assert all(r.timestamp is not None for r in norm)


def test_a_period_reads_its_days_only(spark, tmp_path):
    from logsentinel.schema import LOG_COLUMNS
    from logsentinel.sources import readers

    rows = [dict(sec=s, threat_label="malicious") for s in (0, 3600, 86_400, 90_000, 3 * 86_400)]
    src, out = str(tmp_path / "raw"), str(tmp_path / "logs")
    log_rows(spark, rows).select(*LOG_COLUMNS).write.option("header", "true").csv(src)
    assert profile.normalize_csv_to_parquet(spark, src, out).columns == LOG_COLUMNS
    logs = readers.read_logs(spark, out)
    got = batch.in_period(logs, "2024-01-01 00:30:00", "2024-01-02 01:00:00")
    assert sorted(str(r.timestamp) for r in got.collect()) == ["2024-01-01 01:00:00", "2024-01-02 00:00:00"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "log_date" in filters and ">=" in filters and "<=" in filters
    assert batch.top_malicious_ips(got).first().threat_count == 2
    assert batch.in_period(logs).count() == 5
