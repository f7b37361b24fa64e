"""Every registered query against its SQL oracle (the driver's check) on
the smallest driver tables."""

from contextlib import contextmanager

import pytest

import __spark_entry__ as E
from logsentinel.plans.catalog import REGISTRY
from logsentinel.plans.oracle import oracles
from tests.conftest import SF_SMALL
from tools.parity import compare, duck

NAMES = sorted(REGISTRY)


@contextmanager
def spark_conf(spark, key, value):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(oracles())
    assert set(REGISTRY) <= set(E.queries()) and set(oracles()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    assert r["status"] == "ok", r


@pytest.mark.parametrize("name", ["alert_sink_roundtrip", "alert_sink_runs", "all_alerts", "ip_lookup"])
def test_query_matches_oracle_on_a_table_of_many_files(spark, tmp_path_factory, name):
    sf_dir = str(tmp_path_factory.getbasetemp() / "many")
    if not (tmp_path_factory.getbasetemp() / "many").exists():
        # Longer than the watermark, so files out of order would lose windows.
        events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
        events.repartitionByRange(12, "event_id").write.parquet(f"{sf_dir}/events.parquet")
    with spark_conf(spark, "spark.sql.files.openCostInBytes", "128m"):  # a task per file
        r = compare(spark, name, sf_dir, duck(sf_dir))
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == [
        "source_ip", "window_start", "window_end", "count", "target_ip",
        "protocol", "alert_type", "severity", "threat_score",
    ]


def test_queries_are_safe_to_run_concurrently(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    names = ["ip_lookup", "threat_kpis", "alert_stats", "current_alerts", "threats_top", "profile_nulls"]
    q = E.queries()

    def run(name):
        return name, q[name](spark, SF_SMALL).count()

    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        first = dict(pool.map(run, names))
    second = dict(run(n) for n in names)
    assert first == second and all(v > 0 for v in first.values())
