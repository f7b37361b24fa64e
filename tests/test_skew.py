"""One source IP holding a third of all rows: results stay whole and equal
a brute-force computation; the plans combine rows map-side first."""

import datetime as dt

import pandas as pd
import pytest

from logsentinel.operators import batch, detect, profile
from tests.conftest import log_rows


@pytest.fixture(scope="module")
def skewed(spark):
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        rows.append(dict(
            event_id=i,
            source_ip="6.6.6.6" if hot else f"10.0.{i % 7}.{i % 11}",
            dest_ip=f"172.16.0.{i % 40}",
            action="failed" if i % 4 else "allowed",
            protocol=("SSH", "TCP", "HTTP")[i % 3 if not hot else 0],
            threat_label=("malicious", "suspicious", "benign")[i % 3 if not hot else i % 2],
            bytes_transferred=1000 + i,
            sec=i * 0.7,
        ))
    return rows


def test_skewed_brute_force_matches_brute_force(spark, skewed):
    got = {(r.source_ip, r.window_start): r["count"]
           for r in detect.brute_force_sliding(log_rows(spark, skewed)).collect()}
    pdf = pd.DataFrame(skewed)
    pdf = pdf[(pdf.action == "failed") & pdf.protocol.isin(["SSH", "HTTP", "HTTPS", "FTP"])]
    want = {}
    t0 = dt.datetime(2024, 1, 1)
    for _, r in pdf.iterrows():
        pane = int(r.sec // 30) * 30
        for start in (pane, pane - 30):
            key = (r.source_ip, (t0 + dt.timedelta(seconds=start)).strftime("%Y-%m-%d %H:%M:%S"))
            want[key] = want.get(key, 0) + 1
    want = {k: v for k, v in want.items() if v >= 5}
    assert got == want
    assert sum(v for (ip, _), v in got.items() if ip == "6.6.6.6") > 0


def test_skewed_top_ips_and_duplicates(spark, skewed):
    df = log_rows(spark, skewed)
    top = batch.top_malicious_ips(df).collect()
    pdf = pd.DataFrame(skewed)
    threats = pdf[pdf.threat_label.isin(["malicious", "suspicious"])]
    assert top[0].source_ip == "6.6.6.6"
    assert top[0].threat_count == int((threats.source_ip == "6.6.6.6").sum())
    # a third of the rows are copies of one row on the projected columns
    dup = profile.profile_duplicates(df.select("source_ip", "protocol", "threat_label")).collect()[0]
    proj = pdf[["source_ip", "protocol", "threat_label"]]
    assert dup.duplicate_rows == int(proj.duplicated().sum())


def test_hot_key_plans_aggregate_before_the_shuffle(spark, skewed):
    df = log_rows(spark, skewed)
    for out in (batch.top_malicious_ips(df), detect.volume_sliding(df), detect.threat_score_by_ip(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        first_exchange = plan.rindex("Exchange hashpartitioning")
        # the text after the last hash exchange is its child: a partial aggregate
        assert "partial_" in plan[first_exchange:]
