import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("logsentinel-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def log_rows(spark, rows):
    """Hand-made LOG rows.  Each row is a dict; ``sec`` (float seconds after
    T0) sets ``event_ts`` and the ``timestamp`` text; defaults fill the rest."""
    from pyspark.sql import functions as F

    defaults = dict(
        source_ip="10.0.0.1",
        dest_ip="172.16.0.1",
        dest_port=22,
        protocol="SSH",
        action="allowed",
        threat_label="benign",
        log_type="ids",
        bytes_transferred=100,
        user_agent="Mozilla/5.0",
        request_path="/index.html",
    )
    data = []
    for i, r in enumerate(rows):
        d = {**defaults, **r}
        ts = T0 + dt.timedelta(seconds=d.pop("sec", i))
        d["event_id"] = d.get("event_id", i)
        d["event_ts"] = ts
        d["timestamp"] = ts.strftime("%Y-%m-%dT%H:%M:%S.%f")
        data.append(d)
    schema = (
        "event_id bigint, event_ts timestamp_ntz, timestamp string, source_ip string, "
        "dest_ip string, dest_port int, protocol string, action string, threat_label string, "
        "log_type string, bytes_transferred bigint, user_agent string, request_path string"
    )
    cols = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(d[c] for c in cols) for d in data], schema).select(
        *[F.col(c) for c in cols]
    )
