"""Schemas of the log records, alerts and result tables."""

from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# One network / application event as it arrives on the stream (JSON) or in a
# raw CSV export.  Every field is nullable; `timestamp` is text until parsed.
LOG = StructType(
    [
        StructField("timestamp", StringType(), True),
        StructField("source_ip", StringType(), True),
        StructField("dest_ip", StringType(), True),
        StructField("dest_port", IntegerType(), True),
        StructField("protocol", StringType(), True),
        StructField("action", StringType(), True),
        StructField("threat_label", StringType(), True),
        StructField("log_type", StringType(), True),
        StructField("bytes_transferred", LongType(), True),
        StructField("user_agent", StringType(), True),
        StructField("request_path", StringType(), True),
    ]
)

LOG_COLUMNS = [f.name for f in LOG.fields]

# One detection alert, as emitted by the windowed detectors and stored by the
# alert sink.  Window bounds are kept as text, like the stored alert lines.
ALERT = StructType(
    [
        StructField("source_ip", StringType(), True),
        StructField("window_start", StringType(), True),
        StructField("window_end", StringType(), True),
        StructField("count", LongType(), True),
        StructField("target_ip", StringType(), True),
        StructField("protocol", StringType(), True),
        StructField("alert_type", StringType(), True),
        StructField("severity", StringType(), True),
        StructField("threat_score", LongType(), True),
    ]
)

ALERT_COLUMNS = [f.name for f in ALERT.fields]

CORRUPT_RECORD = "_corrupt_record"

ALERT_WITH_CORRUPT = StructType(
    ALERT.fields + [StructField(CORRUPT_RECORD, StringType(), True)]
)

TOP_IP_COLUMNS = [
    "source_ip",
    "threat_count",
    "malicious_count",
    "suspicious_count",
    "total_bytes",
]

PORT_SCAN_COLUMNS = [
    "source_ip",
    "window_start",
    "window_end",
    "distinct_targets",
    "connection_count",
]

BYTES_BY_LABEL_COLUMNS = [
    "threat_label",
    "event_count",
    "total_bytes",
    "avg_bytes",
    "min_bytes",
    "max_bytes",
]

ATTACK_COUNT_COLUMNS = ["attack_type", "count"]

# Names of the persisted batch result tables (one directory each).
RESULT_TABLES = (
    "top_malicious_ips",
    "port_scan_detection",
    "sqli_xss_detection",
    "bytes_volume_by_threat_label",
)
