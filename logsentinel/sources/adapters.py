"""Adapter: the driver's ``events`` table → a LOG-shaped view.

The real event timestamps are too sparse for minute windows, so the view
spaces events 100 ms apart in ``event_id`` order and derives every LOG field
from the event's columns with cheap, deterministic rules.  It is a narrow
projection (no shuffle) and prunes ``events`` to the columns it uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsentinel.functions.expressions import ts_text

# ---------------------------------------------------------------------------
# Fixed values of the adapter rules (the oracle SQL uses the same ones).
# ---------------------------------------------------------------------------
EPOCH = "2024-01-01 00:00:00"
STEP_MS = 100
#: Events per block (five minutes).  Each block has its own addresses, so
#: their number grows with the table while each address has enough events
#: within a window to alert.
BLOCK = 3000
DEST_PREFIX = "198.18."
PROTOCOLS = ("HTTP", "TCP", "SSH", "HTTPS", "FTP")
PORTS = (8443, 2222, 5432, 9092, 1883)
LOG_TYPES = ("firewall", "ids", "application")
MALICIOUS_ABOVE = 150.0
SUSPICIOUS_ABOVE = 80.0
MALICIOUS_SPELLINGS = ("Malicious", "malicious", "MALICIOUS")
SUSPICIOUS_SPELLINGS = ("suspicious", "Suspicious")
BYTES_PER_VALUE = 50000
AGENT_NULL_EVERY = 97
# Request paths and agents, %s is the event id: plain ones, both attack
# families in several spellings, both at once, near misses of the rules, and
# quotes and commas for the CSV reader.
PATHS = (
    "/item?id=%s' or 'a'='a",
    "/report?y=%s UNION  SELECT name, pw FROM accounts",
    "/q?t=<ScRiPt>track(%s)</sCrIpT>",
    '/img?alt="a, b"&x=<svg onload=go(%s)>',
    "/doc/%s?title=union of selects",
    "/x?c=%s'--",
    None,
    "/note?m=it's %s or so",
    "/shop?cat=%s&sort=price,desc",
    "/a?j=JavaScript:void(%s)",
    "/both?id=%s or 1=1&z=<script>go()</script>",
    "/c?d=document.cookies-%s",
    "/y?k=%s' OR '1'='1",
    "/t?n=%s;DROP TABLE staff",
)
PATH_MODULUS = 41
DEFAULT_PATH = "/static/page-%s.html"
AGENTS = (
    "probe (sqlmap) build %s",
    "Nikto-like/%s",
    "scan nikto %s",
    'Agent "Q", v%s',
    "two\nlines %s",
)
AGENT_MODULUS = 23
DEFAULT_AGENT = "Mozilla/5.0 (rv:%s)"
BAD_TS_EVERY = 89
BAD_TS_TEXT = "not-a-timestamp"
#: In the raw CSV, every so many agents are one of the texts for missing.
MISSING_EVERY = 71
MISSING_TEXTS = ("NA", "N/A", "NaN", "null")


def _pick(values, index: Column) -> Column:
    """values[index] for a 0-based integer column (literal array lookup)."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (index + F.lit(1)).cast("int"))


def _filled(values, default: str, index: Column) -> Column:
    """The text at a 0-based index, or the default beyond, with the event id
    put in."""
    text = F.when(index < len(values), _pick(values, F.least(index, F.lit(len(values) - 1)))).otherwise(F.lit(default))
    return F.replace(text, F.lit("%s"), F.col("event_id").cast("string"))


def log_view(events: DataFrame) -> DataFrame:
    """``events(event_id, user_id, event_type, value, props)`` → LOG view.

    Columns: ``event_id, event_ts (timestamp_ntz), timestamp (text)`` and the
    ten LOG fields.  The source address is the block of the event and the
    user's place in it (odd users share five places, even ones fifteen, so
    some addresses are busier).  Labels come in several spellings, so folded
    and raw-case rules differ.
    """
    eid, uid, value = F.col("event_id"), F.col("user_id"), F.col("value")
    event_ts = F.expr(f"timestampadd(MILLISECOND, event_id * {STEP_MS}, TIMESTAMP_NTZ'{EPOCH}')")
    block = F.expr(f"event_id div {BLOCK}")
    host = F.when(uid % 2 == 1, uid % 10).otherwise(uid % 30)
    agent = F.when(eid % AGENT_NULL_EVERY == 0, F.lit(None).cast("string")).otherwise(
        _filled(AGENTS, DEFAULT_AGENT, (eid * 5 + uid) % AGENT_MODULUS)
    )
    return (
        events.select("event_id", "user_id", "event_type", "value", "props")
        .select(
            eid.alias("event_id"),
            event_ts.alias("event_ts"),
            F.concat_ws(
                ".", F.expr(f"10 + (event_id div {BLOCK}) div 65536"), F.expr(f"((event_id div {BLOCK}) div 256) % 256"), block % 256, host
            ).alias("source_ip"),
            F.concat(
                F.lit(DEST_PREFIX),
                (eid % 3).cast("string"),
                F.lit("."),
                F.get_json_object("props", "$.k"),
            ).alias("dest_ip"),
            _pick(PORTS, F.expr("(event_id div 5) % 5")).alias("dest_port"),
            _pick(PROTOCOLS, eid % len(PROTOCOLS)).alias("protocol"),
            F.when(F.col("event_type") == "error", F.lit("failed"))
            .when(F.col("event_type") == "signup", F.lit("blocked"))
            .otherwise(F.lit("allowed"))
            .alias("action"),
            F.when(value > MALICIOUS_ABOVE, _pick(MALICIOUS_SPELLINGS, eid % len(MALICIOUS_SPELLINGS)))
            .when(value > SUSPICIOUS_ABOVE, _pick(SUSPICIOUS_SPELLINGS, eid % len(SUSPICIOUS_SPELLINGS)))
            .otherwise(F.lit("benign"))
            .alias("threat_label"),
            _pick(LOG_TYPES, eid % len(LOG_TYPES)).alias("log_type"),
            F.round(value * BYTES_PER_VALUE).cast("bigint").alias("bytes_transferred"),
            agent.alias("user_agent"),
            _filled(PATHS, DEFAULT_PATH, (eid * 7 + uid) % PATH_MODULUS).alias("request_path"),
        )
        .withColumn("timestamp", ts_text("event_ts"))
    )


def load_log_view(spark, sf_dir: str) -> DataFrame:
    return log_view(spark.read.parquet(f"{sf_dir}/events.parquet"))


def with_dirty_timestamp(logs: DataFrame) -> DataFrame:
    """The raw-CSV shape: LOG columns, every 89th ``timestamp`` unparseable,
    every 71st agent a text that stands for a missing value."""
    from logsentinel.schema import LOG_COLUMNS

    eid = F.col("event_id")
    gone = _pick(MISSING_TEXTS, F.expr(f"(event_id div {MISSING_EVERY}) % {len(MISSING_TEXTS)}"))
    return logs.withColumn(
        "timestamp", F.when(eid % BAD_TS_EVERY == BAD_TS_EVERY - 1, F.lit(BAD_TS_TEXT)).otherwise(F.col("timestamp"))
    ).withColumn("user_agent", F.when(eid % MISSING_EVERY == 0, gone).otherwise(F.col("user_agent"))).select(*LOG_COLUMNS)


def failed_login_message(action: Column) -> Column:
    return F.when(action == "failed", F.lit("Failed login attempt")).otherwise(
        F.concat(F.lit("Connection "), action)
    )


def with_raw_text(logs: DataFrame) -> DataFrame:
    """Adds ``raw_log``: the event rendered as a compact JSON line with a
    free-text ``message`` (the shape the raw-text brute-force rule reads)."""
    raw = F.concat(
        F.lit('{"timestamp":"'),
        F.col("timestamp"),
        F.lit('","source_ip":"'),
        F.col("source_ip"),
        F.lit('","dest_ip":"'),
        F.col("dest_ip"),
        F.lit('","action":"'),
        F.col("action"),
        F.lit('","message":"'),
        failed_login_message(F.col("action")),
        F.lit('"}'),
    )
    return logs.withColumn("raw_log", raw)


def to_json_lines(logs: DataFrame) -> DataFrame:
    """LOG rows → one ``value`` JSON string each (the stream envelope)."""
    from logsentinel.schema import LOG_COLUMNS

    return logs.select(F.to_json(F.struct(*LOG_COLUMNS)).alias("value"))


#: Lines that are no log records, by event id: cut in the middle, blank, JSON
#: but not an object, an object without a known field.  The first that applies.
BAD_LINES = ((53, "cut"), (101, "blank"), (211, "list"), (307, "unknown"))
LIST_LINE = '["no", "record"]'
UNKNOWN_LINE = '{"level":"info"}'


def with_bad_lines(lines: DataFrame) -> DataFrame:
    """``(event_id, value)`` with every so many lines spoilt, by `BAD_LINES`."""
    spoilt = {"cut": F.expr("substring(value, 1, length(value) div 2)"), "blank": F.lit("  "), "list": F.lit(LIST_LINE), "unknown": F.lit(UNKNOWN_LINE)}
    value = None
    for every, kind in BAD_LINES:
        hit = F.pmod(F.col("event_id"), F.lit(every)) == every - 1
        value = F.when(hit, spoilt[kind]) if value is None else value.when(hit, spoilt[kind])
    return lines.withColumn("value", value.otherwise(F.col("value")))


#: A last event, of no one and long after all others, that lets the watermark
#: of a bounded stream pass every window.
CLOSING_LINE = '{"timestamp":"2999-01-01T00:00:00","protocol":"TCP","action":"allowed","threat_label":"benign","bytes_transferred":0}'
