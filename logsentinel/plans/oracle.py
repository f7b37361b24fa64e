"""Independent SQL oracles (DuckDB dialect) for the registered queries.

Each string is self-contained: it rebuilds the log view from the ``events``
view with the adapter's rules and then states the operator in plain SQL.
Sliding windows are written as a UNION ALL of the two window offsets;
``sum`` is cast back to BIGINT (DuckDB widens it).
"""

from __future__ import annotations

from logsentinel import rules
from logsentinel.sources import adapters as A
from logsentinel.sources import readers as R
from logsentinel.sources.sinks import BATCH_RUN

#: The span that the rollup queries ask for.
SPAN = ("2024-01-01 00:00:20", "2024-01-01 00:15:50")
#: The clock reading that the queries pass for stored and detected times.
CLOCK = "2024-06-01 12:00:00"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in values) + "]"


def _case(values, default: str, index: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {'NULL' if p is None else q(p)}" for i, p in enumerate(values))
    return f"replace(CASE {index} {whens} ELSE {q(default)} END, '%s', CAST(event_id AS VARCHAR))"


LOGS = f"""
logs0 AS (
  SELECT
    event_id,
    TIMESTAMP {q(A.EPOCH)} + to_milliseconds(event_id * {A.STEP_MS}) AS event_ts,
    concat_ws('.', 10 + (event_id // {A.BLOCK}) // 65536, ((event_id // {A.BLOCK}) // 256) % 256,
      (event_id // {A.BLOCK}) % 256, CASE WHEN user_id % 2 = 1 THEN user_id % 10 ELSE user_id % 30 END) AS source_ip,
    {q(A.DEST_PREFIX)} || CAST(event_id % 3 AS VARCHAR) || '.'
      || json_extract_string(props, '$.k') AS dest_ip,
    {_list(A.PORTS)}[(event_id // 5) % 5 + 1] AS dest_port,
    {_list(A.PROTOCOLS)}[event_id % {len(A.PROTOCOLS)} + 1] AS protocol,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'blocked'
      ELSE 'allowed' END AS action,
    CASE WHEN value > {A.MALICIOUS_ABOVE} THEN {_list(A.MALICIOUS_SPELLINGS)}[event_id % {len(A.MALICIOUS_SPELLINGS)} + 1]
      WHEN value > {A.SUSPICIOUS_ABOVE} THEN {_list(A.SUSPICIOUS_SPELLINGS)}[event_id % {len(A.SUSPICIOUS_SPELLINGS)} + 1]
      ELSE 'benign' END AS threat_label,
    {_list(A.LOG_TYPES)}[event_id % {len(A.LOG_TYPES)} + 1] AS log_type,
    CAST(round(value * {A.BYTES_PER_VALUE}) AS BIGINT) AS bytes_transferred,
    CASE WHEN event_id % {A.AGENT_NULL_EVERY} = 0 THEN NULL
      ELSE {_case(A.AGENTS, A.DEFAULT_AGENT, f"(event_id * 5 + user_id) % {A.AGENT_MODULUS}")} END AS user_agent,
    {_case(A.PATHS, A.DEFAULT_PATH, f"(event_id * 7 + user_id) % {A.PATH_MODULUS}")} AS request_path
  FROM events
),
logs AS (
  SELECT *, strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp" FROM logs0
)"""

LOG_COLS = (
    '"timestamp", source_ip, dest_ip, dest_port, protocol, action, threat_label, '
    "log_type, bytes_transferred, user_agent, request_path"
)
WTEXT = "'%Y-%m-%d %H:%M:%S'"
END_1M = "strftime(ws + INTERVAL '1 minute', '%Y-%m-%d %H:%M:%S')"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join([LOGS, *ctes]) + "\n"


def sliding(src: str, name: str, size_s: int, slide_s: int) -> str:
    """CTE ``name``: every row of ``src`` once per sliding window holding it
    (``ws`` = window start), for size = 2 × slide."""
    assert size_s == 2 * slide_s
    b = f"time_bucket(INTERVAL '{slide_s} seconds', event_ts)"
    return (
        f"{name} AS (SELECT *, {b} AS ws FROM {src} UNION ALL "
        f"SELECT *, {b} - INTERVAL '{slide_s} seconds' AS ws FROM {src})"
    )


def tumbling(src: str, name: str, size_s: int) -> str:
    return f"{name} AS (SELECT *, time_bucket(INTERVAL '{size_s} seconds', event_ts) AS ws FROM {src})"


def wtext(expr: str) -> str:
    return f"strftime({expr}, {WTEXT})"


# --------------------------------------------------------------------------
# CTE bodies reused by several oracles
# --------------------------------------------------------------------------

TOP = f"""top AS (
  SELECT source_ip, count(*) AS threat_count,
    count(*) FILTER (WHERE lower(threat_label) = 'malicious') AS malicious_count,
    count(*) FILTER (WHERE lower(threat_label) = 'suspicious') AS suspicious_count,
    CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes
  FROM logs WHERE lower(threat_label) IN ('malicious', 'suspicious')
  GROUP BY source_ip ORDER BY threat_count DESC, source_ip LIMIT 10)"""

BYTES = """bytes AS (
  SELECT lower(threat_label) AS threat_label, count(*) AS event_count,
    CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes,
    avg(bytes_transferred) AS avg_bytes,
    min(bytes_transferred) AS min_bytes, max(bytes_transferred) AS max_bytes
  FROM logs GROUP BY 1)"""

SQLIXSS = f"""sx0 AS (
  SELECT
    count(*) FILTER (WHERE regexp_matches(lower(request_path), {q(rules.BATCH_SQLI_PATTERN)})) AS sqli,
    count(*) FILTER (WHERE regexp_matches(lower(request_path), {q(rules.BATCH_XSS_PATTERN)})) AS xss
  FROM logs),
sqlixss AS (
  SELECT 'SQLi' AS attack_type, sqli AS "count" FROM sx0
  UNION ALL SELECT 'XSS' AS attack_type, xss AS "count" FROM sx0)"""

PORTSCAN = f"""ps0 AS (SELECT * FROM logs WHERE protocol = 'TCP'),
{tumbling('ps0', 'ps1', 300)},
portscan AS (
  SELECT source_ip, ws AS window_start, ws + INTERVAL '5 minutes' AS window_end,
    count(DISTINCT dest_ip) AS distinct_targets, count(*) AS connection_count
  FROM ps1 GROUP BY source_ip, ws HAVING count(DISTINCT dest_ip) > 20)"""

BRUTE = f"""bf0 AS (SELECT * FROM logs WHERE action = 'failed'
  AND protocol IN ('SSH', 'HTTP', 'HTTPS', 'FTP')),
{sliding('bf0', 'bf1', 60, 30)},
brute AS (
  SELECT source_ip, {wtext('ws')} AS window_start,
    {wtext("ws + INTERVAL '1 minute'")} AS window_end,
    count(*) AS "count", arg_min(dest_ip, event_ts) AS target_ip,
    arg_min(protocol, event_ts) AS protocol, 'BRUTE_FORCE' AS alert_type,
    'HIGH' AS severity, count(*) * 10 AS threat_score
  FROM bf1 GROUP BY source_ip, ws HAVING count(*) >= 5)"""

SQLI_S, XSS_S = q(rules.STREAM_SQLI_PATTERN), q(rules.STREAM_XSS_PATTERN)
TAGGED = f"""tag0 AS (
  SELECT *,
    (regexp_matches(request_path, {SQLI_S}) OR regexp_matches(user_agent, {SQLI_S})) AS is_sqli,
    (regexp_matches(request_path, {XSS_S}) OR regexp_matches(user_agent, {XSS_S})) AS is_xss
  FROM logs),
tagged AS (
  SELECT *, CASE WHEN is_sqli THEN 'SQLi' ELSE 'XSS' END AS attack_type
  FROM tag0 WHERE is_sqli OR is_xss)"""

SIGS = f"""{TAGGED},
{sliding('tagged', 'sg1', 60, 30)},
sigs AS (
  SELECT source_ip, {wtext('ws')} AS window_start,
    {wtext("ws + INTERVAL '1 minute'")} AS window_end,
    count(*) AS "count", '' AS target_ip, 'HTTP' AS protocol,
    attack_type AS alert_type, 'CRITICAL' AS severity, CAST(90 AS BIGINT) AS threat_score
  FROM sg1 GROUP BY source_ip, ws, attack_type)"""

VOLUME = f"""{sliding('logs', 'vl1', 10, 5)},
volume AS (
  SELECT source_ip, {wtext('ws')} AS window_start,
    {wtext("ws + INTERVAL '10 seconds'")} AS window_end,
    count(*) AS "count", '' AS target_ip, 'TCP' AS protocol,
    'VOLUME_ANOMALY' AS alert_type, 'HIGH' AS severity, CAST(70 AS BIGINT) AS threat_score
  FROM vl1 GROUP BY source_ip, ws HAVING sum(bytes_transferred) > {rules.VOLUME_BYTES_THRESHOLD})"""

ALERTS = f"""{BRUTE},
{SIGS},
{VOLUME},
alerts AS (
  SELECT *, 'brute_force' AS label FROM brute
  UNION ALL SELECT *, 'sqli_xss' AS label FROM sigs
  UNION ALL SELECT *, 'volume' AS label FROM volume)"""

ALERT_COLS = (
    'source_ip, window_start, window_end, "count", target_ip, protocol, alert_type, '
    "severity, threat_score"
)


def _score_sql(src: str) -> str:
    base = (
        "CASE WHEN mx = mn THEN 75 ELSE CAST(trunc(50.0 + "
        "(CAST(threat_count - mn AS DOUBLE) / CAST(mx - mn AS DOUBLE)) * 49.0) AS INTEGER) END"
    )
    return f"""rep0 AS (
  SELECT t.*, mm.mn, mm.mx FROM {src} t,
    (SELECT min(threat_count) AS mn, max(threat_count) AS mx FROM {src}) mm),
rep1 AS (SELECT *, {base} AS base FROM rep0),
rep AS (
  SELECT *, CASE WHEN CAST(malicious_count AS DOUBLE) / greatest(threat_count, 1) > 0.3
    THEN least(99, base + 10) ELSE base END AS score FROM rep1),
rep_l AS (
  SELECT *, CASE WHEN score >= 85 THEN 'CRITICAL' WHEN score >= 65 THEN 'HIGH'
    WHEN score >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS level FROM rep)"""


def oracles() -> dict[str, str]:
    o: dict[str, str] = {}

    # ---- batch detections -------------------------------------------------
    o["top_malicious_ips"] = with_(TOP) + "SELECT * FROM top"
    o["batch_results_roundtrip"] = o["top_malicious_ips"]
    o["port_scan"] = with_(PORTSCAN) + "SELECT * FROM portscan"
    o["sqli_xss_totals"] = with_(SQLIXSS) + "SELECT * FROM sqlixss"
    o["sqli_events"] = with_() + (
        f"SELECT *, 'SQLi' AS attack_type FROM logs "
        f"WHERE regexp_matches(lower(request_path), {q(rules.BATCH_SQLI_PATTERN)})"
    )
    o["xss_events"] = with_() + (
        f"SELECT *, 'XSS' AS attack_type FROM logs "
        f"WHERE regexp_matches(lower(request_path), {q(rules.BATCH_XSS_PATTERN)})"
    )
    o["bytes_by_threat_label"] = with_(BYTES) + "SELECT * FROM bytes"

    # ---- speed-layer detections in batch form ------------------------------
    o["brute_force_sliding"] = with_(BRUTE) + "SELECT * FROM brute"
    raw = (
        "raw AS (SELECT event_ts, '{\"timestamp\":\"' || \"timestamp\" || "
        "'\",\"source_ip\":\"' || source_ip || '\",\"dest_ip\":\"' || dest_ip || "
        "'\",\"action\":\"' || action || '\",\"message\":\"' || "
        "CASE WHEN action = 'failed' THEN 'Failed login attempt' "
        "ELSE 'Connection ' || action END || '\"}' AS raw_log FROM logs)"
    )
    o["brute_force_text"] = with_(
        raw,
        f"""rw1 AS (SELECT *, regexp_extract(raw_log, {q(rules.RAW_SOURCE_IP_PATTERN)}, 1) AS source_ip
          FROM raw WHERE contains(lower(raw_log), 'failed login'))""",
        tumbling("rw1", "rw2", 60),
    ) + (
        f"SELECT {wtext('ws')} AS window_start, {END_1M}"
        " AS window_end, source_ip, count(*) AS \"count\" FROM rw2 "
        "GROUP BY ws, source_ip HAVING count(*) >= 5"
    )
    o["brute_force_tumbling"] = with_(
        "bt0 AS (SELECT * FROM logs WHERE action = 'blocked')", tumbling("bt0", "bt1", 60)
    ) + (
        "SELECT source_ip, ws AS window_start, ws + INTERVAL '1 minute' AS window_end, "
        "count(*) AS failed_attempts, 'BRUTE_FORCE' AS threat_type, "
        f"TIMESTAMP {q(CLOCK)} AS detected_at FROM bt1 "
        "GROUP BY source_ip, ws HAVING count(*) > 5"
    )
    o["attack_signatures_sliding"] = with_(SIGS) + "SELECT * FROM sigs"
    o["attack_tagging"] = with_(TAGGED) + (
        'SELECT event_id, "timestamp", source_ip, request_path, user_agent, is_sqli, is_xss, '
        "attack_type FROM tagged"
    )
    o["signature_match"] = with_() + (
        "SELECT \"timestamp\", source_ip, request_path, user_agent, "
        "'SIGNATURE_ATTACK' AS threat_type FROM logs WHERE "
        + " OR ".join(
            [f"contains(request_path, {q(s)})" for s in rules.SIGNATURE_PATH_LITERALS]
            + [f"contains(user_agent, {q(s)})" for s in rules.SIGNATURE_AGENT_LITERALS]
        )
    )
    o["volume_sliding"] = with_(VOLUME) + "SELECT * FROM volume"
    o["volume_tumbling"] = with_(tumbling("logs", "vt1", 10)) + (
        "SELECT source_ip, ws AS window_start, ws + INTERVAL '10 seconds' AS window_end, "
        "CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes, 'ABNORMAL_VOLUME' AS threat_type "
        f"FROM vt1 GROUP BY source_ip, ws HAVING sum(bytes_transferred) > {rules.VOLUME_BYTES_THRESHOLD}"
    )
    o["threat_score_by_ip"] = with_() + (
        "SELECT source_ip, CAST(sum(CASE WHEN threat_label = 'malicious' THEN 10 "
        "WHEN threat_label = 'suspicious' THEN 5 ELSE 0 END) AS BIGINT) AS total_threat_score "
        "FROM logs GROUP BY source_ip"
    )
    o["threat_store"] = with_() + (
        'SELECT source_ip AS ip_source, "timestamp" AS last_seen, threat_label AS attack_type, '
        f"TIMESTAMP {q(CLOCK)} AS stored_at "
        "FROM logs WHERE threat_label IN ('malicious', 'suspicious')"
    )
    o["threat_store_sink_roundtrip"] = with_() + (
        'SELECT source_ip AS ip_source, "timestamp" AS last_seen, threat_label AS attack_type '
        "FROM logs WHERE threat_label IN ('malicious', 'suspicious')"
    )
    o["all_alerts"] = with_(ALERTS) + f"SELECT {ALERT_COLS} FROM alerts"

    # ---- sources and sinks --------------------------------------------------
    o["alerts_scan"] = with_(ALERTS) + f"SELECT {ALERT_COLS}, label, {q(BATCH_RUN)} AS run, CAST(0 AS BIGINT) AS batch_id FROM alerts"
    o["alert_sink_roundtrip"] = with_(ALERTS) + f"SELECT {ALERT_COLS}, label FROM alerts"
    o["alert_sink_runs"] = with_(ALERTS) + (
        'SELECT label, CAST(run_number AS INTEGER) AS run_number, count(*) AS windows, true AS emitted_again '
        "FROM alerts, (VALUES (1), (2)) r(run_number) GROUP BY label, run_number"
    )
    o["log_json_decode"] = with_() + (
        f'SELECT {LOG_COLS}, CAST("timestamp" AS TIMESTAMP) AS event_ts FROM logs'
    )

    # ---- normalisation and profiling (over the raw CSV export) -------------
    raw = (
        f"raw AS (SELECT CASE WHEN event_id % {A.BAD_TS_EVERY} = {A.BAD_TS_EVERY - 1} "
        f"THEN {q(A.BAD_TS_TEXT)} ELSE \"timestamp\" END AS \"timestamp\", "
        "source_ip, dest_ip, dest_port, protocol, action, threat_label, log_type, "
        f"bytes_transferred, CASE WHEN event_id % {A.MISSING_EVERY} = 0 THEN NULL ELSE user_agent END AS user_agent, "
        "request_path FROM logs)"
    )
    raw_cols = [c.strip().strip('"') for c in LOG_COLS.split(",")]
    o["normalize_logs"] = with_(raw) + (
        'SELECT TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp", '
        + ", ".join(raw_cols[1:])
        + " FROM raw"
    )
    o["profile_shape"] = with_(raw) + (
        f"SELECT count(*) AS row_count, {len(raw_cols)} AS column_count FROM raw"
    )
    whole, number = q("^[+-]?[0-9]{1,18}$"), q("^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$")
    o["profile_types"] = with_(raw) + " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, {q(c)} AS column_name, CASE "
        f"WHEN count(*) > 0 AND count(*) FILTER (WHERE regexp_matches(CAST(\"{c}\" AS VARCHAR), {whole})) = count(*) THEN 'bigint' "
        f"WHEN count(*) FILTER (WHERE regexp_matches(CAST(\"{c}\" AS VARCHAR), {number})) = count(\"{c}\") THEN 'double' "
        f"WHEN count(*) FILTER (WHERE CAST(\"{c}\" AS VARCHAR) IN ('True', 'False')) = count(*) THEN 'boolean' "
        "ELSE 'string' END AS data_type FROM raw"
        for i, c in enumerate(raw_cols)
    )
    o["profile_nulls"] = with_(raw) + " UNION ALL ".join(
        f"SELECT {q(c)} AS column_name, count(*) FILTER (WHERE \"{c}\" IS NULL) AS null_count FROM raw"
        for c in raw_cols
    )
    o["profile_duplicates"] = with_(
        raw, f"g AS (SELECT count(*) AS n FROM raw GROUP BY {LOG_COLS})"
    ) + (
        "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows, "
        "count(*) AS distinct_rows FROM g"
    )
    o["profile_sample"] = with_(raw) + 'SELECT * FROM raw ORDER BY "timestamp", source_ip LIMIT 5'

    # ---- serving over the stored result tables ------------------------------
    rep_cols = (
        "threat_count, malicious_count, suspicious_count, total_bytes"
    )
    o["ip_reputation"] = with_(TOP, _score_sql("top")) + (
        f"SELECT source_ip, {rep_cols}, score AS reputation_score, level AS threat_level FROM rep_l"
    )
    o["threats_top"] = with_(TOP, _score_sql("top")) + (
        f"SELECT source_ip AS ip, {rep_cols}, score, level AS threat_level FROM rep_l"
    )
    o["ip_lookup"] = with_(
        TOP,
        _score_sql("top"),
        ALERTS,
        "req AS (SELECT DISTINCT source_ip AS ip FROM logs)",
        "ac AS (SELECT source_ip AS ip, count(*) AS active_alerts, "
        "max(threat_score) AS max_alert_score FROM alerts GROUP BY 1)",
    ) + (
        "SELECT req.ip, r.threat_count, r.malicious_count, r.suspicious_count, r.total_bytes, "
        "r.score AS reputation_score, r.level AS threat_level, "
        "CASE WHEN r.score IS NOT NULL THEN 'threat' ELSE 'clean' END AS status, "
        "CASE WHEN r.score IS NULL THEN NULL WHEN r.score >= 75 THEN 'BLOCK' "
        "ELSE 'MONITOR' END AS action, coalesce(ac.active_alerts, 0) AS active_alerts, "
        "ac.max_alert_score FROM req LEFT JOIN rep_l r ON r.source_ip = req.ip "
        "LEFT JOIN ac ON ac.ip = req.ip"
    )
    o["threats_port_scans"] = with_(PORTSCAN) + (
        f"SELECT source_ip AS ip, {wtext('window_start')} AS window_start, "
        f"{wtext('window_end')} AS window_end, distinct_targets, connection_count FROM portscan"
    )
    o["threats_bytes"] = with_(BYTES) + (
        "SELECT threat_label, event_count, total_bytes, round(avg_bytes, 2) AS avg_bytes, "
        "min_bytes, max_bytes FROM bytes"
    )
    o["threats_sqli_xss"] = with_(SQLIXSS) + 'SELECT attack_type, "count" FROM sqlixss'

    def scalar(sql: str) -> str:
        return f"CAST(coalesce(({sql}), 0) AS BIGINT)"

    def attack(t: str) -> str:
        return scalar(f"SELECT sum(\"count\") FROM sqlixss WHERE attack_type = {q(t)}")

    def label(t: str) -> str:
        return scalar(f"SELECT sum(event_count) FROM bytes WHERE threat_label = {q(t)}")

    def is_type(t: str) -> str:
        return f"alert_type = {q(t)}"

    def alert_sum(cond: str) -> str:
        return scalar(f'SELECT sum("count") FROM alerts WHERE {cond}')

    o["threat_kpis"] = with_(SQLIXSS, BYTES, TOP) + (
        f"SELECT {attack('SQLi')} AS sqli_count, {attack('XSS')} AS xss_count, "
        f"{label('malicious')} AS malicious_events, {label('suspicious')} AS suspicious_events, "
        f"{label('benign')} AS benign_events, {scalar('SELECT count(*) FROM top')} AS top_ip_count"
    )
    o["result_table_stats"] = with_(TOP, PORTSCAN, SQLIXSS, BYTES, ALERTS) + " UNION ALL ".join(
        f"SELECT {q(name)} AS table_name, true AS available, count(*) AS row_count, CAST(NULL AS VARCHAR) AS error FROM {src}"
        for name, src in (
            ("top_malicious_ips", "top"),
            ("port_scan_detection", "portscan"),
            ("sqli_xss_detection", "sqlixss"),
            ("bytes_volume_by_threat_label", "bytes"),
            ("brute_force_alerts", "alerts"),
        )
    )
    o["dashboard_panels"] = with_(TOP, SQLIXSS, BYTES, ALERTS) + (
        f"SELECT {scalar('SELECT count(*) FROM top')} AS top_ip_count, "
        f"{attack('SQLi')} AS sqli_detections, {attack('XSS')} AS xss_detections, "
        f"{label('malicious')} AS malicious_events, {label('benign')} AS benign_events, "
        f"{label('suspicious')} AS suspicious_events, {alert_sum('true')} AS alert_event_total, "
        f"{alert_sum(is_type('BRUTE_FORCE'))} AS brute_force_alert_events, "
        f"{alert_sum(is_type('XSS'))} AS xss_alert_events, "
        f"{alert_sum(is_type('SQLi'))} AS sqli_alert_events"
    )
    ranks = " ".join(f"WHEN {q(l)} THEN {i}" for i, l in enumerate(rules.LABEL_SERIES_ORDER))
    o["dashboard_bytes_series"] = with_(BYTES) + (
        f"SELECT CASE threat_label {ranks} END AS series_rank, threat_label, "
        "upper(substr(threat_label, 1, 1)) || substr(threat_label, 2) AS display_label, "
        "total_bytes, event_count, round(avg_bytes, 2) AS avg_bytes FROM bytes "
        f"WHERE threat_label IN ({', '.join(q(l) for l in rules.LABEL_SERIES_ORDER)})"
    )

    def number_text(n: str) -> str:
        steps = " ".join(f"WHEN {n} >= {v} THEN printf('%.1f{t}', {n} / {v}.0)" for v, t in ((10**9, "B"), (10**6, "M"), (10**3, "K")))
        return f"CASE {steps} ELSE CAST({n} AS VARCHAR) END"

    o["dashboard_numbers"] = with_(BYTES) + (
        f"SELECT threat_label, {number_text('event_count')} AS events_text, {number_text('total_bytes')} AS bytes_text FROM bytes"
    )

    # ---- checked decode, maintained and compacted tables, rollups -----------
    cases = " ".join(
        f"WHEN event_id % {every} = {every - 1} THEN {q(kind)}" for every, kind in A.BAD_LINES
    )
    spoilt = f"""kinds AS (SELECT *, CASE {cases} ELSE 'record' END AS kind FROM logs)"""
    fields = ", ".join(
        f"CASE WHEN {c.strip()} IS NULL THEN NULL ELSE '\"{c.strip().strip(chr(34))}\":' || "
        + (c.strip() if c.strip() in ("dest_port", "bytes_transferred") else f"CAST(to_json({c.strip()}) AS VARCHAR)") + " END"
        for c in LOG_COLS.split(",")
    )
    text = "'{' || concat_ws(',', " + fields + ") || '}'"
    o["log_rejects"] = with_(spoilt, f"lines AS (SELECT kind, {text} AS value FROM kinds WHERE kind <> 'record')") + (
        f"SELECT CASE kind WHEN 'cut' THEN substr(value, 1, length(value) // 2) WHEN 'blank' THEN '  ' WHEN 'list' THEN {q(A.LIST_LINE)} "
        f"ELSE {q(A.UNKNOWN_LINE)} END AS rejected_line, CASE kind WHEN 'blank' THEN {q(R.BLANK)} WHEN 'unknown' THEN {q(R.NO_KNOWN_FIELD)} "
        f"ELSE {q(R.NOT_A_RECORD)} END AS reject_reason FROM lines"
    )
    good, bad = "count(*) FILTER (WHERE kind = 'record')", "count(*) FILTER (WHERE kind <> 'record')"
    o["log_decode_counts"] = with_(spoilt) + (
        f"SELECT count(*) AS lines_in, {good} AS records, {bad} AS rejects, count(*) AS lines_observed, {good} AS records_observed, "
        f"{bad} AS rejects_observed, CAST(0 AS BIGINT) AS records_without_time FROM kinds"
    )
    o["port_scan_stream"] = o["port_scan"]
    o["current_alerts_table"] = o["alert_sink_roundtrip"]
    o["alerts_scan_compacted"] = with_(ALERTS) + (
        f"SELECT {ALERT_COLS}, label, {q(BATCH_RUN)} AS run, CAST(CASE label WHEN 'volume' THEN 1 ELSE 0 END AS BIGINT) AS batch_id FROM alerts"
    )
    span = f"event_ts >= TIMESTAMP {q(SPAN[0])} AND event_ts < TIMESTAMP {q(SPAN[1])}"
    cut = LOGS.replace("FROM logs0\n)", f"FROM logs0 WHERE {span}\n)")
    assert cut != LOGS
    o["span_top_malicious_ips"] = f"WITH {cut},\n{TOP}\nSELECT * FROM top"
    o["span_sqli_xss_totals"] = f"WITH {cut},\n{SQLIXSS}\nSELECT * FROM sqlixss"
    o["span_bytes_by_threat_label"] = f"WITH {cut},\n{BYTES}\nSELECT * FROM bytes"
    o["ip_lookup_clustered"] = o["ip_lookup"]
    nulls = " UNION ALL ".join(
        f"SELECT {q(c)} AS name, count(*) FILTER (WHERE \"{c}\" IS NULL) AS null_count, count(*) AS row_count FROM raw" for c in raw_cols
    )
    types = o["profile_types"][len(with_(raw)):]
    o["normalize_profile"] = with_(raw, f"t AS ({types})", f"n AS ({nulls})") + (
        "SELECT position, column_name, data_type, null_count, row_count FROM t JOIN n ON name = column_name"
    )
    o["normalize_mixed_layouts"] = with_() + (
        f"SELECT CAST(\"timestamp\" AS TIMESTAMP) AS \"timestamp\", {', '.join(c for c in raw_cols[1:] if c != 'dest_port')}, "
        "CASE WHEN event_id % 2 = 0 THEN dest_port END AS dest_port FROM logs"
    )

    # ---- serving over the alert table ------------------------------------------
    o["alert_feed"] = with_(ALERTS) + (
        'SELECT source_ip, window_start, window_end, "count", target_ip, protocol, alert_type, '
        "severity, coalesce(threat_score, 0) AS threat_score FROM alerts"
    )
    distinct_ips = (
        "count(DISTINCT source_ip) + max(CASE WHEN source_ip IS NULL THEN 1 ELSE 0 END)"
    )
    o["alert_summary"] = with_(ALERTS) + (
        f"SELECT count(*) AS total, coalesce({distinct_ips}, 0) AS unique_ips FROM alerts"
    )
    o["alert_counts_by_type"] = with_(ALERTS) + (
        "SELECT coalesce(alert_type, 'UNKNOWN') AS alert_type, count(*) AS \"count\" "
        "FROM alerts GROUP BY 1"
    )
    o["alert_stats"] = with_(ALERTS) + (
        "SELECT count(*) AS total_alerts, "
        "count(*) FILTER (WHERE alert_type = 'BRUTE_FORCE') AS brute_force_count, "
        "count(*) FILTER (WHERE alert_type IN ('SQLi', 'XSS')) AS sqli_xss_count, "
        "count(*) FILTER (WHERE alert_type = 'VOLUME_ANOMALY') AS volume_anomaly_count, "
        "count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_count, "
        f"coalesce({distinct_ips}, 0) AS unique_attacker_ips, "
        "(SELECT source_ip FROM alerts ORDER BY coalesce(threat_score, 0) DESC, "
        "source_ip ASC LIMIT 1) AS top_attacker FROM alerts"
    )
    o["current_alerts"] = with_(ALERTS) + (
        f"SELECT {ALERT_COLS}, label, {q(BATCH_RUN)} AS run, CAST(0 AS BIGINT) AS batch_id FROM alerts"
    )
    return o
