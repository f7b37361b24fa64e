"""Detection rules: patterns, label values, thresholds and windows.

Each detector takes these as keyword arguments; the defaults below are the
rule presets of the original batch and speed layers.  The contradictory
thresholds of the three brute-force rules are kept as separate presets on
purpose (>= 5 failed, > 5 blocked, >= 5 text lines).
"""

# ---------------------------------------------------------------------------
# Patterns, literals, labels and thresholds that must equal the
# original rules for the results to match.
# ---------------------------------------------------------------------------

# Batch SQL-injection / XSS rules, applied to lower(request_path).
BATCH_SQLI_PATTERN = r"('.*or.*=)|(or 1=1)|(union select)|(drop table)|(--)"
BATCH_XSS_PATTERN = (
    r"(<script)|(</script>)|(onerror=)|(alert\()|(img src)|(javascript:)|(onload=)"
)

# Streaming SQL-injection / XSS rules, applied to request_path and user_agent.
STREAM_SQLI_PATTERN = (
    r"(?i)(union\s+select|or\s+1=1|'\s*--|\bsqlmap\b|select\s+\*\s+from|drop\s+table)"
)
STREAM_XSS_PATTERN = (
    r"(?i)(<script|javascript:|onerror=|onload=|alert\s*\(|document\.cookie)"
)

# Literal (case-sensitive) signature rule.
SIGNATURE_PATH_LITERALS = ("' OR '1'='1", "<script>")
SIGNATURE_AGENT_LITERALS = ("sqlmap", "nikto")

# Raw-text brute-force rule: substring of the lower-cased line, and the IP
# pattern taken from the JSON text.
FAILED_LOGIN_TEXT = "failed login"
RAW_SOURCE_IP_PATTERN = r'"source_ip":"(\d+\.\d+\.\d+\.\d+)"'

# Label values and their per-event scores.
MALICIOUS = "malicious"
SUSPICIOUS = "suspicious"
BENIGN = "benign"
LABEL_SCORES = ((MALICIOUS, 10), (SUSPICIOUS, 5))

BRUTE_FORCE_PROTOCOLS = ("SSH", "HTTP", "HTTPS", "FTP")

# Volume threshold: 10 MiB.
VOLUME_BYTES_THRESHOLD = 10 * 1024 * 1024

# Alert constants.
BRUTE_FORCE = "BRUTE_FORCE"
SQLI = "SQLi"
XSS = "XSS"
VOLUME_ANOMALY = "VOLUME_ANOMALY"
ABNORMAL_VOLUME = "ABNORMAL_VOLUME"
SIGNATURE_ATTACK = "SIGNATURE_ATTACK"
HIGH = "HIGH"
CRITICAL = "CRITICAL"
BRUTE_FORCE_SCORE_PER_EVENT = 10
SIGNATURE_ALERT_SCORE = 90
VOLUME_ALERT_SCORE = 70

# Reputation score: min-max scaled into [50, 99], 75 when all counts are
# equal, +10 (capped at 99) when the malicious share exceeds 0.3.
SCORE_FLOOR = 50
SCORE_SPAN = 49
SCORE_WHEN_FLAT = 75
SCORE_BONUS = 10
SCORE_CAP = 99
MALICIOUS_RATIO_BONUS = 0.3
BLOCK_AT_SCORE = 75

# Threat level cut-offs, highest first.
THREAT_LEVELS = ((85, "CRITICAL"), (65, "HIGH"), (40, "MEDIUM"))
LOWEST_THREAT_LEVEL = "LOW"

# Event-time watermark used by every windowed streaming detector.
DEFAULT_WATERMARK = "2 minutes"

# Dashboard chart order of the label series.
LABEL_SERIES_ORDER = (MALICIOUS, SUSPICIOUS, BENIGN)
