"""Property tests: windowed detectors against a plain-Python brute force on
random event sets (boundary timestamps and fractional seconds included)."""

import datetime as dt
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from logsentinel.operators import detect
from tests.conftest import T0, log_rows

EVENT = st.fixed_dictionaries({
    "source_ip": st.sampled_from(["a", "b", "c"]),
    "action": st.sampled_from(["failed", "blocked", "allowed"]),
    "protocol": st.sampled_from(["SSH", "TCP", "HTTP"]),
    # whole seconds hit window boundaries often; tenths fall in between
    "sec": st.one_of(st.integers(0, 240).map(float), st.integers(0, 2400).map(lambda t: t / 10)),
    "bytes_transferred": st.integers(0, 6_000_000),
})
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


def _text(start_s: float) -> str:
    return (T0 + dt.timedelta(seconds=start_s)).strftime("%Y-%m-%d %H:%M:%S")


def _sliding(sec: float, size: int, slide: int):
    pane = int(sec // slide) * slide
    return [pane - k * slide for k in range(size // slide) if pane - k * slide + size > sec]


@SETTINGS
@given(st.lists(EVENT, min_size=1, max_size=60))
def test_brute_force_sliding_matches_brute_force(spark, events):
    got = {(r.source_ip, r.window_start): r["count"]
           for r in detect.brute_force_sliding(log_rows(spark, events)).collect()}
    counts = Counter()
    for e in events:
        if e["action"] == "failed" and e["protocol"] in ("SSH", "HTTP", "HTTPS", "FTP"):
            for start in _sliding(e["sec"], 60, 30):
                counts[(e["source_ip"], _text(start))] += 1
    assert got == {k: v for k, v in counts.items() if v >= 5}


@SETTINGS
@given(st.lists(EVENT, min_size=1, max_size=60))
def test_tumbling_and_volume_match_brute_force(spark, events):
    df = log_rows(spark, events)
    got_bf = {(r.source_ip, r.window_start.strftime("%Y-%m-%d %H:%M:%S")): r.failed_attempts
              for r in detect.brute_force_tumbling(df).collect()}
    blocked = Counter((e["source_ip"], _text(int(e["sec"] // 60) * 60))
                      for e in events if e["action"] == "blocked")
    assert got_bf == {k: v for k, v in blocked.items() if v > 5}

    got_vol = {(r.source_ip, r.window_start): (r["count"], r.threat_score)
               for r in detect.volume_sliding(df).collect()}
    sums, cnts = defaultdict(int), Counter()
    for e in events:
        for start in _sliding(e["sec"], 10, 5):
            key = (e["source_ip"], _text(start))
            sums[key] += e["bytes_transferred"]
            cnts[key] += 1
    assert got_vol == {k: (cnts[k], 70) for k, v in sums.items() if v > 10 * 1024 * 1024}


FRAGMENTS = ["/q?id=1", " UNION  select ", "or 1=1", "' --", "sqlmap", "select * from", "DROP\tTABLE",
             "<SCRIPT>", "javascript:", "onerror=", "onload=", "alert (", "document.cookie", "x", " ", "--"]
TEXT = st.one_of(st.none(), st.lists(st.sampled_from(FRAGMENTS), max_size=4).map("".join))


def _or3(a, b):
    if a is True or b is True:
        return True
    if a is None or b is None:
        return None
    return False


@SETTINGS
@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=40))
def test_attack_flags_match_python_regex(spark, pairs):
    import re

    from logsentinel import rules

    rows = [dict(event_id=i, request_path=p, user_agent=a) for i, (p, a) in enumerate(pairs)]
    got = {r.event_id: (r.is_sqli, r.is_xss, r.attack_type)
           for r in detect.attack_tagging(log_rows(spark, rows)).collect()}
    sqli, xss = re.compile(rules.STREAM_SQLI_PATTERN), re.compile(rules.STREAM_XSS_PATTERN)
    want = {}
    for i, (p, a) in enumerate(pairs):
        def m(rx, v):
            return None if v is None else bool(rx.search(v))
        s, x = _or3(m(sqli, p), m(sqli, a)), _or3(m(xss, p), m(xss, a))
        if _or3(s, x) is True:
            want[i] = (s, x, "SQLi" if s is True else "XSS")
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 200), st.integers(0, 10)), min_size=1, max_size=10))
def test_reputation_score_matches_the_formula(spark, rows):
    from logsentinel.operators import serve

    # malicious share m/10 of the count: exact ratios such as 0.3 occur
    data = [(f"ip{i}", c, c * m // 10, c - c * m // 10, 0) for i, (c, m) in enumerate(rows)]
    top = spark.createDataFrame(data, "source_ip string, threat_count bigint, malicious_count bigint, "
                                      "suspicious_count bigint, total_bytes bigint")
    got = {r.source_ip: (r.reputation_score, r.threat_level) for r in serve.ip_reputation(top).collect()}
    lo, hi = min(c for _, c, *_ in data), max(c for _, c, *_ in data)
    want = {}
    for ip, c, mal, _, _ in data:
        score = 75 if hi == lo else int(50 + ((c - lo) / (hi - lo)) * 49)
        if mal / max(c, 1) > 0.3:
            score = min(99, score + 10)
        level = "CRITICAL" if score >= 85 else "HIGH" if score >= 65 else "MEDIUM" if score >= 40 else "LOW"
        want[ip] = (score, level)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 30), st.integers(0, 900),
                          st.sampled_from(["TCP", "TCP", "UDP"])), min_size=1, max_size=150))
def test_port_scan_matches_brute_force(spark, conns):
    from logsentinel.operators import batch

    rows = [dict(source_ip=ip, dest_ip=f"d{d}", sec=float(t), protocol=p) for ip, d, t, p in conns]
    got = {(r.source_ip, r.window_start): (r.distinct_targets, r.connection_count)
           for r in batch.port_scan(log_rows(spark, rows)).collect()}
    targets, total = defaultdict(set), Counter()
    for ip, d, t, p in conns:
        if p == "TCP":
            key = (ip, T0 + dt.timedelta(seconds=(t // 300) * 300))
            targets[key].add(d)
            total[key] += 1
    assert got == {k: (len(v), total[k]) for k, v in targets.items() if len(v) > 20}


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.sampled_from(["w1", "w2"]),
                          st.sampled_from(["SQLi", "XSS"]), st.integers(0, 9), st.integers(1, 30)),
                min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1], r[2], r[3])))
def test_current_alerts_keep_the_latest_batch(spark, emissions):
    from logsentinel.operators import serve

    df = spark.createDataFrame(
        [(ip, w, t, b, c) for ip, w, t, b, c in emissions],
        "source_ip string, window_start string, alert_type string, batch_id bigint, count bigint")
    got = {(r.source_ip, r.window_start, r.alert_type): r["count"]
           for r in serve.current_alerts(df).collect()}
    latest = {}
    for ip, w, t, b, c in emissions:
        if (ip, w, t) not in latest or b > latest[(ip, w, t)][0]:
            latest[(ip, w, t)] = (b, c)
    assert got == {k: c for k, (_, c) in latest.items()}


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.one_of(st.none(), st.sampled_from("xy"))),
                min_size=1, max_size=40))
def test_duplicate_rows_match_pandas(spark, rows):
    import pandas as pd

    from logsentinel.operators import profile

    df = spark.createDataFrame(rows, "a int, b string")
    r = profile.profile_duplicates(df).collect()[0]
    pdf = pd.DataFrame(rows, columns=["a", "b"])
    assert r.duplicate_rows == int(pdf.duplicated().sum())
    assert r.distinct_rows == len(pdf.drop_duplicates())
