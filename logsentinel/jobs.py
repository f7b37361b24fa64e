"""Command-line jobs: the batch layer, normaliser, profiler, speed layer and
serving routes as ``spark-submit``-able entry points.

    python -m logsentinel.jobs batch --logs LOGS.parquet --out RESULTS_DIR
    python -m logsentinel.jobs normalize --csv RAW.csv --out CLEAN.parquet [--profile] [--single-line]
    python -m logsentinel.jobs profile --csv RAW.csv [--single-line]
    python -m logsentinel.jobs rollup --logs CLEAN.parquet --rollup ROLLUP_DIR --until TIME
    python -m logsentinel.jobs span --rollup ROLLUP_DIR --start TIME --end TIME [--logs CLEAN.parquet]
    python -m logsentinel.jobs compact --alerts ALERT_DIR [--drop]
    python -m logsentinel.jobs stream --json-dir DIR | --kafka HOST:PORT --topic T \\
        --alerts ALERT_DIR --checkpoint CKPT [--union | --final] [--available-now]
    python -m logsentinel.jobs serve --results RESULTS_DIR --alerts ALERT_DIR \\
        --route top|ip|port-scans|bytes|sqli-xss|stats|kpis|streaming|streaming-stats [--ip A,B]
    python -m logsentinel.jobs rule --rule NAME --json-dir DIR | --kafka HOST:PORT --topic T \\
        --checkpoint CKPT [--out PARQUET_DIR] [--available-now]

The session comes from ``SparkSession.builder.getOrCreate()``, so master,
shuffle width and the shared checkpoint folder are whatever spark-submit or
the cluster defaults set.  Results printed by ``profile`` and ``serve`` are
streamed to stdout one partition at a time (``toLocalIterator``).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from logsentinel.operators import batch, detect, profile, rollup, serve
from logsentinel.schema import RESULT_TABLES
from logsentinel.session import shared_path
from logsentinel.sources import readers, sinks
from logsentinel.streaming import runner


#: Rows of a list that the command line shows unless told otherwise.
SHOWN = 1000


def _print(df: DataFrame, title: str | None = None, limit: int | None = None) -> None:
    """JSON lines, one partition at a time, then the row count; ``limit``
    for lists that grow with the data (the full list is a table)."""
    if title:
        print(f"# {title}")
    n = 0
    for line in (df if limit is None else df.limit(limit)).toJSON().toLocalIterator():
        print(line)
        n += 1
    print(f"# count: {n}")


def run_batch(
    spark: SparkSession, logs_path: str, out: str, n: int = 10, start: str | None = None, end: str | None = None
) -> dict[str, str]:
    """The batch layer: two scans of the log table.  B1, B3 and B4 come
    from one grouping-sets aggregate, written once to the shared folder
    (which also cuts its lineage) and then split; B2 is its own pass."""
    logs = batch.in_period(readers.read_logs(spark, logs_path), start, end)
    summary_path = sinks.write_result(
        batch.batch_summary(logs), shared_path(spark, "batch_summary", unique=True)
    )
    summary = spark.read.parquet(summary_path)
    return sinks.write_results(
        {
            "top_malicious_ips": batch.top_malicious_ips_from_summary(summary, n),
            "port_scan_detection": batch.port_scan(logs, time_col="timestamp"),
            "sqli_xss_detection": batch.sqli_xss_totals_from_summary(summary),
            "bytes_volume_by_threat_label": batch.bytes_by_threat_label_from_summary(summary),
        },
        out,
    )


def run_profile(spark: SparkSession, csv_path: str, multi_line: bool = True) -> None:
    raw = readers.read_log_csv(spark, csv_path, multi_line=multi_line)
    _print(profile.profile_shape(raw), "shape")
    _print(profile.profile_types(readers.read_raw_csv(spark, csv_path, multi_line)), "types")
    _print(profile.profile_nulls(raw), "missing values")
    _print(profile.profile_duplicates(raw), "duplicates")
    _print(profile.profile_sample(raw, [raw.columns[0]], 5), "sample")


def run_span(spark: SparkSession, path: str, logs_path: str | None, start: str, end: str, seconds: int, n: int = 10) -> None:
    """B1, B3 and B4 of a span of time from a stored rollup."""
    logs = readers.read_logs(spark, logs_path) if logs_path else None
    summary = rollup.span_summary(spark.read.parquet(path), logs, start, end, seconds)
    _print(batch.top_malicious_ips_from_summary(summary, n), "top malicious addresses")
    _print(batch.sqli_xss_totals_from_summary(summary), "attacks")
    _print(batch.bytes_by_threat_label_from_summary(summary), "bytes by label")


def run_stream(args) -> None:
    spark = SparkSession.builder.getOrCreate()
    src = _stream_source(spark, args)
    trigger = {"availableNow": True} if args.available_now else {"processingTime": f"{args.trigger_seconds} seconds"}
    qs = runner.start_alert_queries(
        src, args.alerts, args.checkpoint, trigger=trigger, union=args.union or args.final, final=args.final)
    if args.available_now:
        runner.await_all(qs)
    else:
        runner.await_any(spark)


# Streaming rule presets: detector, output mode, trigger, decoder.  The
# modes and triggers are those of the original single-rule streaming jobs.
STREAM_RULES = {
    "brute_force_tumbling": (detect.brute_force_tumbling, "update", "10 seconds", None),
    "signature_match": (detect.signature_match, "append", "5 seconds", None),
    "volume_tumbling": (detect.volume_tumbling, "update", "5 seconds", None),
    "threat_score": (detect.threat_score_by_ip, "complete", "10 seconds", None),
    "threat_store": (detect.threat_store, "append", "5 seconds", None),
    "brute_force_text": (detect.brute_force_text, "complete", None, readers.decode_raw_text),
    "port_scan": (batch.port_scan_final, "append", "10 seconds", None),
}


def run_rule(args) -> None:
    """One streaming rule with its preset mode and trigger, to the console
    (K2), or with ``--out`` to Parquet: ``threat_store`` to its store (K4),
    the others to a folder per run and micro-batch."""
    spark = SparkSession.builder.getOrCreate()
    if args.starting_offsets is None:
        # The raw-text rule replays its topic from the start.
        args.starting_offsets = "earliest" if args.rule == "brute_force_text" else "latest"
    src = _stream_source(spark, args)
    detector, mode, every, decode = STREAM_RULES[args.rule]
    if args.available_now:
        trigger = {"availableNow": True}
    else:
        trigger = {"processingTime": every} if every else None
    if args.rule == "threat_store" and args.out:
        q = runner.start_threat_store(src, args.out, args.checkpoint, trigger)
    elif args.out:
        sink = sinks.batch_folder_writer(args.out, runner.run_id(spark, args.checkpoint))
        q = runner.start_detector(src, detector, args.checkpoint, mode, sink=sink, trigger=trigger, decode=decode)
    else:
        q = runner.start_detector(src, detector, args.checkpoint, mode, trigger=trigger, decode=decode)
    if args.available_now:
        runner.await_all([q])
    else:
        runner.await_any(spark)


def _stream_source(spark: SparkSession, args):
    if args.kafka:
        if not args.topic:
            raise SystemExit("--topic is required with --kafka")
        return runner.kafka_source(spark, args.kafka, args.topic, args.starting_offsets,
                                   args.max_offsets_per_trigger)
    if not args.json_dir:
        raise SystemExit("one of --kafka or --json-dir is required")
    return runner.text_file_source(spark, args.json_dir, args.max_files_per_trigger)


def run_serve(spark: SparkSession, results: str, alerts_dir: str | None, route: str, ips: list[str], limit: int = SHOWN) -> None:
    def table(name):
        df, _err = readers.read_result_table(spark, f"{results}/{name}")
        return df

    alerts = readers.read_alerts(spark, alerts_dir) if alerts_dir else None
    top = table("top_malicious_ips")
    if route == "top":
        _print(serve.threats_top(top))
    elif route == "ip":
        req = spark.createDataFrame([(ip,) for ip in ips], "ip string")
        _print(serve.ip_lookup(req, top, alerts))
    elif route == "port-scans":
        _print(serve.threats_port_scans(table("port_scan_detection")), limit=limit)
    elif route == "bytes":
        _print(serve.threats_bytes(table("bytes_volume_by_threat_label")))
    elif route == "sqli-xss":
        _print(serve.threats_sqli_xss(table("sqli_xss_detection")))
    elif route == "stats":
        _print(serve.result_table_stats(
            spark, {n: f"{results}/{n}" for n in RESULT_TABLES}, alerts_dir))
    elif route == "kpis":
        _print(serve.threat_kpis(table("sqli_xss_detection"), table("bytes_volume_by_threat_label"), top))
    elif route == "streaming":
        _print(serve.alert_summary(alerts), "summary")
        _print(serve.alert_counts_by_type(alerts), "by type")
        _print(serve.alert_feed(alerts), "alerts", limit)
    elif route == "streaming-stats":
        _print(serve.alert_stats(alerts))
    else:
        raise SystemExit(f"unknown route {route}")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="logsentinel.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("batch")
    b.add_argument("--logs", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--n", type=int, default=10)
    b.add_argument("--start", help="first timestamp of the period")
    b.add_argument("--end", help="timestamp at which the period ends")
    nz = sub.add_parser("normalize")
    nz.add_argument("--csv", required=True)
    nz.add_argument("--out", required=True)
    nz.add_argument("--profile", action="store_true", help="count types and missing values on the way")
    pr = sub.add_parser("profile")
    pr.add_argument("--csv", required=True)
    for p in (nz, pr):
        p.add_argument("--single-line", action="store_true", help="no line breaks inside fields: large files are split")
    ru = sub.add_parser("rollup")
    ru.add_argument("--logs", required=True)
    ru.add_argument("--rollup", required=True)
    ru.add_argument("--until", required=True, help="timestamp before which periods are closed")
    ru.add_argument("--seconds", type=int, default=rollup.DAY)
    sp = sub.add_parser("span")
    sp.add_argument("--rollup", required=True)
    sp.add_argument("--logs", help="needed where the span begins or ends within a period")
    sp.add_argument("--start", required=True)
    sp.add_argument("--end", required=True)
    sp.add_argument("--seconds", type=int, default=rollup.DAY)
    sp.add_argument("--n", type=int, default=10)
    ca = sub.add_parser("compact")
    ca.add_argument("--alerts", required=True)
    ca.add_argument("--drop", action="store_true", help="delete the folders that earlier compactions hold")
    st = sub.add_parser("stream")
    st.add_argument("--kafka")
    st.add_argument("--topic")
    st.add_argument("--starting-offsets", default="latest")
    st.add_argument("--max-offsets-per-trigger", type=int)
    st.add_argument("--json-dir")
    st.add_argument("--max-files-per-trigger", type=int)
    st.add_argument("--alerts", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--trigger-seconds", type=int, default=5)
    st.add_argument("--union", action="store_true", help="one query for all detectors")
    st.add_argument("--final", action="store_true", help="one query that emits each window once, when it is closed")
    st.add_argument("--available-now", action="store_true")
    rl = sub.add_parser("rule")
    rl.add_argument("--rule", required=True, choices=sorted(STREAM_RULES))
    rl.add_argument("--kafka")
    rl.add_argument("--topic")
    rl.add_argument("--starting-offsets")
    rl.add_argument("--max-offsets-per-trigger", type=int)
    rl.add_argument("--json-dir")
    rl.add_argument("--max-files-per-trigger", type=int)
    rl.add_argument("--checkpoint", required=True)
    rl.add_argument("--out")
    rl.add_argument("--available-now", action="store_true")
    sv = sub.add_parser("serve")
    sv.add_argument("--results", required=True)
    sv.add_argument("--alerts")
    sv.add_argument("--route", required=True)
    sv.add_argument("--ip", default="")
    sv.add_argument("--limit", type=int, default=SHOWN)
    args = ap.parse_args(argv)

    if args.cmd == "stream":
        run_stream(args)
        return 0
    if args.cmd == "rule":
        run_rule(args)
        return 0
    spark = SparkSession.builder.getOrCreate()
    if args.cmd == "batch":
        for name, path in run_batch(spark, args.logs, args.out, args.n, args.start, args.end).items():
            print(f"{name}: {path}")
    elif args.cmd == "normalize":
        if args.profile:
            _print(profile.normalize_and_profile(spark, args.csv, args.out, multi_line=not args.single_line), "columns")
        else:
            profile.normalize_csv_to_parquet(spark, args.csv, args.out, multi_line=not args.single_line)
        print(args.out)
    elif args.cmd == "profile":
        run_profile(spark, args.csv, not args.single_line)
    elif args.cmd == "rollup":
        rollup.extend(spark, readers.read_logs(spark, args.logs), args.rollup, args.until, args.seconds)
    elif args.cmd == "span":
        run_span(spark, args.rollup, args.logs, args.start, args.end, args.seconds, args.n)
    elif args.cmd == "compact":
        if args.drop:
            print(f"dropped: {sinks.drop_compacted(spark, args.alerts)}")
        print(f"compacted: {sinks.compact_alerts(spark, args.alerts)}")
    elif args.cmd == "serve":
        run_serve(spark, args.results, args.alerts, args.route, [i for i in args.ip.split(",") if i], args.limit)
    return 0


if __name__ == "__main__":
    sys.exit(main())
