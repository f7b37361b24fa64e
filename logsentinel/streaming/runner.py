"""Structured Streaming runner for the detectors.

The same detector functions as the batch forms run on a decoded stream.
By default each alert detector is its own query with its own checkpoint and
failure domain (a stalled detector does not hold back the others); ``union``
runs the three as one query that reads and decodes the source once.  The alert sink writes each micro-batch from the executors to a
folder of its run and ``batch_id``, so a replayed batch overwrites instead of
duplicating, and a query with a new checkpoint adds to what is there.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logsentinel import rules
from logsentinel.operators import batch, detect, panes
from logsentinel.sources import readers, sinks

SourceFactory = Callable[[], DataFrame]


def text_file_source(
    spark: SparkSession,
    directory: str,
    max_files_per_trigger: int | None = None,
    path_glob: str | None = None,
) -> SourceFactory:
    """A file stream of JSON lines (one ``value`` per line); stands in for
    the Kafka source in tests and replays.  The file source needs a folder;
    ``path_glob`` selects files inside it."""

    def make() -> DataFrame:
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        if path_glob:
            reader = reader.option("pathGlobFilter", path_glob)
        return reader.load(directory)

    return make


def table_file_source(
    spark: SparkSession,
    directory: str,
    schema,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> SourceFactory:
    """A stream of structured log files (Parquet by default); decode it with
    ``readers.with_event_time`` instead of the JSON decoder."""

    def make() -> DataFrame:
        reader = spark.readStream.format(fmt).schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.load(directory)

    return make


def kafka_source(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> SourceFactory:
    return lambda: readers.read_kafka_stream(
        spark, bootstrap_servers, topic, starting_offsets,
        max_offsets_per_trigger=max_offsets_per_trigger,
    )


def stream_session(spark: SparkSession, partitions: int | None) -> SparkSession:
    """A session with the settings of ``spark`` but ``partitions`` state and
    shuffle partitions, to build stream sources from.

    A stateful query takes its partition count from its session when it first
    starts; the checkpoint keeps it from then on.  The caller's session, and
    queries planned in it meanwhile, are not touched."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        try:
            own.conf.set(key, value)
        except Exception:  # fixed for the application: the same already
            pass
    if partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return own


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the run that a checkpoint belongs to: its first start in
    milliseconds and a random part, kept in the checkpoint folder, so a
    restart goes on with the same run and a new checkpoint is a new run."""
    path = f"{checkpoint}/run"
    try:
        return spark.read.text(path).first()[0]
    except AnalysisException:  # a new checkpoint
        run = f"{time.time_ns() // 1_000_000:013d}-{uuid.uuid4().hex[:8]}"
        spark.createDataFrame([(run,)], "value string").coalesce(1).write.text(path)
        return run


def _writer(df: DataFrame, checkpoint: str, output_mode: str, trigger: dict | None, name: str | None):
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    if name:
        w = w.queryName(name)
    return w


def start_alert_queries(
    source: SourceFactory,
    out_dir: str,
    checkpoint_root: str,
    trigger: dict | None = None,
    watermark: str = rules.DEFAULT_WATERMARK,
    union: bool = False,
    detectors: dict[str, Callable[..., DataFrame]] | None = None,
    decode: Callable[[DataFrame], DataFrame] | None = None,
    name_prefix: str | None = None,
    final: bool = False,
) -> list[StreamingQuery]:
    """Start the alert detectors (brute force, SQLi/XSS, volume) in
    update mode with the micro-batch alert sink.  ``trigger`` defaults to 5 s
    processing time; ``decode`` defaults to the JSON envelope decoder with
    the watermark.  With ``name_prefix`` each query is named
    ``{prefix}_{label}`` (visible in progress events and metrics); names
    must be unique among the session's active queries.

    With ``union`` one query runs all detectors: each line is read and decoded
    once and feeds one state store (`panes`); given ``detectors`` of one's own
    are united instead, and read the source once each.  ``final`` (with
    ``union``) emits a window's alerts once, when the watermark has passed it,
    in append mode."""
    trigger = trigger or {"processingTime": "5 seconds"}
    if decode is None:
        def decode(raw: DataFrame) -> DataFrame:
            return readers.decode_log_json(raw, watermark=watermark)
    if union:
        raw = source()
        parsed = decode(raw)
        if detectors is None:
            combined = panes.stream_alerts(parsed, final)
        else:
            combined = None
            for label, fn in detectors.items():
                part = fn(parsed).withColumn("label", F.lit(label))
                combined = part if combined is None else combined.unionByName(part)
        name = f"{name_prefix}_all" if name_prefix else None
        return [
            _writer(combined, f"{checkpoint_root}/all", "append" if final else "update", trigger, name)
            .foreachBatch(sinks.labelled_alert_writer(out_dir, run_id(raw.sparkSession, f"{checkpoint_root}/all")))
            .start()
        ]
    detectors = detectors or detect.ALERT_DETECTORS
    queries = []
    for label, fn in detectors.items():
        raw = source()
        parsed = decode(raw)
        q = (
            _writer(fn(parsed), f"{checkpoint_root}/{label}", "update", trigger,
                    f"{name_prefix}_{label}" if name_prefix else None)
            .foreachBatch(sinks.alert_batch_writer(out_dir, label, run_id(raw.sparkSession, f"{checkpoint_root}/{label}")))
            .start()
        )
        queries.append(q)
    return queries


def start_detector(
    source: SourceFactory,
    detector: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    output_mode: str,
    sink: Callable[[DataFrame, int], None] | None = None,
    memory_table: str | None = None,
    trigger: dict | None = None,
    watermark: str | None = rules.DEFAULT_WATERMARK,
    decode: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Any detector as a streaming query: ``foreachBatch`` sink, or a memory
    table (tests), or the console.  ``decode`` defaults to the JSON envelope
    decoder; pass ``readers.decode_raw_text`` for the raw-text rule."""
    raw = source()
    parsed = decode(raw) if decode else readers.decode_log_json(raw, watermark=watermark)
    out = detector(parsed)
    w = _writer(out, checkpoint, output_mode, trigger, memory_table)
    if sink is not None:
        return w.foreachBatch(sink).start()
    if memory_table:
        return w.format("memory").start()
    return w.format("console").option("truncate", "false").start()


def start_threat_store(
    source: SourceFactory, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """K4 + D9: append stored-threat rows to Parquet."""
    parsed = readers.decode_log_json(source(), watermark=None)
    return sinks.start_threat_store(detect.threat_store(parsed), path, checkpoint, trigger)


def start_port_scan(
    source: SourceFactory, path: str, checkpoint: str, trigger: dict | None = None, watermark: str = rules.DEFAULT_WATERMARK
) -> StreamingQuery:
    """B2 on a stream: append the port scans of closed windows to Parquet."""
    parsed = readers.decode_log_json(source(), watermark=watermark)
    return sinks.start_threat_store(batch.port_scan_final(parsed), path, checkpoint, trigger)


def start_checked_decode(
    source: SourceFactory, out_dir: str, checkpoint: str, trigger: dict | None = None, name: str = "decode"
) -> StreamingQuery:
    """S6 as a query of its own: records and rejected lines, each micro-batch
    written in one job to ``{out_dir}/run={run}/batch_id={id}/kind=records``
    and ``kind=rejects`` (the dead letters).  Every progress event carries the
    counts of lines, records and rejects."""
    raw = source()
    checked = readers.observed_decode(readers.decode_log_json_checked(raw, watermark=None), name)
    run = run_id(raw.sparkSession, checkpoint)
    kind = F.when(F.col("reject_reason").isNull(), "records").otherwise("rejects")

    def write_batch(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.withColumn("kind", kind).write.mode("overwrite").partitionBy("kind").parquet(f"{out_dir}/run={run}/batch_id={batch_id}")

    return _writer(checked, checkpoint, "append", trigger, None).foreachBatch(write_batch).start()


def read_records(spark: SparkSession, out_dir: str) -> DataFrame:
    """The records that `start_checked_decode` wrote."""
    return spark.read.parquet(out_dir).filter("kind = 'records'").drop("reject_reason", "rejected_line", "kind")


def read_rejects(spark: SparkSession, out_dir: str) -> DataFrame:
    """The dead letters that `start_checked_decode` wrote: ``(rejected_line,
    reject_reason, kafka_ts, run, batch_id)``."""
    return spark.read.parquet(out_dir).filter("kind = 'rejects'").select("rejected_line", "reject_reason", "kafka_ts", "run", "batch_id")


def await_all(queries: list[StreamingQuery]) -> None:
    """Wait for bounded (``availableNow``) queries; on a failure stop the
    others and re-raise."""
    try:
        for q in queries:
            q.awaitTermination()
            exc = q.exception()
            if exc is not None:
                raise RuntimeError(f"streaming query {q.id} failed: {exc}")
    except BaseException:
        for q in queries:
            if q.isActive:
                q.stop()
        raise


def await_any(spark: SparkSession, timeout_s: float | None = None) -> bool:
    """Block until any running query ends (the long-running service mode).

    Queries that ended before the call do not count.  Returns whether one
    ended within ``timeout_s`` (always True without a timeout)."""
    spark.streams.resetTerminated()
    if timeout_s is None:
        spark.streams.awaitAnyTermination()
        return True
    return bool(spark.streams.awaitAnyTermination(max(1, int(timeout_s))))
