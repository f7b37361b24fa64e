"""Sinks (K1–K5).  Every write is idempotent: overwrite of a result folder,
or of one ``batch_id`` folder per micro-batch, so a replay after a lost
executor or a restarted query never duplicates rows."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable, Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logsentinel.sources import manifest, readers


def write_result(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K1: result table as Parquet (overwrite by default)."""
    df.write.mode(mode).parquet(path)
    return path


def write_results(tables: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """K5: one folder per result name under ``root``."""
    return {name: write_result(df, f"{root}/{name}") for name, df in tables.items()}


def write_lookup(df: DataFrame, path: str, key: str = "source_ip", group_bytes: int = 32 << 20, keys: int | None = None) -> str:
    """K1 for point lookups: sorted by ``key`` over all files, with a Parquet
    Bloom filter of it per row group.  An equality on the key then skips the
    row groups whose range (statistics) or filter rules it out; ``keys`` is
    how many distinct keys a row group may hold, for the filter's size."""
    writer = (
        df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite")
        .option("parquet.block.size", str(group_bytes)).option(f"parquet.bloom.filter.enabled#{key}", "true")
    )
    if keys:
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key}", str(keys))
    writer.parquet(path)
    return path


def save_result_table(df: DataFrame, table_name: str, mode: str = "overwrite") -> None:
    """K5 (catalog form): a managed table by result name."""
    df.write.mode(mode).saveAsTable(table_name)


def preview(df: DataFrame, n: int = 20) -> None:
    """K2: print the first ``n`` rows without truncation (batch); a display,
    so the rest of the frame is not shown."""
    df.show(n, truncate=False)


def start_console(stream_df: DataFrame, output_mode: str, trigger: dict | None = None,
                  checkpoint: str | None = None) -> StreamingQuery:
    """K2: console sink for a stream, truncation off."""
    w = stream_df.writeStream.outputMode(output_mode).format("console").option("truncate", "false")
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


#: Bytes of an alert line, about, and of a file of alerts at most.
ALERT_BYTES = 256
FILE_BYTES = 64 << 20
#: Run of alerts that no streaming query wrote; sorts before any query's run.
BATCH_RUN = "0000000000000-batch"

_ADOPTING = threading.Lock()


def alert_batch_writer(
    out_dir: str, label: str, run: str = BATCH_RUN, files: int | None = None
) -> Callable[[DataFrame, int], None]:
    """K3: ``foreachBatch`` function writing each non-empty micro-batch to
    ``{out_dir}/label={label}/run={run}/batch_id={id}`` as JSON lines.

    The batch is written straight from the executors (no ``collect``).  A
    replayed batch id of the same run overwrites its own folder instead of
    appending again; another run (a query with a new checkpoint) has its own
    folders and never touches earlier alerts.  A batch counts for readers once
    its commit is there (`write_labelled_alerts`).  The number of files
    follows the number of alerts, unless ``files`` says it.
    """

    def write_batch(batch_df: DataFrame, batch_id: int) -> None:
        write_labelled_alerts(batch_df.withColumn("label", F.lit(label)), out_dir, batch_id, run, files, label)

    return write_batch


def labelled_alert_writer(
    out_dir: str, run: str = BATCH_RUN, files: int | None = None
) -> Callable[[DataFrame, int], None]:
    """K3 for a frame holding several detectors' alerts (a ``label``
    column): the layout and guarantees of ``alert_batch_writer``."""

    def write_batch(batch_df: DataFrame, batch_id: int) -> None:
        write_labelled_alerts(batch_df, out_dir, batch_id, run, files)

    return write_batch


def write_labelled_alerts(
    alerts: DataFrame, out_dir: str, batch_id: int, run: str = BATCH_RUN, files: int | None = None, writer: str = "all"
) -> None:
    """Write ``alerts`` as batch ``batch_id`` of ``run``, and commit it.

    The batch is computed once and kept until it is written: its size gives
    the number of files (about `FILE_BYTES` each; neighbouring partitions are
    put together without a shuffle), and an empty one writes nothing.  Then
    the folders are written, replacing those of an earlier attempt, and a
    manifest ``_commits/{writer}-{run}-{batch_id}.json`` makes them count, all
    labels at once: `readers.read_alerts` leaves out what is not committed.
    """
    spark = alerts.sparkSession
    _adopt(spark, out_dir)
    commit = f"{out_dir}/_commits/{writer}-{run}-{batch_id}.json"
    label = "*" if writer == "all" else writer
    manifest.remove(spark, commit)
    for folder in manifest.matching(spark, f"{out_dir}/label={label}/run={run}/batch_id={batch_id}"):
        manifest.remove(spark, folder)
    held = alerts.persist()
    try:
        rows = held.count()
        if not rows:
            return
        parts = files or -(-rows * ALERT_BYTES // FILE_BYTES)
        sized = held.repartition(parts) if files else held.coalesce(parts)
        (
            sized.withColumn("run", F.lit(run))
            .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            # Dynamic overwrite stages every job in a folder of its own, so
            # queries can write side by side; appending jobs share one.
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("label", "run", "batch_id")
            .json(out_dir)
        )
    finally:
        held.unpersist()
    labels = [_folder(p)[0] for p in manifest.matching(spark, f"{out_dir}/label={label}/run={run}/batch_id={batch_id}")]
    manifest.put(spark, commit, json.dumps({"run": run, "batch_id": batch_id, "labels": labels}) + "\n")


def _folder(path: str) -> tuple[str, str, int]:
    """Label, run and batch of a sink folder."""
    label, run, batch = (unquote(part.split("=", 1)[1]) for part in path.rsplit("/", 3)[1:])
    return label, run, int(batch)


def _adopt(spark: SparkSession, out_dir: str) -> None:
    """Start the commits of a folder; batches that an older version wrote
    without them count as committed."""
    with _ADOPTING:
        if not manifest.exists(spark, f"{out_dir}/_commits"):
            found = [_folder(p) for p in manifest.matching(spark, f"{out_dir}/label=*/run=*/batch_id=*")]
            lines = [json.dumps({"run": run, "batch_id": batch, "labels": [label]}) + "\n" for label, run, batch in found]
            manifest.put(spark, f"{out_dir}/_commits/0-adopted.json", "".join(lines))


def batch_folder_writer(path: str, run: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing each micro-batch as Parquet to
    ``{path}/run={run}/batch_id={id}``; a replayed batch overwrites its own
    folder.  In complete mode the last folder holds the whole result."""

    def write_batch(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.write.mode("overwrite").parquet(f"{path}/run={run}/batch_id={batch_id}")

    return write_batch


def compact_alerts(spark: SparkSession, out_dir: str) -> int:
    """Rewrite the committed batches that no earlier compaction holds as one
    Parquet table by label and day of ``window_start``, beside them; returns
    how many batches it took.

    A batch never changes once it is committed, so any set of whole batches
    can be compacted while queries go on writing.  The batches that a
    compaction holds are listed in its own manifest, which is put in place
    when its table is whole: `readers.read_alerts` then reads them from the
    table and no longer from their folders, so an alert counts once before,
    during and after.  `drop_compacted` deletes the folders later."""
    name = f"{time.time_ns() // 1_000_000:013d}-{uuid.uuid4().hex[:8]}"
    if not manifest.matching(spark, f"{out_dir}/label=*/run=*/batch_id=*"):
        return 0
    alerts, batches = readers.uncompacted(spark, out_dir)
    # One small row per batch, as many as there are commit files.
    taken = [dict(zip(("label", "run", "batch_id"), r)) for r in sorted({tuple(r.asDict()[c] for c in ("label", "run", "batch_id")) for r in batches.collect()})]
    if not taken:
        return 0
    # What is committed meanwhile is not in this list and stays for the next.
    chosen = spark.createDataFrame([(r["label"], r["run"], r["batch_id"]) for r in taken], "label string, run string, batch_id bigint")
    day = F.coalesce(F.substring("window_start", 1, 10), F.lit("unknown"))
    (
        readers.of_batches(alerts, chosen).withColumn("day", day).hint("rebalance", "label", "day")
        .write.mode("overwrite").partitionBy("label", "day").parquet(f"{out_dir}/_compacted/{name}")
    )
    lines = [json.dumps({"name": name, **r}) + "\n" for r in taken]
    manifest.put(spark, f"{out_dir}/_compactions/{name}.json", "".join(lines))
    return len(taken)


def drop_compacted(spark: SparkSession, out_dir: str) -> int:
    """Delete the folders of compacted batches; returns how many.  Queries
    planned before the compaction may still read them, so run it some time
    after.  A manifest lists its batches until their folders are gone, so an
    interrupted deletion goes on at the next call."""
    dropped = 0
    for path in manifest.matching(spark, f"{out_dir}/_compactions/*.json"):
        for line in manifest.get(spark, path).splitlines():
            r = json.loads(line)
            folder = f"{out_dir}/label={r['label']}/run={r['run']}/batch_id={r['batch_id']}"
            if manifest.exists(spark, folder):
                manifest.remove(spark, folder)
                dropped += 1
    return dropped


def start_threat_store(
    stream_df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """K4: append STORED_THREAT rows to Parquet (exactly-once file sink)."""
    w = (
        stream_df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
