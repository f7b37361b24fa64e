"""The maintained table of current alerts (V14 for serving).

Update mode emits a growing window again and again; `serve.current_alerts`
finds the latest emission of every key by aggregating all that was ever
emitted.  This table holds the latest emissions only.  It is cut into buckets
by the hash of the alert key; each micro-batch is merged into the buckets it
touches, which are written anew under a version of their own, and a numbered
manifest that names the version of every bucket then takes effect at once.
Readers see the table before or after a batch, never in between, and a replayed
batch changes nothing.  One query writes a table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsentinel.operators.serve import current_alerts
from logsentinel.schema import ALERT
from logsentinel.sources import manifest

KEY = ("source_ip", "window_start", "alert_type")
#: Buckets of a new table.  A batch rewrites the ones it touches, so more of
#: them suit a table that is large next to its batches.
BUCKETS = 64

_FIELDS = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in ALERT.fields), "label string", "run string", "batch_id bigint"])


def _latest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the manifest in effect."""
    found = manifest.matching(spark, f"{root}/_manifests/*.json")
    if not found:
        return 0, {}
    return int(found[-1].rsplit("/", 1)[1].removesuffix(".json")), json.loads(manifest.get(spark, found[-1]))


def _read(spark: SparkSession, root: str, versions: dict[str, str], buckets: list[str]) -> DataFrame:
    paths = [f"{root}/version={versions[b]}/bucket={b}" for b in buckets if b in versions]
    if not paths:
        return spark.createDataFrame([], _FIELDS)
    return spark.read.schema(_FIELDS).parquet(*paths)


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The current alerts: one row per key, with the run and batch of its
    latest emission.  A table that does not exist yet is empty."""
    _, now = _latest(spark, root)
    versions = now.get("versions", {})
    return _read(spark, root, versions, sorted(versions))


def merge_batch(alerts: DataFrame, root: str, buckets: int = BUCKETS) -> list[int]:
    """Merge emissions (ALERT columns, ``label, run, batch_id``) into the
    table; returns the buckets it rewrote.  Of a key's emissions the latest
    run's latest batch stays, as in `serve.current_alerts`, in whatever order
    and however often batches arrive.  The number of buckets is fixed by the
    first batch."""
    spark = alerts.sparkSession
    number, now = _latest(spark, root)
    count, versions = now.get("buckets", buckets), now.get("versions", {})
    fields = [c.split("`")[1] if "`" in c else c.split()[0] for c in _FIELDS.split(", ")]
    bucket = F.pmod(F.xxhash64(*KEY), F.lit(count)).cast("int")
    new = alerts.select(*fields).persist()
    try:
        touched = sorted(r[0] for r in new.select(bucket).distinct().collect())  # at most one row per bucket
        if not touched:
            return []
        merged = current_alerts(new.unionByName(_read(spark, root, versions, [str(b) for b in touched])), KEY)
        version = f"{number + 1:012d}-{uuid.uuid4().hex[:8]}"
        # One task per bucket: an alert table's bucket is small by choice of their number.
        merged.withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket").parquet(f"{root}/version={version}")
    finally:
        new.unpersist()
    after = versions | {str(b): version for b in touched}
    manifest.put(spark, f"{root}/_manifests/{number + 1:012d}.json", json.dumps({"buckets": count, "versions": after}))
    return touched


def batch_merger(root: str, run: str, label: str | None = None, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that merges every micro-batch of a detector
    (or, without ``label``, of a frame with a ``label`` column)."""

    def write_batch(batch_df: DataFrame, batch_id: int) -> None:
        if label is not None:
            batch_df = batch_df.withColumn("label", F.lit(label))
        merge_batch(batch_df.withColumn("run", F.lit(run)).withColumn("batch_id", F.lit(batch_id).cast("bigint")), root, buckets)

    return write_batch


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete manifests but the last ``keep`` and the bucket folders that none
    of these names, unfinished ones included; returns how many folders.  Not
    to be run while a batch is being merged."""
    found = manifest.matching(spark, f"{root}/_manifests/*.json")
    used = {f"version={v}/bucket={b}" for path in found[-keep:] for b, v in json.loads(manifest.get(spark, path))["versions"].items()}
    gone = 0
    for folder in manifest.matching(spark, f"{root}/version=*/bucket=*"):
        if "/".join(folder.rsplit("/", 2)[1:]) not in used:
            manifest.remove(spark, folder)
            gone += 1
    for path in found[:-keep]:
        manifest.remove(spark, path)
    return gone
