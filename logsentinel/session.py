"""Session helpers: a local session for tests/bench, and the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "logsentinel",
    driver_memory: str | None = None,
) -> SparkSession:
    """Session for tests and the bench.  Library code never calls this: it
    takes whatever session the caller built."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state."
            "RocksDBStateStoreProvider",
        )
    )
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def app_id(spark: SparkSession) -> str:
    """The application id from the session conf (works for classic and
    Connect sessions alike)."""
    try:
        return spark.conf.get("spark.app.id")
    except Exception:  # conf not exposed: fall back to the context
        return spark.sparkContext.applicationId


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    On a cluster this is set by the deployment and is visible to every
    executor.  Only a bare local session (one process) may leave it unset: it
    gets a fresh local folder, registered as the checkpoint dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # no SparkContext on this client
            root = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(
                "spark.checkpoint.dir must name a folder that the driver and all executors share "
                f"(master is {master or 'unknown'})"
            )
        root = tempfile.mkdtemp(prefix="logsentinel-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared folder, namespaced by application id."""
    segs = [shared_root(spark), "logsentinel", app_id(spark)]
    segs.extend(parts)
    if unique:
        segs.append(uuid.uuid4().hex[:12])
    return "/".join(segs)
