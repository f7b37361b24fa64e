"""Small files that tell which written folders count.

A folder that Spark writes becomes visible file by file; a manifest next to it
is put in place by one rename when the folder is whole.  Readers go by the
manifests, so they see a write either whole or not at all.  Manifests are
small and few next to the data; they go through the file system that holds
the folder (local, HDFS or an object store), not through a Spark job.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _open(spark, path)
    return fs.exists(where)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, sorted; none if nothing does."""
    fs, where = _open(spark, pattern)
    return sorted(str(s.getPath()) for s in fs.globStatus(where) or ())


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _open(spark, path)
    fs.delete(where, True)


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file that appears whole, in place of an older one."""
    fs, where = _open(spark, path)
    part = where.suffix(f".{uuid.uuid4().hex[:8]}.tmp")
    hidden = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where.getParent(), "." + part.getName())
    out = fs.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(where):
        fs.delete(where, False)
    if not fs.rename(hidden, where):
        raise OSError(f"{hidden} could not be renamed to {where}")


def get(spark: SparkSession, path: str) -> str:
    fs, where = _open(spark, path)
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files in a folder."""
    fs, where = _open(spark, path)
    return fs.getContentSummary(where).getLength()


def first_lines(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Every file that a path, folder or pattern names, with its first line
    (also of compressed files): one short read per file, many at a time."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs, where = _open(spark, path)
    files, folders = [], [s for s in fs.globStatus(where) or ()]
    while folders:
        status = folders.pop()
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if status.isDirectory():
            folders.extend(fs.listStatus(status.getPath()))
        else:
            files.append(status.getPath())

    def first_line(file) -> tuple[str, str]:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file)
        stream = fs.open(file)
        text = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            return str(file), text.readLine() or ""
        finally:
            text.close()

    with ThreadPoolExecutor(16) as pool:
        return sorted(pool.map(first_line, files))
