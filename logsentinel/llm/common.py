"""Helpers that the corpus operators share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import logsentinel
from logsentinel.session import shared_path

#: ASCII white space, the only word separator of the contracts.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of every executor, once per
    application, so functions that run there can import it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package = os.path.dirname(logsentinel.__file__)
        folder = tempfile.mkdtemp(prefix="package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = os.path.join(folder, "logsentinel")
        context.addPyFile(
            shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package))
        )


def positional(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The frame with its columns renamed by position, and the original
    names.  Renamed columns can always be addressed, also where two names
    differ in case only.  Every operator starts here, so this also ships the
    package."""
    ship(df.sparkSession)
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))]), list(df.columns)


def find(names: list[str], name: str) -> int:
    """Position of a column: the exact name first, then ignoring case."""
    if name in names:
        return names.index(name)
    lower = [n.lower() for n in names]
    if name.lower() in lower:
        return lower.index(name.lower())
    raise ValueError(f"column {name!r} is missing; there are {names}")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns.  Whatever else the input holds, clashing names
    included, is left behind, so Parquet reads the named columns only."""
    moved, cols = positional(df)
    return moved.select(*[F.col(f"_c{find(cols, n)}").alias(n) for n in names])


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete, on leaving, the tables that operators have stored inside: for
    callers whose own result has been written by then."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            remove(spark, path)


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write the frame once to the shared folder and read it back: cuts the
    lineage, survives lost executors, and is computed once however often it
    is read.  The path is for `remove`, once nothing reads the table."""
    path = shared_path(df.sparkSession, "llm", name, unique=True)
    df.write.parquet(path)
    if _scratch:
        _scratch[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """`stored_at` without the path."""
    return stored_at(df, name)[0]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that `stored` or its caller wrote and nothing reads any
    more, through the file system that holds it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def row_hash(df: DataFrame) -> Column:
    """Hash of all columns of a row (maps and variants, which have no hash,
    through their JSON text)."""
    plain = [F.to_json(F.struct(c)) if "map<" in t or "variant" in t else F.col(c) for c, t in df.dtypes]
    return F.xxhash64(*plain)


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` (null: 0)."""
    spaced = F.trim(F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES)))
    return F.when(spaced == "", F.lit(0)).otherwise(F.size(F.split(spaced, " +"))).cast("long")
