"""Normalisation and profiling of raw log tables.

Every profile is a distributed aggregate over the whole table; only the
(tiny) result is ever brought to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logsentinel.schema import LOG
from logsentinel.sources import readers


def normalize_logs(raw: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """N1 (transform): coerce the text timestamp; a bad value becomes null.

    ``try_cast`` never raises under ANSI mode (``to_timestamp`` would).  The
    result is a wall-clock ``timestamp_ntz``: the text carries no zone.
    """
    return raw.withColumn(ts_col, F.col(ts_col).try_cast("timestamp_ntz"))


def normalize_csv_to_parquet(
    spark: SparkSession, csv_path: str, out_path: str, ts_col: str = "timestamp", date_col: str = "log_date", multi_line: bool = True
) -> DataFrame:
    """N1 (job): CSV (S1) → coerce timestamp → Parquet (K1), one folder per
    date of the timestamp (bad timestamps in one of their own), so a query
    over a period (`batch.in_period`) reads its days only; returns the
    written table read back, without the date column.  Without ``multi_line``
    large files are split over tasks (see `readers.read_raw_csv`)."""
    rows = normalize_logs(readers.read_log_csv(spark, csv_path, multi_line=multi_line), ts_col)
    return _write_dated(rows, out_path, ts_col, date_col)


def _write_dated(rows: DataFrame, out_path: str, ts_col: str, date_col: str) -> DataFrame:
    dated = rows.withColumn(date_col, F.col(ts_col).cast("date")).hint("rebalance", date_col)
    dated.write.mode("overwrite").partitionBy(date_col).parquet(out_path)
    return rows.sparkSession.read.parquet(out_path).select(*rows.columns)


def normalize_and_profile(
    spark: SparkSession, csv_path: str, out_path: str, ts_col: str = "timestamp", date_col: str = "log_date", multi_line: bool = True
) -> DataFrame:
    """N1 with N2–N4 on the way: the CSV is read once; while its rows pass to
    the Parquet table, `observe` counts what `profile_types` and
    `profile_nulls` ask for.  Returns ``(position, column_name, data_type,
    null_count, row_count)``, one row per column; an empty CSV has counts of
    zero."""
    raw = readers.read_raw_csv(spark, csv_path, multi_line, LOG)
    texts, values = Observation(), Observation()
    counts = {f"{i}_{name}": count for i, c in enumerate(raw.columns) for name, count in _kind_counts(c).items()}
    seen = raw.observe(texts, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()])
    typed = readers.typed_log(seen)
    typed = typed.observe(values, *[F.count_if(F.col(c).isNull()).alias(c) for c in typed.columns])
    _write_dated(normalize_logs(typed, ts_col), out_path, ts_col, date_col)
    found, nulls = texts.get, values.get
    rows = []
    for i, c in enumerate(raw.columns):
        there, whole, number, boolean = (found[f"{i}_{n}"] for n in ("there", "whole", "number", "boolean"))
        kind = (
            "bigint" if there and whole == found["rows"] else "double" if number == there
            else "boolean" if boolean == found["rows"] else "string"
        )
        rows.append((i, c, kind, nulls[c], found["rows"]))
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, null_count bigint, row_count bigint")


def profile_shape(df: DataFrame) -> DataFrame:
    """Row count and column count (one row)."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns))
    )


#: Texts that are whole numbers and numbers.
_WHOLE = r"^[+-]?[0-9]{1,18}$"
_NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def profile_types(raw: DataFrame) -> DataFrame:
    """``(position, column_name, data_type)`` as the data tell: from one
    aggregate over the text columns of a raw table (`readers.read_raw_csv`).

    ``bigint`` if every value is a whole number and none is missing,
    ``double`` if every value that is there is a number (also if none is
    there), ``boolean`` if every value is True or False and none is missing,
    else ``string``.
    """
    rows = F.count(F.lit(1))
    kinds = []
    for i, c in enumerate(raw.columns):
        n = _kind_counts(c)
        kind = (
            F.when((n["there"] > 0) & (n["whole"] == rows), "bigint")
            .when(n["number"] == n["there"], "double")
            .when(n["boolean"] == rows, "boolean")
            .otherwise("string")
        )
        kinds.append(F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), kind.alias("data_type")))
    return raw.agg(F.array(*kinds).alias("kinds")).select(F.inline("kinds"))


def _kind_counts(column: str) -> dict[str, Column]:
    """How many values of a text column are there, and of which kinds."""
    v = F.col(f"`{column}`").cast("string")
    return {
        "there": F.count(v), "whole": F.count_if(v.rlike(_WHOLE)), "number": F.count_if(v.rlike(_NUMBER)),
        "boolean": F.count_if(v.isin("True", "False")),
    }


def profile_nulls(df: DataFrame) -> DataFrame:
    """Missing values per column, from one aggregate over the table."""
    cols = df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], cols, "column_name", "null_count")


def profile_duplicates(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row (nulls compare equal).

    Grouping on all columns combines copies map-side first, so a value
    repeated across a third of the table is counted inside each task.
    """
    cols = subset or df.columns
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    )


def profile_sample(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in an explicit order (a top-k, no full sort)."""
    return df.orderBy(*order_by).limit(n)
