"""Scans and decoders."""

from __future__ import annotations

import csv

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from logsentinel import rules
from logsentinel.schema import ALERT_COLUMNS, ALERT_WITH_CORRUPT, CORRUPT_RECORD, LOG
from logsentinel.sources import manifest


#: Texts that stand for a missing value in CSV.
MISSING_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
#: Columns that an older log may lack.
OPTIONAL_COLUMNS = ("dest_port",)


def read_raw_csv(
    spark: SparkSession, path: str, multi_line: bool = True, schema: StructType | None = None, optional: tuple[str, ...] = OPTIONAL_COLUMNS
) -> DataFrame:
    """CSV with a header as text columns named by it.

    Quotes inside a quoted field are doubled; missing-value markers, quoted
    or not, become null.  With ``multi_line`` a quoted field may hold line
    breaks, but a file is then read by one task; without it large files are
    split (for exports of many small files it makes no difference).

    Files of a folder may have different headers, and their columns in
    different order: files of one header are read together and the parts
    matched by name, a column that some files lack being null there.
    """
    found = None
    for part in _csv_by_header(spark, path, multi_line):
        if schema is not None:
            names = [f.name for f in schema.fields]
            unknown = [c for c in part.columns if c not in names]
            missing = [n for n in names if n not in part.columns and n not in optional]
            if unknown or missing:
                raise ValueError(f"CSV header at {path}: unknown columns {unknown}, missing columns {missing}")
        found = part if found is None else found.unionByName(part, allowMissingColumns=True)
    return found


def _csv_by_header(spark: SparkSession, path: str, multi_line: bool) -> list[DataFrame]:
    """One frame per header among the files."""
    reader = lambda: (
        spark.read.option("header", "true").option("quote", '"').option("escape", '"')
        .option("multiLine", str(multi_line).lower()).option("mode", "PERMISSIVE")
    )
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in manifest.first_lines(spark, path):
        names = tuple(next(csv.reader([line.removeprefix("\ufeff")]), ()))
        if names:  # an empty file has no rows
            groups.setdefault(names, []).append(file)
    frames = []
    for names, files in groups.items():
        schema = StructType([StructField(n, StringType()) for n in names])
        raw = reader().schema(schema).option("enforceSchema", "false").csv(files)
        frames.append(raw.select(*[F.when(~F.col(f"`{c}`").isin(*MISSING_MARKERS), F.col(f"`{c}`")).alias(c) for c in names]))
    return frames or [reader().csv(path)]


def read_log_csv(
    spark: SparkSession, path: str, schema: StructType = LOG, multi_line: bool = True,
    optional: tuple[str, ...] = OPTIONAL_COLUMNS,
) -> DataFrame:
    """CSV log with the columns of ``schema``, matched by header name.

    Every file of a folder is matched by its own header, so exports of
    different layouts can lie side by side.  An unknown or missing column is
    an error, except that ``optional`` ones may be missing and are null then.  A value that does not parse as its
    column's type is null.  See `read_raw_csv` for quoting and markers.
    """
    return typed_log(read_raw_csv(spark, path, multi_line, schema, optional), schema)


def typed_log(raw: DataFrame, schema: StructType = LOG) -> DataFrame:
    """The text columns of a raw log as the types of ``schema``; a value that
    does not parse, like a column that is not there, is null."""
    return raw.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Parquet log table (local, HDFS or object-store URI)."""
    return spark.read.parquet(path)


def read_result_table(
    spark: SparkSession, path: str, fmt: str = "parquet"
) -> tuple[DataFrame | None, str | None]:
    """S3: a stored result table, or ``(None, error)`` when it is missing.

    The error is a value, not an exception, so a serving query can report
    which tables are absent and still answer from the others.
    """
    try:
        df = spark.read.format(fmt).load(path)
        df.schema  # resolve now: a missing path fails here, not later
        return df, None
    except AnalysisException as exc:  # PATH_NOT_FOUND, UNABLE_TO_INFER_SCHEMA
        return None, f"missing result table at {path}: {exc.getErrorClass() or exc}"


#: Layouts of the alert folder: the sink's, the sink's of older versions, and
#: flat ``{label}_batch_{id}.json`` files.
_SINK_LAYOUT = "label=*/run=*/batch_id=*"
_OTHER_LAYOUTS = ("label=*/batch_id=*", "*.json")
_BATCH = ["label", "run", "batch_id"]


def read_alerts(spark: SparkSession, directory: str, missing_ok: bool = True) -> DataFrame:
    """Every alert line under ``directory``, with its ``label, run,
    batch_id``.

    The sink's partitioned folders (partition discovery, so filters on
    ``label``, ``run`` and ``batch_id`` prune folders), the tables that
    compactions have made of them, and flat ``{label}_batch_{id}.json`` files,
    whose label and batch id come from the file name, are read side by side;
    alerts without a run have a null run, which counts as the oldest.  Of the
    sink's folders only committed batches count, and of these the ones that a
    compaction holds are read from its table only, so no alert is counted
    twice or in part.  Blank lines are skipped; a line that is not JSON is
    dropped; a wrong-typed field is null and the rest of its record kept.  A
    missing or empty folder gives an empty frame with the same columns (or
    raises when ``missing_ok`` is false).  The schema is declared, so
    resolving the folder lists files but reads none.
    """
    there = [layout for layout in (_SINK_LAYOUT, *_OTHER_LAYOUTS) if manifest.matching(spark, f"{directory}/{layout}")]
    parts = [uncompacted(spark, directory)[0] if layout == _SINK_LAYOUT else _alert_layout(spark, directory, layout) for layout in there]
    parts += _compacted(spark, directory)
    if not parts:
        return _no_alerts(spark) if missing_ok else _alert_layout(spark, directory, _SINK_LAYOUT)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _no_alerts(spark: SparkSession) -> DataFrame:
    empty = spark.createDataFrame([], ALERT_WITH_CORRUPT)
    none = F.lit(None).cast("string")
    return empty.select(*ALERT_COLUMNS, none.alias("label"), none.alias("run"), F.lit(None).cast("bigint").alias("batch_id"))


def of_batches(alerts: DataFrame, batches: DataFrame) -> DataFrame:
    """The alerts of the given ``(label, run, batch_id)`` batches."""
    return alerts.join(batches, _BATCH, "left_semi").select(*alerts.columns)


def uncompacted(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """The alerts in the sink's folders that count there, and their batches as
    ``(label, run, batch_id)``.  A folder without commits (of an older
    version) counts whole."""
    raw = _alert_layout(spark, directory, _SINK_LAYOUT)
    if not manifest.exists(spark, f"{directory}/_commits"):
        return raw, raw.select(*_BATCH).distinct()
    commits = spark.read.schema("run string, batch_id bigint, labels array<string>").json(f"{directory}/_commits")
    live = commits.select(F.explode("labels").alias("label"), "run", "batch_id")
    taken = _taken(spark, directory)
    if taken is not None:
        live = live.join(taken, _BATCH, "left_anti")
    return of_batches(raw, live), live


def _taken(spark: SparkSession, directory: str) -> DataFrame | None:
    """The batches that compactions hold."""
    if not manifest.matching(spark, f"{directory}/_compactions/*.json"):
        return None
    return spark.read.schema("name string, label string, run string, batch_id bigint").json(f"{directory}/_compactions").drop("name")


def _compacted(spark: SparkSession, directory: str) -> list[DataFrame]:
    """The alerts of each compaction whose manifest is there."""
    names = [p.rsplit("/", 1)[1].removesuffix(".json") for p in manifest.matching(spark, f"{directory}/_compactions/*.json")]
    label = F.col("label").cast("string").alias("label")
    return [spark.read.parquet(f"{directory}/_compacted/{name}").select(*ALERT_COLUMNS, label, "run", "batch_id") for name in names]


def _alert_layout(spark: SparkSession, directory: str, layout: str) -> DataFrame:
    raw = (
        spark.read.schema(ALERT_WITH_CORRUPT)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_RECORD)
        .option("pathGlobFilter", "*.json")
        .option("basePath", directory)
        .json(f"{directory}/{layout}")
    )
    name = F.col("_metadata.file_name")
    from_name = lambda pattern: F.nullif(F.regexp_extract(name, pattern, 1), F.lit(""))
    label = F.col("label").cast("string") if "label" in raw.columns else from_name(r"^(.+)_batch_\d+\.json$")
    run = F.col("run").cast("string") if "run" in raw.columns else F.lit(None).cast("string")
    batch = F.col("batch_id") if "batch_id" in raw.columns else from_name(r"_batch_(\d+)\.json$")
    # A line that is not JSON at all parses to all-null fields: drop it.  A
    # record with one wrong-typed field keeps its other fields (null there).
    any_field = F.coalesce(*[F.col(c).cast("string") for c in ALERT_COLUMNS]).isNotNull()
    return raw.filter(F.col(CORRUPT_RECORD).isNull() | any_field).select(
        *ALERT_COLUMNS, label.alias("label"), run.alias("run"), batch.cast("bigint").alias("batch_id")
    )


def read_kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Kafka topic as a stream (needs the spark-sql-kafka package on the
    classpath).  Every detector takes the decoded frame, so any streaming
    source with a ``value`` column works the same way.
    ``max_offsets_per_trigger`` bounds each micro-batch on a busy topic."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load()


def decode_log_json(
    raw: DataFrame,
    value_col: str = "value",
    broker_time_col: str | None = "timestamp",
    watermark: str | None = rules.DEFAULT_WATERMARK,
    schema: StructType = LOG,
) -> DataFrame:
    """JSON envelope → flat LOG columns + ``kafka_ts`` + ``event_ts``.

    A bad JSON line gives a row of nulls; a bad field nulls only itself.  The
    event time is parsed with ``try_to_timestamp`` (an unparseable value is
    null, never an error) and carries the watermark when one is given.
    """
    cols = [F.col(value_col).cast("string").alias("raw_json")]
    if broker_time_col and broker_time_col in raw.columns:
        cols.append(F.col(broker_time_col).alias("kafka_ts"))
    else:
        cols.append(F.lit(None).cast("timestamp").alias("kafka_ts"))
    # A generator: filters and projections on the fields stay above it, so
    # each line is parsed once however many fields a detector reads.
    out = (
        raw.select(*cols)
        .select("kafka_ts", F.inline_outer(F.array(F.from_json("raw_json", schema))))
        .select(*[f.name for f in schema.fields], "kafka_ts")
        .withColumn("event_ts", F.try_to_timestamp(F.col("timestamp")))
    )
    if watermark:
        out = out.withWatermark("event_ts", watermark)
    return out


#: Why a line is no log record.
BLANK, NOT_A_RECORD, NO_KNOWN_FIELD = "blank", "not_a_record", "no_known_field"


def decode_log_json_checked(
    raw: DataFrame,
    value_col: str = "value",
    broker_time_col: str | None = "timestamp",
    watermark: str | None = rules.DEFAULT_WATERMARK,
    schema: StructType = LOG,
) -> DataFrame:
    """S6 with an account of every line: the columns of `decode_log_json`, and
    ``reject_reason`` and ``rejected_line``, null for a record.

    A line is rejected if it is null or blank, if it is not a JSON object, or
    if it holds none of the fields.  A record with some field of a wrong type
    is kept, the field null.  Each line gives exactly one row, so lines in are
    records plus rejects; `observed_decode` counts both while they pass.
    """
    names = [f.name for f in schema.fields]
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT_RECORD, StringType(), True)])
    broker = F.col(broker_time_col) if broker_time_col and broker_time_col in raw.columns else F.lit(None).cast("timestamp")
    parsed = F.from_json("line", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_RECORD})
    known = F.coalesce(*[F.col(n).cast("string") for n in names]).isNotNull()
    reason = (
        F.when(F.coalesce("line", F.lit("")).rlike(r"^\s*$"), BLANK)
        .when(known, None)
        .when(F.col(CORRUPT_RECORD).isNotNull(), NOT_A_RECORD)
        .otherwise(NO_KNOWN_FIELD)
    )
    out = (
        raw.select(F.col(value_col).cast("string").alias("line"), broker.alias("kafka_ts"))
        .select("line", "kafka_ts", F.inline_outer(F.array(parsed)))
        .withColumn("reject_reason", reason)
        .withColumn("rejected_line", F.when(F.col("reject_reason").isNotNull(), F.coalesce("line", F.lit(""))))
        .withColumn("event_ts", F.try_to_timestamp(F.col("timestamp")))
        .select(*names, "kafka_ts", "event_ts", "reject_reason", "rejected_line")
    )
    return out.withWatermark("event_ts", watermark) if watermark else out


def observed_decode(checked: DataFrame, name: str = "decode") -> DataFrame:
    """Count lines, records and rejects while they pass: on a stream the
    counts are in every progress event (``observedMetrics``), on a table they
    reach the session's listeners, at the cost of no further scan."""
    rejected = F.col("reject_reason").isNotNull()
    return checked.observe(
        name, F.count(F.lit(1)).alias("lines"), F.count_if(~rejected).alias("records"), F.count_if(rejected).alias("rejects"),
        F.count_if(~rejected & F.col("event_ts").isNull()).alias("records_without_time"),
    )


def with_event_time(
    logs: DataFrame,
    time_col: str = "timestamp",
    watermark: str | None = rules.DEFAULT_WATERMARK,
) -> DataFrame:
    """For already-structured log sources (Parquet/Delta tables read as a
    stream): ``event_ts`` as a timestamp from ``time_col`` (text is parsed,
    a bad value is null) plus the watermark."""
    t = F.col(time_col)
    if dict(logs.dtypes).get(time_col) == "string":
        ts = F.try_to_timestamp(t)
    else:
        ts = t.cast("timestamp")
    out = logs.withColumn("event_ts", ts)
    return out.withWatermark("event_ts", watermark) if watermark else out


def decode_raw_text(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """The value as plain text plus the source IP taken by regex (no
    match gives an empty string)."""
    return raw.withColumn("raw_log", F.col(value_col).cast("string")).withColumn(
        "source_ip", F.regexp_extract("raw_log", rules.RAW_SOURCE_IP_PATTERN, 1)
    )
