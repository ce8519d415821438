"""Bronze layer: raw payment records as gzipped JSON lines under ``dt=<day>/run_id=<id>/``.

Landing writes each record's JSON line exactly as received (unknown keys included) with the
DataFrame writer, gzip-compressed, one file set per task. The batch manifest (row count and
content checksum per ``dt``/``run_id``) is returned as a DataFrame for the caller to append to
its own manifest table, outside the data folder, so scans never read it as a record.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ledgerlake.operators.ops import batch_manifest
from ledgerlake.schemas import PAYMENT_COLUMNS, RAW_PAYMENT
from ledgerlake.sources.tables import table_exists

# Batch manifests that a landing may leave beside its data files; every other file is data.
MANIFEST_SUFFIX = ".manifest.json"
LINE_SCHEMA = StructType(
    [
        StructField("value", StringType(), True),
        StructField("dt", DateType(), True),
        StructField("run_id", StringType(), True),
    ]
)


def _day(dt) -> str:
    return dt.isoformat() if isinstance(dt, _dt.date) else str(dt)


def record_line(df: DataFrame) -> Column:
    """The JSON line of a record: ``raw_line`` when present, else the six fields as JSON."""
    if "raw_line" in df.columns:
        return F.col("raw_line")
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in PAYMENT_COLUMNS]))


def land_bronze(raw: DataFrame, path: str, dt=None, run_id: str | None = None) -> DataFrame:
    """Append records as gzipped JSON lines partitioned by ``dt``/``run_id``.

    ``raw`` carries the payment fields (or ``raw_line``) and either ``dt``/``run_id`` columns
    or the ``dt``/``run_id`` arguments. Returns the manifest of the landed batches.
    """
    df = raw
    if dt is not None:
        df = df.withColumn("dt", F.lit(_day(dt)).cast("date"))
    if run_id is not None:
        df = df.withColumn("run_id", F.lit(run_id))
    lines = df.select(record_line(df).alias("value"), F.col("dt").cast("date").alias("dt"), "run_id")
    # Cluster by the output folders so each (dt, run_id) gets few large files; adaptive
    # execution still splits a hot day over several tasks.
    (
        lines.hint("rebalance", "dt", "run_id")
        .write.mode("append")
        .partitionBy("dt", "run_id")
        .option("compression", "gzip")
        .text(path)
    )
    return manifest_of(lines)


def manifest_of(lines: DataFrame) -> DataFrame:
    m = batch_manifest(lines, ["dt", "run_id"], ["value"])
    return m.select(F.col("dt").alias("report_date"), "run_id", "rows", "checksum")


def parse_lines(lines: DataFrame) -> DataFrame:
    """JSON lines -> raw records: the six fields as STRING, the line kept as ``raw_line``."""
    extra = [c for c in lines.columns if c != "value"]
    parsed = lines.select(
        F.from_json("value", RAW_PAYMENT).alias("r"), F.col("value").alias("raw_line"), *extra
    )
    return parsed.select("r.*", "raw_line", *extra)


def read_bronze(spark: SparkSession, path: str, dt=None, run_id: str | None = None) -> DataFrame:
    """Scan raw records of one landing day (or all days when ``dt`` is None).

    A day is loaded from its own folder, so the listing does not grow with the days landed
    before; a day without a folder has no rows. The STRING schema keeps each field's text for
    the contract.
    """
    base = path.rstrip("/")
    folder = base if dt is None else f"{base}/dt={_day(dt)}"
    if dt is not None and not table_exists(spark, folder):
        return parse_lines(spark.createDataFrame([], LINE_SCHEMA))
    lines = spark.read.schema(LINE_SCHEMA).option("basePath", base).format("text").load(folder)
    if run_id is not None:
        lines = lines.where(F.col("run_id") == F.lit(run_id))
    return parse_lines(_data_lines(lines))


def _data_lines(lines: DataFrame) -> DataFrame:
    """Lines of data files only: a manifest beside them is not a record."""
    return lines.where(~F.col("_metadata.file_name").endswith(MANIFEST_SUFFIX))


def stream_bronze(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, archive_dir: str | None = None):
    """Streaming scan of bronze lines (file source); partition columns come from the paths."""
    reader = spark.readStream.schema(LINE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return _data_lines(reader.format("text").load(path.rstrip("/")))
