"""Parquet table I/O: scans, partition overwrite, appends. ``key_index`` has the MERGE and erasure sinks.

A table is a Parquet directory partitioned by a date column. Writes use dynamic partition
overwrite, which replaces exactly the partitions present in the written DataFrame; a single
writer per table is assumed (the overwrite is not atomic across concurrent writers).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.operators.merge import DEFAULT_KEYS
from ledgerlake.session import shared_dir

PARTITION_COLUMN = "payment_date"


def fs_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, p


def spread(df: DataFrame, min_partitions: int | None = None, known_partitions: int | None = None) -> DataFrame:
    """Round-robin an input that has fewer partitions than the cluster has cores.

    A single large unsplittable file (a gzip JSON batch, a one-row-group Parquet file) is read
    by one task, and every narrow operator after it (contract checks, hashing) would run on
    one core. A table of many files already has enough splits, and is returned unchanged, so
    this adds a shuffle only where the input is too coarse to use the cluster.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = known_partitions if known_partitions is not None else df.rdd.getNumPartitions()
    except Exception:  # no RDD view (e.g. Spark Connect): leave the plan as it is
        return df
    return df if current >= target else df.repartition(target)


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, p = fs_path(spark, path)
    return bool(fs.exists(p))


def read_table(
    spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Scan a table; a missing table reads as a typed empty DataFrame when ``schema`` is given."""
    if schema is not None and not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.format(fmt)
    return reader.load(path)


def stored(df: DataFrame, name: str = "stored", path: str | None = None) -> DataFrame:
    """``df`` written into the cluster's shared folder and read back: lineage is cut, every reader sees the same rows."""
    path = path or shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_layout(
    df: DataFrame, partition_col: str = PARTITION_COLUMN, sort_cols: Sequence[str] = ("game",)
) -> DataFrame:
    """Cluster rows for the file layout: one shuffle by partition value, sorted within files.

    Stands in for optimize-write + Z-order on a plain Parquet table: files of one day are
    written by few tasks and row groups are sorted by ``sort_cols`` so min/max statistics
    prune well. ``rebalance`` lets adaptive execution split a hot day into several tasks.
    """
    sort_cols = [c for c in sort_cols if c in df.columns]
    spread = df.hint("rebalance", partition_col) if partition_col in df.columns else df
    return spread.sortWithinPartitions(*sort_cols) if sort_cols else spread


def overwrite_partitions(
    df: DataFrame,
    path: str,
    partition_col: str = PARTITION_COLUMN,
    *,
    compression: str = "snappy",
    bloom_filter_cols: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Replace only the partitions present in ``df`` (never the whole table)."""
    w = (
        df.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(partition_col)
    )
    with_blooms(w, bloom_filter_cols).save(path)


def with_blooms(writer: DataFrameWriter, columns: Sequence[str]) -> DataFrameWriter:
    """Parquet Bloom filters on ``columns``, each as large as the values of its file need.

    The writer fills filters of twelve sizes, each half the one before, and stores the smallest
    that keeps the rate of false hits; without that every row group of every file holds a megabyte.
    """
    for c in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.candidates.number#{c}", "12")
    return writer.option("parquet.bloom.filter.adaptive.enabled", "true") if columns else writer


def replace_days(df: DataFrame, path: str, days: Sequence, partition_col: str = PARTITION_COLUMN, layout: bool = False) -> None:
    """Make ``df`` the whole content of the given partitions: a day without rows is emptied.

    ``df`` is read twice, so it should be a stored table.
    """
    filled = set(values_of(df, partition_col))
    if filled - set(days):
        raise ValueError(f"rows outside the days to replace: {sorted(map(str, filled - set(days)))}")
    if filled:
        write_merged(df, path, partition_col, layout)
    emptied = ["__HIVE_DEFAULT_PARTITION__" if d is None else d for d in days if d not in filled]
    _delete_partition_dirs(df.sparkSession, path, partition_col, emptied)


def append(df: DataFrame, path: str, partition_cols: Sequence[str] = (), fmt: str = "parquet") -> None:
    w = df.write.format(fmt).mode("append")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.save(path)


def _delete_partition_dirs(spark: SparkSession, path: str, partition_col: str, values) -> None:
    for v in values:
        fs, p = fs_path(spark, f"{path}/{partition_col}={v}")
        if fs.exists(p):
            fs.delete(p, True)


def values_of(df: DataFrame, column: str) -> list:
    """Distinct partition values (bounded by the calendar) for building partition filters."""
    return [r[0] for r in df.select(column).distinct().collect()]


def in_partitions(column: str, values: list):
    """Partition filter for ``values``; a NULL value selects the default (NULL) partition too."""
    known = [v for v in values if v is not None]
    cond = F.col(column).isin(known) if known else F.lit(False)
    return cond | F.col(column).isNull() if None in values else cond


def sorted_values(values) -> list:
    known = sorted(v for v in set(values) if v is not None)
    return known + ([None] if None in set(values) else [])


def write_merged(df: DataFrame, path: str, partition_col: str, layout: bool) -> None:
    """Rewrite partitions with the silver layout: few files per day, rows sorted by game,
    and a Parquet bloom filter on the key for point lookups."""
    if layout:
        df = write_layout(df, partition_col, sort_cols=("game",))
    blooms = [c for c in DEFAULT_KEYS if c in df.columns] if layout else []
    overwrite_partitions(df, path, partition_col, bloom_filter_cols=blooms)
