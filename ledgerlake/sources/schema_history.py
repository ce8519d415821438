"""Rows of several schema versions in one table: which partition was written with which schema.

The registry is a small table of (partition value, version, schema). A scan reads every version's partitions
with the schema they were written with, aligns them to the newest one (columns that came later are
NULL) and unions them; the gate refuses a schema that would break the readers before anything is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake import schemas
from ledgerlake.sources import tables

REGISTRY = "partition_value string, version int, schema_json string"


def registry(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_table(spark, f"{path}_schemas", schemas.struct_of(REGISTRY))


def latest(spark: SparkSession, path: str) -> tuple[int, StructType] | None:
    """The newest version and its schema."""
    row = registry(spark, path).orderBy("version", ascending=False).first()
    return (row["version"], schemas.struct_from_json(row["schema_json"])) if row else None


def write_versioned(df: DataFrame, path: str, partition_col: str) -> int:
    """Write partitions with the schema of ``df`` and record it; returns its version.

    Raises (before writing) if the schema is not the newest one with columns added.
    """
    spark = df.sparkSession
    schema = StructType([f for f in df.schema.fields if f.name != partition_col])
    newest = latest(spark, path)
    version = 1
    if newest is not None:
        version = newest[0] + bool(schemas.assert_mergeable(newest[1], schema))
    values = [str(v) for v in tables.sorted_values(tables.values_of(df, partition_col))]
    tables.overwrite_partitions(df, path, partition_col)
    held = registry(spark, path).where(~F.col("partition_value").isin(values))
    rows = spark.createDataFrame([(v, version, schema.json()) for v in values], REGISTRY)
    tables.stored(held.unionByName(rows)).coalesce(1).write.mode("overwrite").parquet(f"{path}_schemas")
    return version


def scan(spark: SparkSession, path: str, partition_col: str) -> DataFrame:
    """All rows in the newest schema; the driver sees one entry a partition."""
    versions: dict[tuple[int, str], list[str]] = {}
    for r in registry(spark, path).collect():
        versions.setdefault((r["version"], r["schema_json"]), []).append(r["partition_value"])
    _, target = latest(spark, path)
    out = None
    for (_, text), values in sorted(versions.items()):
        folders = [f"{path}/{partition_col}={v}" for v in sorted(values)]
        kind = spark.read.parquet(path).schema[partition_col]
        own = StructType([*schemas.struct_from_json(text).fields, kind])
        part = spark.read.schema(own).option("basePath", path).parquet(*folders)
        part = schemas.evolve(part, StructType([*target.fields, kind]))
        out = part if out is None else out.unionByName(part)
    return out
