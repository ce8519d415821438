"""Publishing several tables together: all their partitions change, or a later start finishes the work.

Overwriting partitions of two tables is two steps. Before the first one, the stored results and
the partitions they replace are written down as pending; afterwards the entry is removed. ``finish``
at the start of the next run repeats what a dead run left pending: the stored results are complete, so
overwriting from them again gives the same tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlake.session import shared_dir
from ledgerlake.sources import tables


@dataclass(frozen=True)
class Publication:
    """One result: a stored table (``staged``) that becomes the given partitions of ``target``."""

    target: str
    staged: str

    @staticmethod
    def of(df: DataFrame, target: str) -> Publication:
        """Store ``df`` in the shared folder, to be published."""
        path = shared_dir(df.sparkSession, "staged")
        tables.stored(df, path=path)
        return Publication(target, path)

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.staged)


def _folder(journal: str, kind: str, run: str = "") -> str:
    return f"{journal}/{kind}/{run}".rstrip("/")


def was_published(spark: SparkSession, journal: str, run: str) -> bool:
    return tables.table_exists(spark, _folder(journal, "done", run))


def publish(
    spark: SparkSession, journal: str, run: str, parts: Sequence[Publication], values: Sequence, partition_col: str, layout: bool = False
) -> None:
    """Replace the partitions ``values`` of every target by its stored rows, and mark ``run`` as done.

    A partition without rows is removed. The values are as many as the calendar has partitions.
    """
    kind = parts[0].rows(spark).schema[partition_col].dataType
    text = [StructField(c, StringType()) for c in ("target", "staged", "partition_col", "layout")]
    rows = [(p.target, p.staged, partition_col, str(layout), v) for p in parts for v in values]
    if rows:
        plan = spark.createDataFrame(rows, StructType([*text, StructField("value", kind)]))
        plan.coalesce(1).write.mode("overwrite").parquet(_folder(journal, "pending", run))
    _finish_one(spark, journal, run)


def _finish_one(spark: SparkSession, journal: str, run: str) -> None:
    pending = _folder(journal, "pending", run)
    fs, p = tables.fs_path(spark, pending)
    if tables.table_exists(spark, f"{pending}/_SUCCESS"):  # else the entry was not complete: nothing has begun
        todo: dict[tuple, list] = {}
        for r in spark.read.parquet(pending).collect():
            todo.setdefault((r["target"], r["staged"], r["partition_col"], r["layout"]), []).append(r["value"])
        for (target, staged, col, layout), values in sorted(todo.items()):
            tables.replace_days(spark.read.parquet(staged), target, values, col, layout == "True")
        fs.mkdirs(tables.fs_path(spark, _folder(journal, "done", run))[1])
    if fs.exists(p):
        fs.delete(p, True)


def finish(spark: SparkSession, journal: str) -> list[str]:
    """Complete the publications a dead run left pending; returns their runs."""
    fs, p = tables.fs_path(spark, _folder(journal, "pending"))
    runs = sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []
    for run in runs:
        _finish_one(spark, journal, run)
    return runs
