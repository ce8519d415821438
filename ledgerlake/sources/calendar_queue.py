"""The retry queue as a table partitioned by the day an entry becomes eligible.

What is due lies in the partitions up to today, so looking for it opens nothing else, and a replay
rewrites those days, the days its failures move to and no others.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.sources import tables
from ledgerlake.sources.publication import Publication

DAY = "eligible_day"


def with_day(entries: DataFrame) -> DataFrame:
    return entries.withColumn(DAY, F.col("eligible_at").cast("date"))


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All entries, with their day; typed and empty if there is no queue yet."""
    if not tables.table_exists(spark, path):
        return with_day(spark.createDataFrame([], schema))
    return spark.read.schema(StructType([*schema.fields]).add(DAY, "date")).parquet(path)


def elapsed(queue: DataFrame, now) -> DataFrame:
    """The entries of the days up to ``now``: a partition filter."""
    return queue.where(F.col(DAY) <= F.lit(_dt.date.fromisoformat(str(now)[:10])))


def rewritten(queue: DataFrame, path: str, now, left: DataFrame, fresh: DataFrame) -> tuple[Publication, list]:
    """The queue after a replay: what is ``left`` of the elapsed days (rescheduled entries among it) and ``fresh`` ones.

    Returns the stored partitions and their days: the elapsed ones and those that entries moved to or
    came to, whose entries from before are read and kept.
    """
    come = tables.stored(with_day(left.unionByName(fresh)), "queue-come")
    old = tables.values_of(elapsed(queue, now), DAY)
    moved = [d for d in tables.values_of(come, DAY) if d not in old]
    future = queue.where(tables.in_partitions(DAY, moved)).where(F.col(DAY) > F.lit(_dt.date.fromisoformat(str(now)[:10])))
    return Publication.of(come.unionByName(future.select(*come.columns)), path), tables.sorted_values([*old, *moved])
