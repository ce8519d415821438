"""Key-to-partition index of a Parquet table: which partition holds a key, without scanning the table.

The index is an append-only table of (key, partition value) in hash buckets of the key. It always
covers the table: a MERGE adds the entries of new keys before it writes their rows, and a key keeps
the partition it was first written to. An entry whose row was erased, or never written because
the run died, only makes a later MERGE look into a partition for nothing.

``probe`` reads the buckets of the wanted keys and no others; within a bucket, files are sorted by key
and carry a Bloom filter sized to their rows. A missing index (or one with another
number of buckets) is built from the table once. Every writer of an indexed table has to go
through ``merge_indexed`` and ``erase_indexed``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.merge import DEFAULT_KEYS, apply_changes, dedup_latest, erase_changes, merge_changes
from ledgerlake.session import shared_dir
from ledgerlake.sources import tables

#: Hash buckets of an index: the folders a batch of very many keys has to open.
N_BUCKETS = 256


@dataclass(frozen=True)
class KeyIndex:
    """Where the index of one table is, and how it is dealt."""

    path: str
    keys: tuple[str, ...] = DEFAULT_KEYS
    partition_col: str = tables.PARTITION_COLUMN
    n_buckets: int = N_BUCKETS

    @property
    def folder(self) -> str:
        """Another number of buckets is another index."""
        return f"{self.path}/buckets={self.n_buckets}"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.n_buckets)).cast("int").alias("bucket")


def index_of(table_path: str, **options) -> KeyIndex:
    """The index beside a table."""
    return KeyIndex(f"{table_path.rstrip('/')}_keys", **options)


def _known(df: DataFrame, index: KeyIndex) -> DataFrame:
    for k in index.keys:
        df = df.where(F.col(k).isNotNull())
    return df


def _entries(rows: DataFrame, index: KeyIndex) -> DataFrame:
    """Index entries of table rows; rows without a key have none."""
    return _known(rows.select(*index.keys, index.partition_col), index).select(
        *index.keys, F.col(index.partition_col).alias("part"), index.bucket()
    )


def _write(entries: DataFrame, folder: str, index: KeyIndex, mode: str) -> None:
    rows = entries.hint("rebalance", "bucket").sortWithinPartitions("bucket", *index.keys)
    writer = tables.with_blooms(rows.write.mode(mode).partitionBy("bucket"), index.keys)
    writer.option("partitionOverwriteMode", "dynamic" if mode == "overwrite" else "static").parquet(folder)


def exists(spark: SparkSession, index: KeyIndex) -> bool:
    """True for an index whose first build was completed."""
    return tables.table_exists(spark, f"{index.path}/_built/buckets={index.n_buckets}")


def build(spark: SparkSession, table_path: str, index: KeyIndex) -> None:
    """Build the index from the whole table (the only full scan of its keys), replacing what is there."""
    fs, p = tables.fs_path(spark, index.folder)
    if fs.exists(p):
        fs.delete(p, True)
    if tables.table_exists(spark, table_path):
        rows = spark.read.parquet(table_path)
        _write(_entries(rows, index).distinct(), index.folder, index, "append")
    fs.mkdirs(tables.fs_path(spark, f"{index.path}/_built/buckets={index.n_buckets}")[1])


def entries(spark: SparkSession, index: KeyIndex, table_schema) -> DataFrame:
    """The index's rows: keys, ``part`` and ``bucket``."""
    fields = ", ".join(f"`{k}` {table_schema[k].dataType.simpleString()}" for k in index.keys)
    kind = table_schema[index.partition_col].dataType.simpleString()
    schema = f"{fields}, part {kind}, bucket int"
    if not tables.table_exists(spark, index.folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(index.folder)


def probe(spark: SparkSession, index: KeyIndex, keys: DataFrame, table_schema) -> DataFrame:
    """``keys, part`` of the wanted keys (distinct, stored) that the index knows.

    The buckets of the keys, at most ``n_buckets`` numbers, become a partition filter.
    """
    wanted = keys.select(*index.keys, index.bucket())
    buckets = sorted(r[0] for r in wanted.select("bucket").distinct().collect())
    found = entries(spark, index, table_schema).where(F.col("bucket").isin(buckets))
    return found.join(wanted, [*index.keys, "bucket"], "left_semi").select(*index.keys, "part").distinct()


def add(new: DataFrame, index: KeyIndex) -> None:
    """Append the entries of rows (``keys``, partition column) whose keys are new."""
    _write(_entries(new, index), index.folder, index, "append")


def compact(spark: SparkSession, index: KeyIndex, table_schema, min_files: int = 2) -> list[int]:
    """Rewrite buckets of ``min_files`` files or more as distinct, sorted entries. Returns their numbers."""
    rows = entries(spark, index, table_schema)
    files = rows.select("bucket", F.col("_metadata.file_path").alias("f")).distinct().groupBy("bucket").agg(F.count("*").alias("n"))
    many = sorted(r["bucket"] for r in files.where(F.col("n") >= min_files).collect())
    if many:
        _write(rows.where(F.col("bucket").isin(many)).distinct(), index.folder, index, "overwrite")
    return many


@dataclass(frozen=True)
class Merged:
    """What a MERGE or an erasure did: the partitions written and the stored feed of row changes (None: nothing)."""

    touched: list
    feed_path: str | None

    def feed(self, spark: SparkSession) -> DataFrame | None:
        return spark.read.parquet(self.feed_path) if self.feed_path else None


def merge_indexed(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    index: KeyIndex | None = None,
    *,
    layout: bool = True,
    source_order: Sequence[str] = ("ingest_ts",),
    **merge_kwargs,
) -> Merged:
    """MERGE ``source`` into the table at ``path`` through its index.

    1. The batch, one row a key, is stored. 2. ``probe`` gives the partitions of its known keys. 3. The batch is
    joined with those partitions alone; the join's output is the change feed, a table of
    the batch's size. 4. New keys enter the index. 5. Partitions in which the feed has a row are
    rewritten (``apply_changes``); one in which the batch changes nothing is not touched.

    A run repeated after dying anywhere gives the same table. ``merge_kwargs`` are those of ``merge_changes``.
    """
    index = index or index_of(path)
    if not exists(spark, index):
        build(spark, path, index)
    batch = tables.stored(dedup_latest(source, list(index.keys), list(source_order)), "merge-batch")
    first = not tables.table_exists(spark, path)
    columns = batch.columns if first else spark.read.parquet(path).columns
    batch = batch.select(*columns)
    hits = tables.stored(probe(spark, index, _known(batch, index), batch.schema), "merge-hits")
    parts = tables.sorted_values(tables.values_of(hits, "part"))
    target = batch.limit(0) if first else spark.read.parquet(path).where(tables.in_partitions(index.partition_col, parts))
    feed_path = shared_dir(spark, "feed")
    feed = tables.stored(merge_changes(target, batch, list(index.keys), **merge_kwargs), path=feed_path)
    inserted = feed.where(F.col("_change_type") == "insert")
    new = _known(inserted, index).join(hits.withColumnRenamed("part", index.partition_col), [*index.keys, index.partition_col], "left_anti")
    add(new, index)
    touched = _apply(spark, path, feed, index, layout, first)
    return Merged(touched, feed_path if touched else None)


def erase_indexed(spark: SparkSession, path: str, ids: DataFrame, index: KeyIndex | None = None, *, layout: bool = True) -> Merged:
    """Delete rows by key: the index names the partitions, only those are read and rewritten.

    A partition left empty is removed. The feed has a ``delete`` for every row.
    """
    index = index or index_of(path)
    if not exists(spark, index):
        build(spark, path, index)
    target = spark.read.parquet(path)
    ids = tables.stored(_known(ids.select(*index.keys).distinct(), index), "erase-ids")
    parts = tables.sorted_values(tables.values_of(probe(spark, index, ids, target.schema), "part"))
    held = target.where(tables.in_partitions(index.partition_col, parts))
    feed_path = shared_dir(spark, "feed")
    feed = tables.stored(erase_changes(held, ids, list(index.keys)), path=feed_path)
    touched = _apply(spark, path, feed, index, layout, False)
    return Merged(touched, feed_path if touched else None)


def _apply(spark: SparkSession, path: str, feed: DataFrame, index: KeyIndex, layout: bool, first: bool) -> list:
    """Rewrite the partitions in which the feed has rows."""
    col = index.partition_col
    touched = tables.sorted_values(tables.values_of(feed, col))
    if not touched:
        return []
    target = feed.drop("_change_type").limit(0) if first else spark.read.parquet(path).where(tables.in_partitions(col, touched))
    after = apply_changes(target, feed, list(index.keys))
    if feed.where(F.col("_change_type") == "delete").isEmpty():  # no partition can become empty
        tables.write_merged(after, path, col, layout)
    else:
        tables.replace_days(tables.stored(after, "merged"), path, touched, col, layout)
    return touched
