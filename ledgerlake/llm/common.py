"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import gc
import math
import os
import shutil
import tempfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import ledgerlake
from ledgerlake.session import shared_dir

#: Rows of one Arrow batch sent to Python. Batches are the unit of memory of the Python
#: workers, so long texts need short batches.
ARROW_ROWS = 512


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def prepare_workers(spark: SparkSession) -> None:
    """Before a query that runs Python: let the workers import this package and bound Arrow batches.

    The package goes to the executors as ``--py-files`` would send it, once an application. The
    batch setting is never raised.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(ledgerlake.__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="ledgerlake-"), "ledgerlake")
        sc.addPyFile(shutil.make_archive(archive, "zip", root, "ledgerlake"))  # Spark serves it from here
        _shipped.add(sc.applicationId)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def saved(df: DataFrame, name: str, settle: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the cluster's shared folder and read it back.

    The written table cuts the lineage: executors lost later cost a reread, not a recompute. Shuffle files
    behind it are only removed once the driver's JVM has collected the plans that led to them; ``settle``
    asks for that at once, after a step that shuffled much (compare ``spark.cleaner.periodicGC.interval``).
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name)
    df.write.parquet(path)
    if settle:
        gc.collect()
        spark.sparkContext._jvm.java.lang.System.gc()
    return spark.read.schema(df.schema).parquet(path)


#: What a worker process remembers from task to task, by the operator that uses it.
_memories: list[tuple[str, Callable[[], None]]] = []
_current: list[str] = []


def remembered(owner: str, maxsize: int = 2):
    """Like ``functools.lru_cache``, for what tasks of one operator share in a worker process."""

    def deco(make):
        cached = functools.lru_cache(maxsize=maxsize)(make)
        _memories.append((owner, cached.cache_clear))
        return cached

    return deco


def release() -> None:
    """Give memory that is free, but held by Arrow's pool or the C library, back to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it keeps what it has
        pass


def _enter(owner: str) -> None:
    if _current != [owner]:
        for who, clear in _memories:
            if who != owner:
                clear()
        _current[:] = [owner]


def worker(owner: str):
    """For functions over Arrow batches: before a task, forget what other operators' tasks remembered
    in this process, and release free memory after it. Workers live longer than a query."""

    def deco(run):
        @functools.wraps(run)
        def batches_of(batches):
            _enter(owner)
            try:
                yield from run(batches)
            finally:
                release()

        return batches_of

    return deco


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The batch's texts, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def slices(items: list, sizes: list[int], limit: int):
    """Consecutive slices whose sizes sum to at most ``limit`` (single larger items alone)."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield items[start:i]
            start, total = i, 0
        total += size
    if start < len(items):
        yield items[start:]


def parts_for(rows: int, per_part: int, least: int = 1) -> int:
    return max(least, math.ceil(rows / per_part))
