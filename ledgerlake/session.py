"""Session factory and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Fixed values where they are Spark's own names and defaults; sizes follow from 4-core executors
# with some 8 GB of heap. Defaults a caller may override: adaptive execution re-plans joins and partition counts from
# runtime sizes, splits skewed join partitions, and keeps scan splits large enough for a
# cluster reading many terabytes.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Profile for a large cluster reading ~100 TB: start shuffles with many partitions and let
# adaptive execution coalesce them to ~128 MB each, so no reducer holds (and spills) a
# multi-GB partition; split skewed join partitions above 512 MB; let runtime bloom filters
# prune the big side of selective joins. Sized for roughly 10-50 TB of shuffle per stage.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def build_session(
    app_name: str = "ledgerlake",
    master: str | None = None,
    conf: dict[str, str] | None = None,
    profile: str = "default",
) -> SparkSession:
    """Session with the engine defaults; ``profile="cluster"`` adds ``CLUSTER_CONF``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    base = {**DEFAULT_CONF, **(CLUSTER_CONF if profile == "cluster" else {})}
    for key, value in {**base, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _conf(spark: SparkSession, key: str) -> str | None:
    value = spark.conf.get(key, None)
    if value:
        return value
    try:
        return spark.sparkContext.getConf().get(key, None)
    except Exception:  # Spark Connect has no SparkContext
        return None


def _is_local(spark: SparkSession) -> bool:
    master = _conf(spark, "spark.master") or ""
    return master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    The setting is read from the session. Only a local-mode session without one (tests) gets
    a fresh private folder; on a cluster a missing setting is an error, since a machine-local
    folder would not survive the loss of an executor.
    """
    base = _conf(spark, "spark.checkpoint.dir")
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect
        sc = None
    if not base and sc is not None and sc.getCheckpointDir():
        base = sc.getCheckpointDir()
    if not base:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A folder under the shared checkpoint location for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "ledgerlake", *parts)
    if unique:
        path = os.path.join(path, uuid.uuid4().hex)
    return path
