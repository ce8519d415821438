"""Operational operators: volume, row balance, batch manifests, ingestion state, alarms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import row_digest

SPARK_TIER_THRESHOLD = 1_000_000
QUARANTINE_ALARM_ROWS = 100
FRESHNESS_ALARM_DAYS = 1
COMPLETENESS_ALARM_RATIO = 0.999


def partition_volume(df: DataFrame, threshold: int = SPARK_TIER_THRESHOLD, column: str = "payment_date") -> DataFrame:
    """Rows per day partition and the runtime tier that volume calls for."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.withColumn(
        "tier", F.when(F.col("row_count") >= F.lit(threshold), "spark").otherwise("lean")
    )


def tier_for_day(df: DataFrame, dt, threshold: int = SPARK_TIER_THRESHOLD, column: str = "payment_date") -> str:
    """Tier label of one day; a missing day (or table) counts as zero rows."""
    from ledgerlake.operators.gold import filter_day

    n = filter_day(df, dt, column).count()
    return "spark" if n >= threshold else "lean"


COUNT_COLUMNS = ("input_rows", "output_rows", "rejected_rows", "quarantined_rows")


def row_balance(metrics: DataFrame) -> DataFrame:
    """Metrics rows where input != output + rejected + quarantined (a row leak)."""
    leaked = F.col("input_rows") - (F.col("output_rows") + F.col("rejected_rows") + F.col("quarantined_rows"))
    return metrics.select(
        "run_id", "payment_date", *COUNT_COLUMNS, leaked.alias("leaked_rows")
    ).where(F.col("leaked_rows") != 0)


def batch_manifest(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Row count and an order-insensitive content checksum per batch.

    The checksum is the sum of 60-bit SHA-256 digests of each row's canonical text, so it does
    not depend on row or file order and is computed by a partial aggregate on every executor
    (a single-stream hash of the whole batch would have to run on one machine).
    """
    digest = row_digest(list(columns)).cast("decimal(38,0)")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(digest).cast("string").alias("checksum"),
    )


def new_batches(manifest: DataFrame, state: DataFrame, keys: tuple[str, ...] = ("report_date", "checksum")) -> DataFrame:
    """Batches with no successful (status OK) entry in the ingestion state table."""
    ok = state.where(F.col("status") == F.lit("OK")).select(*keys)
    return manifest.join(ok, list(keys), "left_anti")


def ingestion_record(manifest: DataFrame, status: str, recorded_at) -> DataFrame:
    """Rows to append to the ingestion state table for landed batches."""
    from ledgerlake.functions.exprs import ts_lit

    return manifest.select(
        "report_date", "run_id", "rows", "checksum", F.lit(status).alias("status"), ts_lit(recorded_at).alias("recorded_at")
    )


def slo_alarms(
    metrics: DataFrame,
    *,
    quarantine_threshold: int = QUARANTINE_ALARM_ROWS,
    completeness_threshold: float = COMPLETENESS_ALARM_RATIO,
    period: str = "1 hour",
    time_column: str = "recorded_at",
) -> DataFrame:
    """Hourly alarm evaluation: sum of quarantined rows and minimum completeness per period."""
    ratio = F.col("output_rows").cast("double") / F.nullif(F.col("input_rows").cast("double"), F.lit(0.0))
    agg = metrics.groupBy(F.window(time_column, period).alias("w")).agg(
        F.sum("quarantined_rows").cast("bigint").alias("quarantined_rows"),
        F.min(ratio).alias("min_completeness"),
    )
    return agg.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "quarantined_rows",
        "min_completeness",
        (F.col("quarantined_rows") > F.lit(quarantine_threshold)).alias("quarantine_alarm"),
        F.coalesce(F.col("min_completeness") < F.lit(completeness_threshold), F.lit(False)).alias("completeness_alarm"),
    )


def freshness_alarm(freshness: DataFrame, max_days_behind: int = FRESHNESS_ALARM_DAYS) -> DataFrame:
    return freshness.withColumn(
        "freshness_alarm", F.coalesce(F.col("days_behind") > F.lit(max_days_behind), F.lit(True))
    )


def reconciliation_alarm(reconciled: DataFrame) -> DataFrame:
    """Each day of a reconciliation with the checks that failed (comma-joined) and whether any did."""
    checks = ("revenue_ok", "count_ok", "eur_ok")
    failed = F.concat_ws(",", *[F.when(~F.coalesce(F.col(c), F.lit(False)), F.lit(c.removesuffix("_ok"))) for c in checks])
    return reconciled.select("payment_date", failed.alias("failed"), (failed != "").alias("reconciliation_alarm"))


class RowLeakError(RuntimeError):
    pass


def observed(df: DataFrame, name: str, **counts: Column):
    """Attach a row counter (and further aggregates) to ``df``, filled by whatever action runs it next.

    Counting through ``DataFrame.observe`` piggybacks on the job that writes the data, so
    metrics need no second scan. Returns ``(df, observation)``; read
    ``observation.get["rows"]`` after the action.
    """
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in counts.items()]), obs


def task_metrics(spark, dag_id: str, task_id: str, run_id: str, payment_date: str,
                 input_rows: int, output_rows: int, rejected_rows: int, quarantined_rows: int,
                 recorded_at) -> DataFrame:
    """One metrics row (a handful of scalars gathered by observations) as a DataFrame."""
    from ledgerlake.schemas import PIPELINE_METRICS
    import datetime as _dt

    ts = recorded_at if isinstance(recorded_at, _dt.datetime) else _dt.datetime.fromisoformat(str(recorded_at))
    row = (dag_id, task_id, run_id, payment_date, int(input_rows), int(output_rows),
           int(rejected_rows), int(quarantined_rows), ts)
    return spark.createDataFrame([row], PIPELINE_METRICS)


def emit_metrics(metrics: DataFrame, path: str) -> None:
    """Append metrics rows, then raise if any of them leaks rows."""
    metrics.write.mode("append").parquet(path)
    leaks = row_balance(metrics)
    if not leaks.isEmpty():
        worst = leaks.orderBy(F.abs("leaked_rows").desc(), "run_id").first()
        raise RowLeakError(f"{worst['leaked_rows']} rows of run {worst['run_id']}, day {worst['payment_date']}, are unaccounted for")
