"""End-to-end plans: the daily run and its stages, composed lazily in one session.

The stage chain is land -> bronze_to_silver -> quality gate -> silver_to_gold -> referential
checks -> [restatement, replay]. Each stage is a function of DataFrames and paths; nothing
passes between stages through the driver except partition values and check counts.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ledgerlake import schemas
from ledgerlake.operators import contract, dq, gold, marts, ops, retry
from ledgerlake.operators.merge import dedup_latest
from ledgerlake.schemas import PAYMENT_COLUMNS
from ledgerlake.sources import bronze, calendar_queue, key_index, publication, tables


def _date(value) -> _dt.date:
    return value if isinstance(value, _dt.date) else _dt.date.fromisoformat(str(value))


def restate_window(silver: DataFrame, fx: DataFrame, dt, days: int = 7) -> tuple[DataFrame, DataFrame]:
    """Fact and mart for the ``days`` days before ``dt`` in one job (``[dt - days, dt)``).

    Late status flips merged into silver are absorbed by rebuilding these days; the range is
    one half-open typed filter, so the scan prunes to exactly those partitions, and the days
    are rebuilt by one job instead of one job per day.
    """
    end = _date(dt)
    start = end - _dt.timedelta(days=days)
    fact = gold.build_fact(gold.filter_days(silver, start, end), fx)
    return fact, gold.build_agg_game_daily(fact)


def silver_to_gold(silver: DataFrame, fx: DataFrame, dt) -> tuple[DataFrame, DataFrame]:
    """Fact and mart of one day; the day filter comes before the FX join."""
    fact = gold.build_fact(gold.filter_day(silver, dt), fx)
    return fact, gold.build_agg_game_daily(fact)


def lean_transform(raw: DataFrame, dt, day_column: str = "dt", order_by=("run_id",)) -> DataFrame:
    """Typed, deduplicated records of one landing day (bronze -> silver shape, no MERGE).

    The later run wins for a re-sent id. Written by ``write_lean`` as ZSTD Parquet.
    """
    day = raw.where(F.col(day_column) == F.lit(_date(dt)))
    latest = dedup_latest(day, order_by=list(order_by))
    return contract.typed(latest).drop("ingest_ts")


def write_lean(df: DataFrame, path: str) -> None:
    tables.overwrite_partitions(df, path, "payment_date", compression="zstd")


@dataclass
class Landed:
    """What bronze -> silver did with a landing day."""

    touched: list
    counts: dict
    rejected: DataFrame
    feed: DataFrame | None = None
    schema_changes: list = field(default_factory=list)

    @property
    def quarantined(self) -> int:
        return self.counts["quarantined_rows"]


def checked_rows(raw: DataFrame, as_of, ingest_ts: Column, suite=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(passed, rejected, warned)`` of raw records: contract first, then the suite's severities, NULL counting as broken.

    Rows that break the contract or a QUARANTINE rule are rejected, with the record as received and what
    they broke; WARN rows pass and are reported. A FAIL rule is the gate's business (``dq.assert_silver``).
    """
    good, bad = contract.split_contract(raw, as_of, ingest_ts=ingest_ts, keep=("raw_line",))
    bad = bad.withColumn("ingest_ts", ingest_ts)
    suite = suite or dq.payment_suite(as_of)
    soft = tuple(e for e in suite if e.severity is not dq.Severity.FAIL)
    passed, routed, warned = dq.route(good, soft)
    routed = routed.select(
        *[F.col(c).cast("string").alias(c) for c in PAYMENT_COLUMNS],
        "raw_line",
        F.col("raw_line").alias("record"),
        F.col("dq_failed").alias("errors"),
        "ingest_ts",
    )
    rejected = bad.select(*routed.columns).unionByName(routed)
    return passed.drop("raw_line"), rejected, warned


def bronze_to_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    dt,
    as_of,
    ingest_ts: Column,
    quarantine_path: str | None = None,
    gate: bool = True,
    suite=None,
    index: key_index.KeyIndex | None = None,
) -> Landed:
    """Read a landing day's bronze, check it, dedup the rows that pass, gate them on the FAIL-severity
    expectations and MERGE them into silver through its key index.

    Contract, routing and gate see the whole batch *before* the MERGE, so late rows whose
    payment_date differs from ``dt`` are checked like any other and a failing batch never
    reaches silver; nor does one whose columns silver could only take by breaking its schema.
    ``ingest_ts`` is the arrival time per row; the MERGE only lets newer arrivals overwrite. The
    counts come from observations of the two jobs that store the checked rows, not from further scans.
    """
    raw = bronze.read_bronze(spark, bronze_path, dt)
    # One pass over bronze: both outcomes are stored together and read back apart.
    passed, rejected, _ = checked_rows(raw.withColumn("ingest_ts", ingest_ts), as_of, F.col("ingest_ts"), suite)
    both = passed.select(F.struct(*passed.columns).alias("good"), F.lit(None).cast(_kind(rejected)).alias("bad")).unionByName(
        rejected.select(F.lit(None).cast(_kind(passed)).alias("good"), F.struct(*rejected.columns).alias("bad"))
    )
    both, sides = ops.observed(both, "sides", good=F.count("good"), bad=F.count("bad"))
    both = tables.stored(both, "checked")
    good, bad = (both.where(f"{side} is not null").select(f"{side}.*") for side in ("good", "bad"))
    unique, kept = ops.observed(dedup_latest(good, order_by=("ingest_ts",)), "unique")
    unique = tables.stored(unique, "unique")
    if gate:
        dq.assert_silver(unique, as_of, suite, null_is_bad=True)
    changes = []
    if tables.table_exists(spark, silver_path):
        held = spark.read.parquet(silver_path).schema
        changes = schemas.assert_mergeable(held, unique.schema)
    merged = key_index.merge_indexed(spark, silver_path, unique, index, newer_only="ingest_ts")
    counts = {
        "input_rows": sides.get["rows"],
        "output_rows": kept.get["rows"],
        "rejected_rows": sides.get["good"] - kept.get["rows"],
        "quarantined_rows": sides.get["bad"],
    }
    if quarantine_path is not None and counts["quarantined_rows"]:
        contract.write_quarantine(bad, quarantine_path, dt, run_id=f"b2s_{_date(dt).isoformat()}")
    return Landed(merged.touched, counts, bad, merged.feed(spark), changes)


def _kind(df: DataFrame) -> StructType:
    return StructType([StructField(f.name, f.dataType) for f in df.schema.fields])


@dataclass(frozen=True)
class MartPaths:
    """The mart, the state it is kept up from, and the journal of its publications."""

    mart: str
    state: str
    journal: str


def refresh_mart(
    spark: SparkSession,
    paths: MartPaths,
    feed: DataFrame,
    fx: DataFrame,
    feed_id: str,
    partition_col: str = "payment_date",
    partition: Column | None = None,
) -> DataFrame:
    """Bring the mart up to date with one feed of silver changes, without reading silver.

    The feed becomes signed changes of the mart's state; only partitions (days, or what
    ``partition`` makes of a day, e.g. its month) in which one is not zero are read and replaced. A feed
    is applied once, whatever dies: its results are stored, published together with the
    mart and marked by ``feed_id``. Returns the (game, day) whose mart row may have changed (stored).
    """
    publication.finish(spark, paths.journal)

    def placed(df: DataFrame) -> DataFrame:
        return df if partition is None else df.withColumn(partition_col, partition)

    deltas = tables.stored(placed(gold.mart_deltas(feed, fx)), "mart-deltas")
    changed = deltas.select("game_key", "payment_date").distinct()
    if publication.was_published(spark, paths.journal, feed_id):
        return changed
    touched = tables.sorted_values(tables.values_of(deltas, partition_col))
    if touched:
        state = deltas.limit(0)
        if tables.table_exists(spark, paths.state):
            state = spark.read.parquet(paths.state).where(tables.in_partitions(partition_col, touched))
        folded = publication.Publication.of(placed(gold.fold_state(state, deltas)), paths.state)
        mart = publication.Publication.of(placed(gold.mart_of_state(folded.rows(spark))), paths.mart)
        publication.publish(spark, paths.journal, feed_id, [folded, mart], touched, partition_col)
    return changed


@dataclass
class Paths:
    bronze: str
    silver: str
    gold: str
    quarantine: str
    retry_queue: str | None = None
    dead_letter: str | None = None
    metrics: str | None = None
    state: str | None = None

    @property
    def journal(self) -> str:
        return f"{self.gold}/_journal"

    @property
    def fact(self) -> str:
        return f"{self.gold}/fact_payment_transaction"

    @property
    def mart(self) -> str:
        return f"{self.gold}/agg_game_daily_revenue"


@dataclass
class DayResult:
    dt: str
    merged_partitions: list = field(default_factory=list)
    quarantined_rows: int = 0
    gold_days: list = field(default_factory=list)
    orphans: dict = field(default_factory=dict)
    reconciliation: dict = field(default_factory=dict)
    replay: dict = field(default_factory=dict)
    counts: dict = field(default_factory=dict)


def run_day(
    spark: SparkSession,
    paths: Paths,
    dt,
    fx: DataFrame,
    ingest_ts: Column,
    *,
    as_of=None,
    restate_days: int = 7,
    dim_game: DataFrame | None = None,
    dim_currency: DataFrame | None = None,
    now=None,
    suite=None,
) -> DayResult:
    """One daily run over Parquet tables.

    bronze(dt) -> contract and quality routing (bad rows to quarantine) -> dedup -> FAIL-severity gate
    and schema gate -> silver MERGE of touched partitions -> replay of the due retry entries, then enqueueing of
    this run's rejects (when ``paths.retry_queue`` is set; ``now`` is the run time) -> fact and
    mart for ``dt``, the ``restate_days`` days before it and every other day that the MERGE or the
    replay touched -> referential check (when dimensions are given) and reconciliation of all
    these days, both on the stored rows and both raising -> publication to gold, fact and mart
    together, in which a day left without rows is emptied -> the run's metrics and the landed
    batches appended to their tables (``paths.metrics``, ``paths.state``); a leak of rows raises.
    """
    day = _date(dt)
    as_of = as_of or day
    run_time = str(now or f"{(day + _dt.timedelta(days=1)).isoformat()} 00:00:00")
    result = DayResult(dt=day.isoformat())
    publication.finish(spark, paths.journal)
    b2s = bronze_to_silver(spark, paths.bronze, paths.silver, day, as_of, ingest_ts, paths.quarantine, suite=suite)
    result.merged_partitions = b2s.touched
    result.quarantined_rows = b2s.quarantined
    result.counts = b2s.counts
    touched = set(b2s.touched)
    if paths.retry_queue is not None:
        result.replay = replay_quarantine(spark, paths, b2s.rejected, run_time, as_of)
        touched |= set(result.replay["merged_partitions"])

    window = {day - _dt.timedelta(days=k) for k in range(restate_days + 1)}
    days = sorted(window | {d for d in touched if d is not None})
    if tables.table_exists(spark, paths.silver):  # else nothing has ever passed the contract
        _restate(spark, paths, days, fx, dim_game, dim_currency, result)
    if paths.metrics is not None:
        ops.emit_metrics(
            ops.task_metrics(spark, "daily_payments", "bronze_to_silver", f"run_{day.isoformat()}", day.isoformat(), **b2s.counts, recorded_at=run_time),
            paths.metrics,
        )
    if paths.state is not None:
        landed = bronze.read_bronze(spark, paths.bronze, day).select(F.col("raw_line").alias("value"), "dt", "run_id")
        tables.append(ops.ingestion_record(bronze.manifest_of(landed), "OK", run_time), paths.state)
    return result


def _restate(spark: SparkSession, paths: Paths, days: list, fx: DataFrame, dim_game, dim_currency, result: DayResult) -> None:
    """Fact and mart of the days, checked as stored and published together."""
    silver = spark.read.parquet(paths.silver).where(F.col("payment_date").isin(days))
    staged_fact = publication.Publication.of(gold.build_fact(silver, fx), paths.fact)
    fact = staged_fact.rows(spark)
    staged_mart = publication.Publication.of(gold.build_agg_game_daily(fact), paths.mart)
    mart = staged_mart.rows(spark)
    if dim_game is not None and dim_currency is not None:
        summary = dq.referential_summary(fact, dim_game, dim_currency)
        result.orphans = summary.first().asDict()
        dq.assert_referential(summary)
    per_day = marts.reconciliation(silver, fact, mart).collect()  # one row a rebuilt day
    drift = [r.asDict() for r in per_day if not (r["revenue_ok"] and r["count_ok"] and r["eur_ok"])]
    result.reconciliation = next((r.asDict() for r in per_day if str(r["payment_date"]) == result.dt), {})
    if drift:
        raise dq.DQError(f"gold does not reconcile with silver on {len(drift)} days, first {drift[0]}")
    publication.publish(spark, paths.journal, f"gold-{result.dt}-{uuid.uuid4().hex}", [staged_fact, staged_mart], days, "payment_date")
    result.gold_days = days


def replay_quarantine(spark: SparkSession, paths: Paths, rejected: DataFrame, now, as_of) -> dict:
    """Re-attempt every due entry of the queue, then enqueue this run's rejects.

    The queue is partitioned by eligible day: only elapsed days are read and replayed. Valid entries are
    merged into silver (touched partitions only, never over a newer arrival), failures move to the day
    their backoff ends. Exhausted entries are written to the dead letter before they leave the queue,
    under this run's time, so a run repeated after a crash rewrites them. Rejects that the queue already holds
    are not added again.
    """
    publication.finish(spark, f"{paths.retry_queue}_journal")
    src = rejected.select(
        *PAYMENT_COLUMNS, "raw_line", F.col("ingest_ts").alias("arrived_at"), F.array_join("errors", ",").alias("_ll_err")
    )
    shape = retry.enqueue(src, F.col("_ll_err"), now).drop("_ll_err")
    queue = calendar_queue.read(spark, paths.retry_queue, shape.schema)
    fresh = retry.enqueue(src, F.col("_ll_err"), now, queue=queue).drop("_ll_err")
    elapsed = tables.stored(calendar_queue.elapsed(queue, now).select(*shape.columns), "queue-elapsed")
    out = retry.replay(elapsed, None, now, as_of)
    merged = key_index.merge_indexed(spark, paths.silver, out["good"], newer_only="ingest_ts")
    outcomes = out["outcomes"].groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).collect()
    if paths.dead_letter is not None:
        run = F.date_format(F.lit(str(now)).cast("timestamp_ntz"), "yyyyMMdd'T'HHmmss")
        tables.overwrite_partitions(out["dead"].withColumn("run", run), paths.dead_letter, "run")
    staged, days = calendar_queue.rewritten(queue, paths.retry_queue, now, out["queue"], fresh.select(*shape.columns))
    publication.publish(spark, f"{paths.retry_queue}_journal", uuid.uuid4().hex, [staged], days, calendar_queue.DAY)
    return {"queue_days": days, "merged_partitions": merged.touched, "outcomes": {r["outcome"]: r["n"] for r in outcomes}}
