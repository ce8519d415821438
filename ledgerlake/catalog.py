"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query composes fixtures (derived from the driver's tables) with library operators. The
DuckDB twin of every query that has one lives in ``ledgerlake.oracle.SQL`` under the same key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import fixtures as fx
from ledgerlake import oracle, schemas
from ledgerlake.operators import gold, marts, ops
from ledgerlake.session import shared_dir
from ledgerlake.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


# --- gold slice over F1 -----------------------------------------------------------------------
def fact_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.build_fact(fx.payments_orders(spark, sf_dir), fx.fx_rates_orders(spark, sf_dir))


def mart_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.build_agg_game_daily(fact_f1(spark, sf_dir))


@query("agg_game_daily")
def q_agg_game_daily(spark, sf_dir):
    return mart_f1(spark, sf_dir)


@query("fact_payment")
def q_fact_payment(spark, sf_dir):
    return fact_f1(spark, sf_dir)


@query("masked_fact")
def q_masked_fact(spark, sf_dir):
    return gold.masked_fact(fact_f1(spark, sf_dir))


@query("kpi_rolling")
def q_kpi_rolling(spark, sf_dir):
    return marts.kpi_rolling(mart_f1(spark, sf_dir))


@query("kpi_rolling_calendar")
def q_kpi_rolling_calendar(spark, sf_dir):
    return marts.kpi_rolling_calendar(mart_f1(spark, sf_dir))


@query("kpi_anomalies")
def q_kpi_anomalies(spark, sf_dir):
    return marts.kpi_anomalies(mart_f1(spark, sf_dir))


@query("data_freshness")
def q_data_freshness(spark, sf_dir):
    return marts.data_freshness(mart_f1(spark, sf_dir), oracle.FRESHNESS_AS_OF)


@query("reconciliation_gold")
def q_reconciliation_gold(spark, sf_dir):
    return marts.reconciliation_gold(mart_f1(spark, sf_dir))


@query("dim_date")
def q_dim_date(spark, sf_dir):
    return gold.dim_date(fx.payments_orders(spark, sf_dir))


@query("partition_volume")
def q_partition_volume(spark, sf_dir):
    return ops.partition_volume(fx.payments_orders(spark, sf_dir), oracle.PARTITION_VOLUME_THRESHOLD)


# --- dedup / merge / change feed / erasure / restatement over F1 --------------------------------
from ledgerlake.operators import merge as mg  # noqa: E402
from ledgerlake.plans import pipeline  # noqa: E402


def merged_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = fx.payments_orders(spark, sf_dir)
    return mg.merge_upsert(silver, fx.late_batch(silver))


@query("dedup_latest")
def q_dedup_latest(spark, sf_dir):
    silver = fx.payments_orders(spark, sf_dir)
    return mg.dedup_latest(silver.unionByName(fx.duplicate_batch(silver)))


@query("merge_upsert")
def q_merge_upsert(spark, sf_dir):
    return merged_f1(spark, sf_dir)


@query("merge_idempotent")
def q_merge_idempotent(spark, sf_dir):
    silver = fx.payments_orders(spark, sf_dir)
    late = fx.late_batch(silver)
    return mg.merge_upsert(mg.merge_upsert(silver, late), late)


@query("erase_ids")
def q_erase_ids(spark, sf_dir):
    return mg.erase(fx.payments_orders(spark, sf_dir), fx.erasure_ids(spark, sf_dir))


@query("change_feed")
def q_change_feed(spark, sf_dir):
    old = fx.payments_orders(spark, sf_dir)
    new = mg.erase(mg.merge_upsert(old, fx.late_batch(old)), fx.erasure_ids(spark, sf_dir))
    return mg.change_feed(old, new)


@query("restate_window")
def q_restate_window(spark, sf_dir):
    _, mart = pipeline.restate_window(
        merged_f1(spark, sf_dir), fx.fx_rates_orders(spark, sf_dir), oracle.RESTATE_DT, oracle.RESTATE_DAYS
    )
    return mart


# --- the table kept up through its key index, and what follows from its changes ----------------------
from ledgerlake.sources import key_index  # noqa: E402

#: Orders are spread thinly over 2,400 days; the stored tables are partitioned by month.
MONTH = "payment_month"


def _month() -> Column:
    return F.trunc("payment_date", "month")


def _indexed(spark, sf_dir):
    """Path of silver after a first load, a late batch and an erasure, all through the index, and the two changes."""
    silver = fx.payments_orders(spark, sf_dir)
    path = shared_dir(spark, "silver-indexed")
    index = key_index.index_of(path, partition_col=MONTH, n_buckets=16)
    key_index.merge_indexed(spark, path, silver.withColumn(MONTH, _month()), index)
    late = key_index.merge_indexed(spark, path, fx.late_batch(silver).withColumn(MONTH, _month()), index)
    erased = key_index.erase_indexed(spark, path, fx.erasure_ids(spark, sf_dir), index)
    return path, (late, erased)


@query("merge_indexed")
def q_merge_indexed(spark, sf_dir):
    path, _ = _indexed(spark, sf_dir)
    return spark.read.parquet(path).drop(MONTH)


def _kept_up(spark, sf_dir):
    """The mart before, the mart kept up by the feeds of a MERGE and an erasure, and its changed (game, day)."""
    rates = fx.fx_rates_orders(spark, sf_dir)
    fact = gold.build_fact(fx.payments_orders(spark, sf_dir), rates)
    folder = shared_dir(spark, "mart-kept-up")
    paths = pipeline.MartPaths(f"{folder}/mart", f"{folder}/state", f"{folder}/journal")
    tables.overwrite_partitions(gold.mart_state(fact).withColumn(MONTH, _month()), paths.state, MONTH)
    state = spark.read.parquet(paths.state)
    tables.overwrite_partitions(gold.mart_of_state(state).withColumn(MONTH, _month()), paths.mart, MONTH)
    before = tables.stored(spark.read.parquet(paths.mart).drop(MONTH), "mart-before")
    _, changes = _indexed(spark, sf_dir)
    changed = None
    for k, change in enumerate(changes):
        rows = pipeline.refresh_mart(spark, paths, change.feed(spark).drop(MONTH), rates, f"feed-{k}", MONTH, _month())
        changed = rows if changed is None else changed.unionByName(rows)
    return before, spark.read.parquet(paths.mart).drop(MONTH), changed


@query("mart_from_changes")
def q_mart_from_changes(spark, sf_dir):
    return _kept_up(spark, sf_dir)[1]


@query("kpi_refresh")
def q_kpi_refresh(spark, sf_dir):
    """Rolling and anomaly views brought to the changed mart: only the ranges that changes reach are computed."""
    before, mart, changed = _kept_up(spark, sf_dir)
    views = tables.stored(marts.kpi_views(before), "kpi-views")
    return marts.refresh_kpis(views, mart, changed)


@query("reconcile_rows")
def q_reconcile_rows(spark, sf_dir):
    """Silver before against silver after a late batch and an erasure, row by row where digests differ."""
    old = fx.payments_orders(spark, sf_dir)
    new = mg.erase(mg.merge_upsert(old, fx.late_batch(old)), fx.erasure_ids(spark, sf_dir))
    return marts.reconcile_rows(old, new)


# --- contract and data quality over F2 ---------------------------------------------------------
from ledgerlake.operators import contract, dq  # noqa: E402


def checked_f2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.with_errors(fx.raw_events(spark, sf_dir), oracle.CONTRACT_AS_OF)


@query("contract_errors")
def q_contract_errors(spark, sf_dir):
    return contract.error_summary(checked_f2(spark, sf_dir))


@query("quarantine_rows")
def q_quarantine_rows(spark, sf_dir):
    _, bad = contract.split_contract(fx.raw_events(spark, sf_dir), oracle.CONTRACT_AS_OF)
    return bad.select("transaction_id", F.array_join("errors", ",").alias("errors"))


@query("contract_valid")
def q_contract_valid(spark, sf_dir):
    good, _ = contract.split_contract(fx.raw_events(spark, sf_dir), oracle.CONTRACT_AS_OF)
    return good


@query("dq_evaluate")
def q_dq_evaluate(spark, sf_dir):
    return dq.evaluate(fx.payments_events_dirty(spark, sf_dir), dq.payment_suite(oracle.DQ_AS_OF))


@query("dq_quarantined")
def q_dq_quarantined(spark, sf_dir):
    _, quarantined, _ = dq.route(fx.payments_events_dirty(spark, sf_dir), dq.payment_suite(oracle.DQ_AS_OF))
    return quarantined.select("transaction_id", F.array_join("dq_failed", ",").alias("dq_failed"))


@query("dq_bad_ids")
def q_dq_bad_ids(spark, sf_dir):
    return dq.bad_ids(fx.payments_events_dirty(spark, sf_dir), dq.payment_suite(oracle.DQ_AS_OF))


# --- retry queue over F2 rejects ---------------------------------------------------------------
from ledgerlake.operators import retry  # noqa: E402

QUEUE_COLS = ("queue_id", "transaction_id", "attempt_count", "last_error", "eligible_at")


@query("retry_enqueue")
def q_retry_enqueue(spark, sf_dir):
    checked = contract.with_errors(fx.raw_events(spark, sf_dir), oracle.RETRY_ENQUEUE_AS_OF)
    bad = checked.where(F.size("errors") > 0).select(
        "transaction_id", "game", "payment_date", "price", "currency", "status", "raw_line",
        F.array_join("errors", ",").alias("_err"),
    )
    q = retry.enqueue(bad, F.col("_err"), oracle.ENQUEUE_NOW)
    return q.select(*QUEUE_COLS)


@query("retry_due")
def q_retry_due(spark, sf_dir):
    return retry.due(fx.retry_queue(spark, sf_dir), oracle.RETRY_NOW).select(*QUEUE_COLS)


def _rescheduled(spark, sf_dir):
    queue = fx.retry_queue(spark, sf_dir)
    return retry.reschedule(queue, retry.due(queue, oracle.RETRY_NOW), oracle.RETRY_NOW)


@query("retry_reschedule")
def q_retry_reschedule(spark, sf_dir):
    return _rescheduled(spark, sf_dir)[0].select(*QUEUE_COLS)


@query("dead_letter")
def q_dead_letter(spark, sf_dir):
    return _rescheduled(spark, sf_dir)[1].select(*QUEUE_COLS)


@query("replay")
def q_replay(spark, sf_dir):
    silver = contract.split_contract(fx.raw_events(spark, sf_dir), oracle.RETRY_ENQUEUE_AS_OF)[0]
    out = retry.replay(fx.retry_queue(spark, sf_dir), silver, oracle.RETRY_NOW, oracle.RETRY_REPLAY_AS_OF)
    return out["outcomes"].select("queue_id", "transaction_id", "attempt_count", "outcome")


def _replayed(spark, sf_dir):
    silver = contract.split_contract(fx.raw_events(spark, sf_dir), oracle.RETRY_ENQUEUE_AS_OF)[0]
    return retry.replay(fx.retry_queue(spark, sf_dir), silver, oracle.RETRY_NOW, oracle.RETRY_REPLAY_AS_OF)


@query("replay_silver")
def q_replay_silver(spark, sf_dir):
    return _replayed(spark, sf_dir)["silver"]


@query("replay_queue")
def q_replay_queue(spark, sf_dir):
    return _replayed(spark, sf_dir)["queue"].select(*QUEUE_COLS)


@query("quarantine_sink")
def q_quarantine_sink(spark, sf_dir):
    """The stored quarantine of all landing days, read back: records as received and their errors."""
    _, bad = contract.split_contract(fx.raw_events(spark, sf_dir), oracle.CONTRACT_AS_OF)
    path = shared_dir(spark, "quarantine")
    contract.write_quarantine(bad, path, oracle.B2S_DT, "all")
    back = spark.read.schema("record string, errors array<string>").json(path)
    return back.select("record", F.array_join("errors", ",").alias("errors"))


# --- dimensions, SCD2, joins, reconciliation over F1 ------------------------------------------------
from ledgerlake.operators import joins, scd2  # noqa: E402


def scd_f1(spark, sf_dir):
    return scd2.scd2_apply(fx.dim_game(spark, sf_dir), fx.game_updates(spark, sf_dir), oracle.SCD2_AS_OF)


@query("scd2_apply")
def q_scd2_apply(spark, sf_dir):
    return scd_f1(spark, sf_dir)


@query("scd2_backdated")
def q_scd2_backdated(spark, sf_dir):
    """Statements recorded out of order, applied in two batches, the later times first."""
    updates = fx.game_history(spark, sf_dir)
    timeline = scd2.scd2_timeline(fx.dim_game(spark, sf_dir))
    for batch in (F.month("at") > 6, F.month("at") <= 6):
        timeline = scd2.scd2_record(timeline, updates.where(batch))
    return scd2.scd2_of_timeline(timeline)


@query("scd2_asof")
def q_scd2_asof(spark, sf_dir):
    fact = fact_f1(spark, sf_dir).select("transaction_id", "game_key", "payment_date")
    return scd2.scd2_asof(fact, scd_f1(spark, sf_dir))


@query("salted_join")
def q_salted_join(spark, sf_dir):
    fact = fact_f1(spark, sf_dir).select("transaction_id", "game_key")
    dim = fx.dim_game(spark, sf_dir).select("game_key", "genre", "is_current")
    return joins.salted_join(fact, dim, "game_key", n_salt=16)


@query("orphans_game")
def q_orphans_game(spark, sf_dir):
    return joins.orphans(fact_f1(spark, sf_dir), fx.dim_game(spark, sf_dir), "game_key", "game_key")


@query("orphans_currency")
def q_orphans_currency(spark, sf_dir):
    return joins.orphans(fact_f1(spark, sf_dir), fx.dim_currency(spark, sf_dir), "currency_key", "currency_code")


@query("referential_summary")
def q_referential_summary(spark, sf_dir):
    return dq.referential_summary(fact_f1(spark, sf_dir), fx.dim_game(spark, sf_dir), fx.dim_currency(spark, sf_dir))


@query("reconciliation")
def q_reconciliation(spark, sf_dir):
    silver = fx.payments_orders(spark, sf_dir)
    fact = gold.build_fact(silver, fx.fx_rates_orders(spark, sf_dir))
    return marts.reconciliation(silver, fact, gold.build_agg_game_daily(fact))


@query("silver_to_gold")
def q_silver_to_gold(spark, sf_dir):
    _, mart = pipeline.silver_to_gold(
        fx.payments_orders(spark, sf_dir), fx.fx_rates_orders(spark, sf_dir), oracle.SILVER_TO_GOLD_DT
    )
    return mart


# --- metrics, SLO views and alarms over F2; manifests over F1 ---------------------------------
@query("completeness")
def q_completeness(spark, sf_dir):
    return marts.completeness(fx.pipeline_metrics(spark, sf_dir))


@query("row_balance")
def q_row_balance(spark, sf_dir):
    return ops.row_balance(fx.pipeline_metrics(spark, sf_dir))


@query("quarantine_spike")
def q_quarantine_spike(spark, sf_dir):
    return ops.slo_alarms(fx.pipeline_metrics(spark, sf_dir), quarantine_threshold=oracle.QUARANTINE_SPIKE_ROWS)


@query("freshness_alarm")
def q_freshness_alarm(spark, sf_dir):
    return ops.freshness_alarm(marts.data_freshness(mart_f1(spark, sf_dir), oracle.STALE_AS_OF))


@query("reconciliation_alarm")
def q_reconciliation_alarm(spark, sf_dir):
    """Silver after a late batch against the fact and mart from before it: the days that have drifted."""
    fact = fact_f1(spark, sf_dir)
    return ops.reconciliation_alarm(marts.reconciliation(merged_f1(spark, sf_dir), fact, gold.build_agg_game_daily(fact)))


@query("batch_manifest")
def q_batch_manifest(spark, sf_dir):
    return fx.manifests(fx.payments_orders(spark, sf_dir))


@query("new_batches")
def q_new_batches(spark, sf_dir):
    manifest = fx.manifests(fx.payments_orders(spark, sf_dir))
    return ops.new_batches(manifest, fx.ingestion_state(manifest))


@query("ingestion_record")
def q_ingestion_record(spark, sf_dir):
    return ops.ingestion_record(fx.manifests(fx.payments_orders(spark, sf_dir)), "OK", oracle.RECORDED_AT)


@query("schema_evolve")
def q_schema_evolve(spark, sf_dir):
    """Rows of an older shape (no currency, price as text) brought to the silver schema."""
    older = fx.payments_orders(spark, sf_dir).drop("currency").withColumn("price", F.col("price").cast("string"))
    return schemas.evolve(older, schemas.SILVER_PAYMENT)


@query("table_layout")
def q_table_layout(spark, sf_dir):
    """Silver written in its layout (by month, as its days are sparse; sorted, Bloom filter on the key) and scanned again."""
    path = shared_dir(spark, "layout")
    rows = fx.payments_orders(spark, sf_dir)
    laid = tables.write_layout(rows.withColumn(MONTH, _month()), MONTH)
    tables.overwrite_partitions(laid, path, MONTH, bloom_filter_cols=("transaction_id",))
    return tables.read_table(spark, path).select(*rows.columns)


# --- bronze landing, lean tier, bronze -> silver batch and stream over F2 --------------------------
import datetime as _dt  # noqa: E402

from ledgerlake.sources import bronze, schema_history  # noqa: E402
from ledgerlake.streaming import runners  # noqa: E402


def _landed(spark, sf_dir) -> str:
    """Land the F2 raw records (with re-sends) into a fresh bronze folder in the shared dir."""
    path = shared_dir(spark, "bronze")
    bronze.land_bronze(fx.raw_events(spark, sf_dir, resend=True), path)
    return path


@query("bronze_scan")
def q_bronze_scan(spark, sf_dir):
    raw = bronze.read_bronze(spark, _landed(spark, sf_dir))
    return raw.select("transaction_id", "game", "payment_date", "price", "currency", "status", "dt", "run_id")


@query("lean_transform")
def q_lean_transform(spark, sf_dir):
    raw = contract.with_errors(fx.raw_events(spark, sf_dir, resend=True), oracle.CONTRACT_AS_OF)
    valid = raw.where(F.size("errors") == 0).drop("errors")
    return pipeline.lean_transform(valid, oracle.LEAN_DT)


@query("lean_stored")
def q_lean_stored(spark, sf_dir):
    """The lean tier's day as its ZSTD table holds it."""
    path = shared_dir(spark, "lean")
    pipeline.write_lean(q_lean_transform(spark, sf_dir), path)
    return spark.read.parquet(path)


@query("bronze_to_silver")
def q_bronze_to_silver(spark, sf_dir):
    landed = _landed(spark, sf_dir)
    silver = shared_dir(spark, "silver")
    day = _dt.date.fromisoformat(oracle.B2S_DT)
    for dt in (day - _dt.timedelta(days=1), day):
        pipeline.bronze_to_silver(spark, landed, silver, dt, oracle.CONTRACT_AS_OF, fx.landing_ts())
    return spark.read.parquet(silver)


@query("run_day_gold")
def q_run_day_gold(spark, sf_dir):
    """The stored mart after two daily runs, the second with rows of the first day, 13 days late."""
    raw = fx.raw_events(spark, sf_dir, resend=True)
    late = (F.col("dt") == F.lit(oracle.LATE_FROM_DT).cast("date")) & (F.pmod("_id", F.lit(7)) == 3)
    raw = raw.withColumn("dt", F.when(late, F.lit(oracle.B2S_DT).cast("date")).otherwise(F.col("dt")))
    folders = {name: shared_dir(spark, f"day-{name}") for name in ("bronze", "silver", "gold", "quarantine")}
    paths = pipeline.Paths(**folders)
    bronze.land_bronze(raw, paths.bronze)
    rates = fx.fx_rates_events(spark, sf_dir)
    for dt in (oracle.LATE_FROM_DT, oracle.B2S_DT):
        pipeline.run_day(spark, paths, dt, rates, fx.landing_ts(), as_of=oracle.CONTRACT_AS_OF)
    return spark.read.parquet(paths.mart)


@query("stream_upsert")
def q_stream_upsert(spark, sf_dir):
    landed = _landed(spark, sf_dir)
    silver = shared_dir(spark, "silver")
    runners.run_bronze_stream(
        spark, landed, silver, shared_dir(spark, "ckpt"), oracle.CONTRACT_AS_OF, fx.landing_ts(),
        max_files_per_trigger=16,
    )
    return spark.read.parquet(silver)


@query("stream_quarantine_spike")
def q_stream_quarantine_spike(spark, sf_dir):
    """Contract rejects of the landed lines by hour of arrival, counted by a stream."""
    out = shared_dir(spark, "alarm")
    rejects = runners.rejected_stream(spark, _landed(spark, sf_dir), oracle.CONTRACT_AS_OF, fx.landing_ts())
    runners.quarantine_spike_stream(rejects, out, shared_dir(spark, "ckpt"))
    return runners.spike_alarms(spark, out, oracle.QUARANTINE_SPIKE_ROWS)


@query("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """Landed lines, each sent twice, without the copies that arrive within two days."""
    raw = fx.raw_events(spark, sf_dir)
    path, out = shared_dir(spark, "bronze-twice"), shared_dir(spark, "resent")
    bronze.land_bronze(raw.unionByName(raw.withColumn("run_id", F.lit("b"))), path)
    lines = runners.without_resends(bronze.stream_bronze(spark, path), fx.landing_ts(), "2 days")
    runners.drain(lines.select("value", "dt"), out, shared_dir(spark, "ckpt"))
    return spark.read.parquet(out).select("value", "dt")


@query("run_metrics")
def q_run_metrics(spark, sf_dir):
    """The metrics that two daily runs with all their parts wrote, as their tables hold them."""
    paths = _full_runs(spark, sf_dir)
    return spark.read.parquet(paths.metrics)


def _full_runs(spark, sf_dir):
    """Two daily runs with retry queue, dead letter, dimensions, metrics and ingestion state."""
    names = ("bronze", "silver", "gold", "quarantine", "retry_queue", "dead_letter", "metrics", "state")
    paths = pipeline.Paths(**{name: shared_dir(spark, f"full-{name}") for name in names})
    raw = fx.raw_events(spark, sf_dir, resend=True)
    bronze.land_bronze(raw, paths.bronze)
    rates = fx.fx_rates_events(spark, sf_dir)
    games = fx.payments_events(spark, sf_dir).select(F.col("game").alias("game_key")).distinct().withColumn("is_current", F.lit(True))
    day = _dt.date.fromisoformat(oracle.B2S_DT)
    for dt in (day - _dt.timedelta(days=1), day):
        pipeline.run_day(
            spark, paths, dt, rates, fx.landing_ts(), as_of=dt, dim_game=games, dim_currency=gold.dim_currency(rates)
        )
    return paths


@query("retry_cycle")
def q_retry_cycle(spark, sf_dir):
    """Queue and dead letter after six daily replays, each of which also brings new rejects."""
    names = ("bronze", "silver", "gold", "quarantine", "retry_queue", "dead_letter")
    paths = pipeline.Paths(**{name: shared_dir(spark, f"cycle-{name}") for name in names})
    first = _dt.date.fromisoformat(fx.RETRY_CYCLE_FROM)
    for k in range(fx.RETRY_CYCLE_RUNS):
        now = f"{first + _dt.timedelta(days=k)} 00:00:00"
        as_of = _dt.date.fromisoformat(oracle.RETRY_ENQUEUE_AS_OF) + _dt.timedelta(days=k)
        pipeline.replay_quarantine(spark, paths, fx.retry_rejects(spark, sf_dir, k), now, as_of)
    dead = spark.read.parquet(paths.dead_letter)
    place = lambda df, name: df.select("queue_id", "transaction_id", "attempt_count", "eligible_at", F.lit(name).alias("place"))
    return place(spark.read.parquet(paths.retry_queue), "queue").unionByName(place(dead, "dead"))


@query("schema_history_scan")
def q_schema_history_scan(spark, sf_dir):
    """Payments of three schema versions (currency came in 1994, its arrival time in 1997), read in the newest."""
    path = shared_dir(spark, "versions")
    rows = fx.payments_orders(spark, sf_dir).withColumn("payment_year", F.year("payment_date"))
    year = F.col("payment_year")
    schema_history.write_versioned(rows.where(year < 1994).drop("currency", "ingest_ts"), path, "payment_year")
    schema_history.write_versioned(rows.where((year >= 1994) & (year < 1997)).drop("ingest_ts"), path, "payment_year")
    schema_history.write_versioned(rows.where(year >= 1997), path, "payment_year")
    return schema_history.scan(spark, path, "payment_year").drop("payment_year")


@query("dim_currency")
def q_dim_currency(spark, sf_dir):
    return gold.dim_currency(fx.payments_orders(spark, sf_dir), column="currency")
