"""End-to-end: landing, Parquet MERGE/erasure sinks, the daily run, stream = batch."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from ledgerlake import fixtures as fx
from ledgerlake import oracle
from ledgerlake.operators import merge as mg
from ledgerlake.plans import pipeline
from ledgerlake.session import shared_dir
from ledgerlake.sources import bronze, key_index, tables
from ledgerlake.streaming import runners


def test_merge_into_table_rewrites_only_touched_partitions(spark, tmp_path):
    silver = fx.payments_orders(spark, SF_SMALL)
    path = str(tmp_path / "silver")
    tables.overwrite_partitions(silver, path)
    late = fx.late_batch(silver).where(F.col("payment_date") < F.lit(dt.date(1996, 1, 1)))
    before = {p.name for p in (tmp_path / "silver").iterdir() if p.name.startswith("payment_date=")}
    touched = key_index.merge_indexed(spark, path, late).touched
    expected = mg.merge_upsert(silver, late)
    assert rows(spark.read.parquet(path).select(*silver.columns)) == rows(expected)
    n_days = silver.select("payment_date").distinct().count()
    assert 0 < len(touched) < n_days
    after = {p.name for p in (tmp_path / "silver").iterdir() if p.name.startswith("payment_date=")}
    assert before <= after


def test_erase_from_table_drops_emptied_partitions(spark, tmp_path):
    silver = fx.payments_orders(spark, SF_SMALL)
    path = str(tmp_path / "silver")
    tables.overwrite_partitions(silver, path)
    one_day = silver.where(F.col("payment_date") == F.lit(dt.date(1996, 3, 15))).select("transaction_id")
    ids = one_day.unionByName(fx.erasure_ids(spark, SF_SMALL))
    key_index.erase_indexed(spark, path, ids)
    left = spark.read.parquet(path)
    assert left.join(ids, "transaction_id").count() == 0
    assert left.where(F.col("payment_date") == F.lit(dt.date(1996, 3, 15))).count() == 0
    assert left.count() == mg.erase(silver, ids).count()


def test_bronze_round_trip_and_manifest(spark):
    raw = fx.raw_events(spark, SF_SMALL, resend=True)
    path = shared_dir(spark, "test-bronze")
    manifest = bronze.land_bronze(raw, path)
    back = bronze.read_bronze(spark, path)
    assert back.count() == raw.count()
    assert manifest.agg(F.sum("rows")).first()[0] == raw.count()
    day = bronze.read_bronze(spark, path, dt="2024-01-15")
    assert day.where(F.col("dt") != F.lit(dt.date(2024, 1, 15))).count() == 0


def test_run_day_end_to_end(spark):
    raw = fx.raw_events(spark, SF_SMALL, resend=True)
    paths = pipeline.Paths(
        bronze=shared_dir(spark, "rd-bronze"),
        silver=shared_dir(spark, "rd-silver"),
        gold=shared_dir(spark, "rd-gold"),
        quarantine=shared_dir(spark, "rd-quarantine"),
        retry_queue=shared_dir(spark, "rd-queue"),
        dead_letter=shared_dir(spark, "rd-dead"),
    )
    bronze.land_bronze(raw, paths.bronze)
    fxr = fx.fx_rates_events(spark, SF_SMALL)
    results = []
    for day in ("2024-01-14", "2024-01-15"):
        res = pipeline.run_day(spark, paths, day, fxr, fx.landing_ts(), as_of="2024-01-25")
        assert res.merged_partitions and res.quarantined_rows > 0
        assert res.reconciliation["count_ok"] and res.reconciliation["eur_ok"]
        results.append(res)
    # Day 1 enqueued its rejects (eligible at the run time), day 2 replayed them.
    assert results[0].replay["outcomes"] == {}
    assert sum(results[1].replay["outcomes"].values()) > 0
    silver = spark.read.parquet(paths.silver)
    mart = spark.read.parquet(paths.mart)
    assert silver.groupBy("transaction_id").count().where(F.col("count") > 1).count() == 0
    assert mart.where(F.col("payment_date") == F.lit(dt.date(2024, 1, 15))).count() > 0
    quarantine = spark.read.json(paths.quarantine)
    assert quarantine.where(F.size("errors") == 0).count() == 0


def test_stream_equals_batch(spark):
    raw = fx.raw_events(spark, SF_SMALL, resend=True)
    landed = shared_dir(spark, "sb-bronze")
    bronze.land_bronze(raw, landed)
    streamed = shared_dir(spark, "sb-stream")
    n = runners.run_bronze_stream(
        spark, landed, streamed, shared_dir(spark, "sb-ckpt"), oracle.CONTRACT_AS_OF, fx.landing_ts(),
        max_files_per_trigger=5,
    )
    assert n > 1
    batch = shared_dir(spark, "sb-batch")
    pipeline.bronze_to_silver(spark, landed, batch, None, oracle.CONTRACT_AS_OF, fx.landing_ts())
    cols = ["transaction_id", "game", "payment_date", "price", "currency", "status", "ingest_ts"]
    assert rows(spark.read.parquet(streamed).select(*cols)) == rows(spark.read.parquet(batch).select(*cols))


def test_stream_second_run_processes_nothing(spark):
    raw = fx.raw_events(spark, SF_SMALL)
    landed = shared_dir(spark, "so-bronze")
    bronze.land_bronze(raw, landed)
    silver, ckpt = shared_dir(spark, "so-silver"), shared_dir(spark, "so-ckpt")
    args = (spark, landed, silver, ckpt, oracle.CONTRACT_AS_OF, fx.landing_ts())
    assert runners.run_bronze_stream(*args) >= 1
    assert runners.run_bronze_stream(*args) == 0


def test_observed_metrics_and_leak_detection(spark):
    import pytest

    from ledgerlake.operators import ops

    silver = fx.payments_orders(spark, SF_SMALL)
    counted, obs = ops.observed(silver, "silver_rows")
    counted.write.format("noop").mode("overwrite").save()
    n = obs.get["rows"]
    assert n == silver.count()
    path = shared_dir(spark, "metrics")
    ok = ops.task_metrics(spark, "d", "t", "r1", "2025-01-01", n, n - 2, 1, 1, "2025-01-02T00:00:00")
    ops.emit_metrics(ok, path)
    bad = ops.task_metrics(spark, "d", "t", "r2", "2025-01-01", n, n - 3, 1, 1, "2025-01-02T00:00:00")
    with pytest.raises(ops.RowLeakError):
        ops.emit_metrics(bad, path)
    assert spark.read.parquet(path).count() == 2


def test_merge_into_table_keeps_null_partition_rows(spark, tmp_path):
    from decimal import Decimal

    from ledgerlake.schemas import SILVER_PAYMENT

    def row(tid, day, status="success"):
        return (tid, "g", day, Decimal("1.0000"), "EUR", status, dt.datetime(2025, 1, 1))

    path = str(tmp_path / "silver")
    tables.overwrite_partitions(spark.createDataFrame([row("a", None), row("b", dt.date(2025, 1, 1))], SILVER_PAYMENT), path)
    batch = spark.createDataFrame([row("c", None), row("b", dt.date(2025, 1, 1), "error")], SILVER_PAYMENT)
    key_index.merge_indexed(spark, path, batch)
    got = {r["transaction_id"]: r["status"] for r in spark.read.parquet(path).collect()}
    assert got == {"a": "success", "b": "error", "c": "success"}


def test_run_day_rerun_is_idempotent(spark):
    raw = fx.raw_events(spark, SF_SMALL, resend=True)
    paths = pipeline.Paths(
        bronze=shared_dir(spark, "ri-bronze"),
        silver=shared_dir(spark, "ri-silver"),
        gold=shared_dir(spark, "ri-gold"),
        quarantine=shared_dir(spark, "ri-quarantine"),
    )
    bronze.land_bronze(raw, paths.bronze)
    fxr = fx.fx_rates_events(spark, SF_SMALL)
    cols = ["transaction_id", "game", "payment_date", "price", "currency", "status", "ingest_ts"]
    snapshots = []
    for _ in range(2):
        pipeline.run_day(spark, paths, "2024-01-15", fxr, fx.landing_ts(), as_of="2024-01-25")
        snapshots.append(
            (
                rows(spark.read.parquet(paths.silver).select(*cols)),
                spark.read.json(paths.quarantine).count(),
                rows(spark.read.parquet(paths.mart)),
            )
        )
    assert snapshots[0] == snapshots[1]


def test_bronze_reads_any_data_file_and_no_manifest(spark, tmp_path):
    import gzip

    folder = tmp_path / "bronze" / "dt=2025-01-01" / "run_id=a"
    folder.mkdir(parents=True)
    lines = ['{"transaction_id":"1"}', '{"transaction_id":"2","more":1}', "not json"]
    (folder / "payments.jsonl.gz").write_bytes(gzip.compress("\n".join(lines).encode()))
    (folder / "payments.jsonl.gz.manifest.json").write_text('{"rows": 3}')
    base = str(tmp_path / "bronze")
    for df in (bronze.read_bronze(spark, base, "2025-01-01"), bronze.read_bronze(spark, base)):
        assert sorted(r["raw_line"] for r in df.collect()) == sorted(lines)
        assert {(str(r["dt"]), r["run_id"]) for r in df.collect()} == {("2025-01-01", "a")}
    assert bronze.read_bronze(spark, base, "2025-01-02").count() == 0


def _line(tid, day, price="1.5", status="success", **more):
    import json

    return json.dumps({"transaction_id": tid, "game": "g", "payment_date": day, "price": price, "currency": "EUR", "status": status, **more})


def _land(spark, paths, dt_, lines, run="a"):
    bronze.land_bronze(spark.createDataFrame([(x,) for x in lines], "raw_line string"), paths.bronze, dt_, run)


def _day_paths(spark, name, queue=True):
    parts = ["bronze", "silver", "gold", "quarantine"] + ["retry_queue", "dead_letter"] * queue
    return pipeline.Paths(**{p: shared_dir(spark, f"{name}-{p}") for p in parts})


def _rates(spark):
    return spark.createDataFrame([("EUR", dt.date(2025, 1, 1), 1)], "currency_code string, rate_date date, rate_to_eur int")


def test_late_rows_reach_gold_and_an_emptied_day_goes(spark):
    paths = _day_paths(spark, "late", queue=False)
    _land(spark, paths, "2025-01-20", [_line("1", "2025-01-01"), _line("2", "2025-01-20"), _line("3", "2025-01-19")])
    pipeline.run_day(spark, paths, "2025-01-20", _rates(spark), fx.landing_ts())
    days = {str(r[0]) for r in spark.read.parquet(paths.mart).select("payment_date").collect()}
    assert days == {"2025-01-01", "2025-01-19", "2025-01-20"}
    key_index.erase_indexed(spark, paths.silver, spark.createDataFrame([("3",)], "transaction_id string"))
    _land(spark, paths, "2025-01-21", [_line("4", "2025-01-21")])
    pipeline.run_day(spark, paths, "2025-01-21", _rates(spark), fx.landing_ts())
    for path in (paths.fact, paths.mart):
        days = {str(r[0]) for r in spark.read.parquet(path).select("payment_date").collect()}
        assert days == {"2025-01-01", "2025-01-20", "2025-01-21"}


def test_an_orphan_stops_the_run_before_gold(spark):
    import pytest

    from ledgerlake.operators.dq import DQError

    paths = _day_paths(spark, "orphan", queue=False)
    _land(spark, paths, "2025-01-01", [_line("1", "2025-01-01")])
    games = spark.createDataFrame([("other", True)], "game_key string, is_current boolean")
    codes = spark.createDataFrame([("EUR",)], "currency_code string")
    with pytest.raises(DQError, match="fact_game_orphans=1"):
        pipeline.run_day(spark, paths, "2025-01-01", _rates(spark), fx.landing_ts(), dim_game=games, dim_currency=codes)
    assert not tables.table_exists(spark, paths.fact)


def test_quarantine_keeps_the_received_line(spark):
    paths = _day_paths(spark, "kept", queue=False)
    bad = [_line("1", "2025-01-01", extra="x"), "broken {", _line("2", "2025-01-01", price="-1")]
    _land(spark, paths, "2025-01-01", [*bad, _line("3", "2025-01-01")])
    pipeline.run_day(spark, paths, "2025-01-01", _rates(spark), fx.landing_ts())
    stored = spark.read.json(paths.quarantine)
    assert sorted(r["record"] for r in stored.collect()) == sorted(bad)
    assert stored.where(F.size("errors") == 0).count() == 0


def test_replay_order_rerun_and_newer_rows(spark):
    paths = _day_paths(spark, "queue")
    future = _line("1", "2025-01-03")  # not valid before its day
    _land(spark, paths, "2025-01-01", [future, "broken a", "broken b", _line("9", "2025-01-01")])
    first = pipeline.run_day(spark, paths, "2025-01-01", _rates(spark), fx.landing_ts())
    queue = spark.read.parquet(paths.retry_queue)
    assert first.replay["outcomes"] == {} and queue.count() == 3  # replayed before it was filled; broken lines stay apart
    assert {r["attempt_count"] for r in queue.collect()} == {1}
    pipeline.run_day(spark, paths, "2025-01-01", _rates(spark), fx.landing_ts())
    assert spark.read.parquet(paths.retry_queue).select("queue_id").distinct().count() == 3
    assert spark.read.parquet(paths.retry_queue).count() == 3
    _land(spark, paths, "2025-01-03", [_line("1", "2025-01-03", status="refunded")])
    last = pipeline.run_day(spark, paths, "2025-01-03", _rates(spark), fx.landing_ts(), now="2025-01-09 00:00:00")
    assert last.replay["outcomes"]["merged"] == 1
    status = {r["transaction_id"]: r["status"] for r in spark.read.parquet(paths.silver).collect()}
    assert status == {"1": "refunded", "9": "success"}  # the older arrival did not overwrite the newer one


def test_dead_letter_is_keyed_by_run(spark):
    paths = _day_paths(spark, "dead")
    _land(spark, paths, "2025-01-01", ["broken"])
    now = dt.datetime(2025, 1, 2)
    for k in range(8):
        b2s = bronze.read_bronze(spark, paths.bronze, "2025-01-01").withColumn("ingest_ts", F.lit(None).cast("timestamp_ntz"))
        rejected = b2s.withColumn("errors", F.array(F.lit("price_invalid"))).where(F.lit(k == 0))
        pipeline.replay_quarantine(spark, paths, rejected, str(now + dt.timedelta(days=10 * k)), "2025-01-02")
    dead = spark.read.parquet(paths.dead_letter)
    assert [(r["attempt_count"], r["raw_line"]) for r in dead.collect()] == [(5, "broken")]
