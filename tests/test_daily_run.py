"""The daily run's parts: calendar queue, routing, metrics, schema gate and versions, stream re-sends, skewed NULL keys."""

import datetime as dt
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerlake import fixtures as fx
from ledgerlake.operators import dq, joins, ops
from ledgerlake.plans import pipeline
from ledgerlake.session import shared_dir
from ledgerlake.sources import bronze, calendar_queue, schema_history, tables
from ledgerlake.streaming import runners


def line(tid, day, price="1.5", status="success", **more):
    return json.dumps({"transaction_id": tid, "game": "g", "payment_date": day, "price": price, "currency": "EUR", "status": status, **more})


def land(spark, path, day, lines, run="a"):
    bronze.land_bronze(spark.createDataFrame([(x,) for x in lines], "raw_line string"), path, day, run)


def full_paths(spark):
    names = ("bronze", "silver", "gold", "quarantine", "retry_queue", "dead_letter", "metrics", "state")
    return pipeline.Paths(**{n: shared_dir(spark, f"dr-{n}") for n in names})


def fx_rates(spark):
    return spark.createDataFrame([("EUR", dt.date(2025, 1, 1), 1)], "currency_code string, rate_date date, rate_to_eur int")


def test_a_run_routes_rows_and_accounts_for_every_one(spark):
    paths = full_paths(spark)
    lines = [line("1", "2025-01-01"), line("2", "2025-01-01", price="5000"), "broken {", line("1", "2025-01-01", status="error"), line("3", "2025-01-01")]
    land(spark, paths.bronze, "2025-01-01", lines)
    suite = (*dq.payment_suite("2025-01-01"), dq.Expectation("price_usual", "price < 1000", dq.Severity.QUARANTINE))
    res = pipeline.run_day(spark, paths, "2025-01-01", fx_rates(spark), fx.landing_ts(), suite=suite)
    assert res.counts == {"input_rows": 5, "output_rows": 2, "rejected_rows": 1, "quarantined_rows": 2}
    stored = {r["record"]: r["errors"] for r in spark.read.json(paths.quarantine).collect()}
    assert stored[lines[1]] == ["price_usual"] and set(stored) == {lines[1], lines[2]}
    assert {r[0] for r in spark.read.parquet(paths.silver).select("transaction_id").collect()} == {"1", "3"}
    metrics = spark.read.parquet(paths.metrics)
    assert metrics.count() == 1 and ops.row_balance(metrics).count() == 0
    manifest = bronze.manifest_of(bronze.read_bronze(spark, paths.bronze).select(F.col("raw_line").alias("value"), "dt", "run_id"))
    assert ops.new_batches(manifest, spark.read.parquet(paths.state)).count() == 0
    assert spark.read.parquet(paths.retry_queue).count() == 2


def test_a_breaking_schema_stops_before_the_merge(spark):
    paths = full_paths(spark)
    old = spark.createDataFrame([("9", dt.date(2025, 1, 1), 5)], "transaction_id string, payment_date date, price int")
    tables.overwrite_partitions(old, paths.silver)
    land(spark, paths.bronze, "2025-01-01", [line("1", "2025-01-01")])
    with pytest.raises(ValueError, match="price"):
        pipeline.run_day(spark, paths, "2025-01-01", fx_rates(spark), fx.landing_ts())
    assert spark.read.parquet(paths.silver).count() == 1 and not tables.table_exists(spark, paths.fact)


def test_due_opens_elapsed_days_only(spark):
    path = shared_dir(spark, "cal-queue")
    schema = "queue_id string, eligible_at timestamp_ntz"
    rows_ = [(f"q{d}", dt.datetime(2025, 1, d, 12)) for d in range(1, 11)]
    df = spark.createDataFrame(rows_, schema)
    tables.overwrite_partitions(calendar_queue.with_day(df), path, calendar_queue.DAY)
    queue = calendar_queue.read(spark, path, df.schema)
    now = "2025-01-04 13:00:00"
    due = calendar_queue.elapsed(queue, now)
    assert due.count() == 4 and "PartitionFilters: [isnotnull(eligible_day" in due._jdf.queryExecution().executedPlan().toString()
    left = spark.createDataFrame([("q1", dt.datetime(2025, 1, 7, 1)), ("q4", dt.datetime(2025, 1, 4, 20))], schema)
    fresh = spark.createDataFrame([("new", dt.datetime(2025, 1, 4, 13))], schema)
    staged, days = calendar_queue.rewritten(queue, path, now, left, fresh)
    assert days == [dt.date(2025, 1, d) for d in (1, 2, 3, 4, 7)]  # nothing else is written
    tables.replace_days(staged.rows(spark), path, days, calendar_queue.DAY)
    got = sorted((r["queue_id"], r["eligible_at"].day) for r in spark.read.parquet(path).collect())
    assert got == sorted([("q1", 7), ("q4", 4), ("new", 4), *((f"q{d}", d) for d in range(5, 11))])


def test_versions_are_read_with_their_own_schemas(spark):
    path = shared_dir(spark, "versions")

    def frame(data, schema):
        return spark.createDataFrame(data, schema)

    assert schema_history.write_versioned(frame([(1, "a", 2020)], "id long, x string, y int"), path, "y") == 1
    assert schema_history.write_versioned(frame([(2, "b", 7, 2021)], "id long, x string, z int, y int"), path, "y") == 2
    assert schema_history.write_versioned(frame([(3, "c", 2022)], "id long, x string, y int").withColumn("z", F.lit(1)), path, "y") == 2
    with pytest.raises(ValueError, match="x"):
        schema_history.write_versioned(frame([(4, 5, 1, 2023)], "id long, x int, z int, y int"), path, "y")
    with pytest.raises(ValueError, match="missing"):
        schema_history.write_versioned(frame([(4, "d", 2023)], "id long, x string, y int"), path, "y")
    got = schema_history.scan(spark, path, "y")
    assert rows(got, "id", "x", "z", "y") == [(1, "a", None, 2020), (2, "b", 7, 2021), (3, "c", 1, 2022)]
    schema_history.write_versioned(frame([(9, "n", 5, 2020)], "id long, x string, z int, y int"), path, "y")  # the old year, new schema
    assert rows(schema_history.scan(spark, path, "y"), "id", "z")[0] == (2, 7)
    assert (9, 5) in rows(schema_history.scan(spark, path, "y"), "id", "z")


def test_resends_within_the_watermark_go_and_later_ones_reach_the_merge(spark):
    landed = shared_dir(spark, "resent")
    land(spark, landed, "2025-01-01", [line("1", "2025-01-01"), line("2", "2025-01-01")])
    land(spark, landed, "2025-01-01", [line("1", "2025-01-01"), line("1", "2025-01-01", status="error")], run="b")
    silver, ckpt, metrics = (shared_dir(spark, f"rs-{x}") for x in ("silver", "ckpt", "metrics"))

    def drain():
        return runners.run_bronze_stream(
            spark, landed, silver, ckpt, "2025-03-01", fx.landing_ts(), metrics_path=metrics, resend_within="1 day"
        )

    drain()
    seen = spark.read.parquet(metrics)
    assert seen.agg(F.sum("input_rows")).first()[0] == 3 and ops.row_balance(seen).count() == 0
    land(spark, landed, "2025-02-01", [line("2", "2025-01-01"), line("3", "2025-02-01")])  # long after the watermark
    land(spark, landed, "2025-02-03", [line("4", "2025-02-03")])
    before = {r["transaction_id"]: tuple(r) for r in spark.read.parquet(silver).collect()}
    drain()
    after = {r["transaction_id"]: tuple(r) for r in spark.read.parquet(silver).collect()}
    assert set(after) == {"1", "2", "3", "4"} and {k: after[k] for k in before} == before


def test_null_keys_are_dealt_over_all_reducers(spark):
    fact = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 500).alias("k"))
    dim = spark.range(500).select(F.col("id").alias("k"), F.concat(F.lit("d"), F.col("id")).alias("v"))
    joined = joins.salted_join(fact, dim, "k")
    assert rows(joined, "id", "v") == rows(fact.join(dim, "k", "left"), "id", "v")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(old, ("false", "-1")):
        spark.conf.set(k, v)
    try:
        sizes = [r[1] for r in joins.salted_join(fact, dim, "k").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(sizes) == 8 and max(sizes) < 1.5 * 20_000 / 8


def test_hot_keys_are_dealt_and_nothing_is_broadcast(spark):
    fact = spark.range(10_000).select("id", F.when(F.col("id") < 4000, 7).otherwise(F.col("id")).alias("k"))
    dim = spark.range(10_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = joins.salted_join(fact, dim, "k", how="inner")
    assert joined.count() == 10_000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") <= 2  # the initial plan prints once more below it


def test_severity_values_stay(spark):
    assert [s.value for s in dq.Severity] == ["fail", "quarantine", "warn"]
    assert replace(dq.payment_suite("2025-01-01")[0], name="x").severity is dq.Severity.FAIL
