"""Properties of the upsert, dedup, change feed and erasure operators."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from ledgerlake import fixtures as fx
from ledgerlake.operators import merge as mg
from ledgerlake.schemas import SILVER_PAYMENT

T0 = dt.datetime(2025, 1, 1)
T1 = dt.datetime(2025, 1, 2)


def _silver(spark, data):
    return spark.createDataFrame(data, SILVER_PAYMENT)


def _row(tid, status="success", price="1.0000", day=dt.date(2025, 1, 1), ts=T0, game="g", cur="EUR"):
    return (tid, game, day, Decimal(price), cur, status, ts)


def test_merge_four_row_case(spark):
    target = _silver(spark, [_row("a"), _row("b", status=None), _row("c")])
    source = _silver(
        spark,
        [
            _row("a", status="refunded", day=dt.date(2025, 1, 9), ts=T1),  # update, date kept
            _row("b", status="success", ts=T1),  # NULL <> x is not a change
            _row("d", ts=T1),  # insert
        ],
    )
    out = {r["transaction_id"]: r for r in mg.merge_upsert(target, source).collect()}
    assert out["a"]["status"] == "refunded" and out["a"]["payment_date"] == dt.date(2025, 1, 1)
    assert out["a"]["ingest_ts"] == T1
    assert out["b"]["status"] is None and out["b"]["ingest_ts"] == T0
    assert out["c"]["ingest_ts"] == T0
    assert set(out) == {"a", "b", "c", "d"}


def test_merge_idempotent_and_order_independent(spark):
    silver = fx.payments_orders(spark, SF_SMALL)
    late = fx.late_batch(silver)
    once = mg.merge_upsert(silver, late)
    twice = mg.merge_upsert(once, late)
    shuffled = mg.merge_upsert(silver, late.repartition(7, "price").orderBy(F.rand(seed=3)))
    assert rows(once) == rows(twice) == rows(shuffled)


def test_merge_null_keys_bypass_join(spark):
    target = _silver(spark, [_row(None), _row("a")])
    source = _silver(spark, [_row(None, status="error"), _row("a", status="error", ts=T1)])
    out = mg.merge_upsert(target, source)
    assert out.where(F.col("transaction_id").isNull()).count() == 2
    assert out.where(F.col("transaction_id") == "a").first()["status"] == "error"


def test_newer_only_guard(spark):
    target = _silver(spark, [_row("a", status="error", ts=T1)])
    older = _silver(spark, [_row("a", status="success", ts=T0)])
    assert mg.merge_upsert(target, older, newer_only="ingest_ts").first()["status"] == "error"
    assert mg.merge_upsert(target, older).first()["status"] == "success"


def test_dedup_latest_keeps_latest_and_counts(spark):
    silver = fx.payments_orders(spark, SF_SMALL)
    dup = fx.duplicate_batch(silver)
    out = mg.dedup_latest(silver.unionByName(dup))
    assert out.count() == silver.select("transaction_id").distinct().count()
    latest = out.join(dup.select("transaction_id", F.col("status").alias("s2")), "transaction_id")
    assert latest.where(F.col("status") != F.col("s2")).count() == 0


def test_dedup_hot_key_is_an_aggregate(spark):
    hot = spark.range(50_000).select(F.lit("k").alias("transaction_id"), F.col("id").alias("ingest_ts"))
    out = mg.dedup_latest(hot)
    assert out.first()["ingest_ts"] == 49_999
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan


def test_change_feed_replays(spark):
    old = fx.payments_orders(spark, SF_SMALL)
    new = mg.erase(mg.merge_upsert(old, fx.late_batch(old)), fx.erasure_ids(spark, SF_SMALL))
    feed = mg.change_feed(old, new)
    kinds = {r[0] for r in feed.select("_change_type").distinct().collect()}
    assert kinds == {"insert", "delete", "update_preimage", "update_postimage"}
    assert rows(mg.apply_change_feed(old, feed)) == rows(new.select(*old.columns))


def test_erase_removes_only_requested(spark):
    silver = fx.payments_orders(spark, SF_SMALL)
    ids = fx.erasure_ids(spark, SF_SMALL)
    out = mg.erase(silver, ids)
    assert out.join(ids, "transaction_id").count() == 0
    assert out.count() == silver.count() - silver.join(ids, "transaction_id", "left_semi").count()
