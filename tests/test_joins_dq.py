"""Joins (salting, orphans, size-checked broadcast) and the data-quality suite."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from ledgerlake import fixtures as fx
from ledgerlake.operators import dq, joins
from ledgerlake.schemas import SILVER_PAYMENT


def test_salted_equals_plain_left_join(spark):
    fact = fx.payments_orders(spark, SF_SMALL).select("transaction_id", F.col("game").alias("game_key"))
    fact = fact.unionByName(spark.createDataFrame([("n1", None)], "transaction_id string, game_key string"))
    dim = fx.dim_game(spark, SF_SMALL).select("game_key", "genre")
    salted = joins.salted_join(fact, dim, "game_key", n_salt=7)
    plain = fact.join(dim, "game_key", "left")
    assert rows(salted, "transaction_id", "genre") == rows(plain, "transaction_id", "genre")


def test_orphans_count_null_keys(spark):
    fact = spark.createDataFrame([("a", "G1"), ("b", None), ("c", "G9")], "transaction_id string, game_key string")
    dim = spark.createDataFrame([("G1", True), ("G9", False)], "game_key string, is_current boolean")
    assert sorted(r[0] for r in joins.orphans(fact, dim, "game_key", "game_key").collect()) == ["b", "c"]


def test_hot_keys_are_bounded_by_their_share(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id < 400 THEN 1 WHEN id < 500 THEN 2 ELSE id END AS k")
    assert sorted(r["k"] for r in joins.hot_keys(df, "k", 0.05).collect()) == [1, 2]


def _null_batch(spark):
    data = [
        ("t1", "g", None, None, "EUR", "success", None),
        ("t2", "g", None, None, None, None, None),
        (None, "g", None, None, "EUR", "success", None),
    ]
    return spark.createDataFrame(data, SILVER_PAYMENT)


def test_three_valued_counts_by_default(spark):
    res = {r["expectation"]: r["violations"] for r in dq.evaluate(_null_batch(spark), dq.payment_suite("2025-01-01")).collect()}
    assert res["transaction_id_not_null"] == 1
    assert res["price_positive"] == 0 and res["status_in_enum"] == 0
    strict = dq.evaluate(_null_batch(spark), dq.payment_suite("2025-01-01"), null_is_bad=True)
    strict = {r["expectation"]: r["violations"] for r in strict.collect()}
    assert strict["price_positive"] == 3 and strict["status_in_enum"] == 1


def test_route_really_routes(spark):
    df = fx.payments_events_dirty(spark, SF_SMALL)
    passed, quarantined, warned = dq.route(df, dq.payment_suite("2024-01-25"))
    assert passed.count() + quarantined.count() == df.count()
    assert quarantined.where(F.size("dq_failed") == 0).count() == 0


def test_bad_ids_include_null_and_cap(spark):
    df = fx.payments_events_dirty(spark, SF_SMALL)
    ids = dq.bad_ids(df, dq.payment_suite("2024-01-25"), per_rule_limit=5)
    got = [r[0] for r in ids.collect()]
    assert None in got and len(got) <= 5 * 5


def test_assert_silver_raises_on_fail_rules(spark):
    with pytest.raises(dq.DQError):
        dq.assert_silver(_null_batch(spark), "2025-01-01")


def test_referential_summary_matches_orphans(spark):
    silver = fx.payments_orders(spark, SF_SMALL)
    from ledgerlake.operators import gold

    fact = gold.build_fact(silver, fx.fx_rates_orders(spark, SF_SMALL))
    s = dq.referential_summary(fact, fx.dim_game(spark, SF_SMALL), fx.dim_currency(spark, SF_SMALL)).first()
    assert s["fact_game_orphans"] == fact.where(F.col("game_key") == fx.OMITTED_GAME).count()
    assert s["fact_currency_orphans"] == fact.where(F.col("currency_key") == "JPY").count()
    with pytest.raises(dq.DQError):
        dq.assert_referential(
            dq.referential_summary(fact, fx.dim_game(spark, SF_SMALL), fx.dim_currency(spark, SF_SMALL))
        )


def test_salted_join_spreads_a_hot_key(spark):
    """One game holds a third of the fact rows; salting spreads it evenly over the salts."""
    n = 30_000
    fact = spark.range(n).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("g"), (F.col("id") % 97).cast("string"))).alias("game_key"),
    ).repartition(8)
    dim = spark.createDataFrame([("HOT", "x")] + [(f"g{i}", "y") for i in range(97)], "game_key string, genre string")
    salt = "_ll_salt"
    fact_s = fact.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(16)))
    per_salt = [r["count"] for r in fact_s.where(F.col("game_key") == "HOT").groupBy(salt).count().collect()]
    assert len(per_salt) == 16 and max(per_salt) <= 2 * min(per_salt)
    out = joins.salted_join(fact, dim, "game_key", n_salt=16)
    assert out.count() == n and out.where(F.col("genre").isNull()).count() == 0
