"""Plan-shape tests: broadcast FX join, partial aggregation, pruning, no Python UDFs."""

import pytest

from conftest import SF_SMALL
from ledgerlake.catalog import QUERIES
from ledgerlake import fixtures as fx
from ledgerlake.operators import dq, gold, joins
from ledgerlake.operators import merge as mg
from ledgerlake.sources import tables

# Queries that write their inputs first (landing, streams) are exercised in test_pipeline.
SIDE_EFFECT = {"bronze_scan", "bronze_to_silver", "stream_upsert", "stream_quarantine_spike", "quarantine_sink", "run_day_gold", "table_layout"}


def _final_plan(df) -> str:
    df.collect()
    return _plan(df)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_uses_broadcast_hash_join(spark):
    fact = gold.build_fact(fx.payments_orders(spark, SF_SMALL), fx.fx_rates_orders(spark, SF_SMALL))
    # No hint and no job while planning: adaptive execution decides once sizes are measured.
    assert "BroadcastHashJoin" in _final_plan(fact)


def test_mart_aggregates_partially(spark):
    mart = QUERIES["agg_game_daily"](spark, SF_SMALL)
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in mart._jdf.queryExecution().sparkPlan().toString() or "partial" in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SIDE_EFFECT))
def test_no_python_udf(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan


def test_day_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.overwrite_partitions(fx.payments_orders(spark, SF_SMALL), path)
    df = gold.filter_day(spark.read.parquet(path), "1996-03-15")
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(payment_date" in plan and "1996-03-15" in plan


def test_scan_prunes_columns(spark):
    df = fx.payments_orders(spark, SF_SMALL).select("transaction_id")
    plan = _plan(df)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SIDE_EFFECT))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_bad_id_report_is_a_map_side_group_limit(spark):
    rows = fx.payments_events_dirty(spark, SF_SMALL)
    plan = _plan(dq.bad_ids(rows, dq.payment_suite("2024-01-25"), per_rule_limit=10))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "Window" not in _plan(QUERIES["dq_bad_ids"](spark, SF_SMALL))


def _scans(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_merge_and_feed_read_each_side_once(spark):
    old, new = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("customer", "customer"))
    keys = ["c_custkey"]
    merged = mg.merge_upsert(old, new, keys, update_cols=["c_name"], compare_cols=["c_name"], source_order=["c_name"])
    assert _scans(merged) == 2 and _scans(mg.change_feed(old, new, keys)) == 2
    assert _scans(mg.dedup_latest(old, keys, ["c_name"])) == 1


def test_salted_join_shuffles_the_dimension(spark):
    fact = spark.range(2000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k")
    dim = spark.range(2000).selectExpr("id AS k", "id * 2 AS v")
    df = joins.salted_join(fact, dim, "k")
    assert "SortMergeJoin [k" in _final_plan(df) and df.where("v IS NULL").count() == 0


def test_dedup_combines_map_side(spark):
    plan = _plan(QUERIES["dedup_latest"](spark, SF_SMALL))
    assert "partial_max" in plan and "Window" not in plan
