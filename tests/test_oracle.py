"""Every registered query against its DuckDB twin on the smallest scale factor."""

import pytest

from conftest import SF_SMALL
from __spark_entry__ import entry, oracle_sql, queries
from ledgerlake.testing import compare


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, name):
    sql = oracle_sql().get(name)
    if sql is None:
        assert queries()[name](spark, SF_SMALL).count() >= 0
        return
    r = compare(spark, name, queries()[name], sql, SF_SMALL)
    assert r["columns_match"], (r["spark_columns"], r["oracle_columns"])
    assert not r["type_mismatches"], r["type_mismatches"]
    assert r["spark_rows"] == r["oracle_rows"]
    assert r["values_match"], (r["only_spark"], r["only_oracle"])


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["game_key", "payment_date"]


@pytest.mark.parametrize("name", ["stream_quarantine_spike", "quarantine_spike", "completeness", "fact_payment", "scd2_asof"])
def test_results_do_not_depend_on_session_time_zone(spark, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        r = compare(spark, name, queries()[name], oracle_sql()[name], SF_SMALL)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["values_match"], (r["only_spark"], r["only_oracle"])
