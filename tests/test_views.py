"""The SQL analyst views equal the DataFrame operators."""

from conftest import SF_SMALL, rows
from ledgerlake import fixtures as fx
from ledgerlake.catalog import mart_f1
from ledgerlake.operators import marts
from ledgerlake.plans.views import register_views


def test_sql_views_equal_dataframe_forms(spark):
    mart = mart_f1(spark, SF_SMALL)
    metrics = fx.pipeline_metrics(spark, SF_SMALL)
    names = register_views(spark, mart, metrics, as_of="2001-08-03")
    assert set(names) == {"v_game_daily_kpis", "kpi_anomalies", "v_data_freshness", "v_completeness", "v_reconciliation"}
    pairs = {
        "v_game_daily_kpis": marts.kpi_rolling(mart),
        "kpi_anomalies": marts.kpi_anomalies(mart),
        "v_data_freshness": marts.data_freshness(mart, "2001-08-03"),
        "v_completeness": marts.completeness(metrics),
        "v_reconciliation": marts.reconciliation_gold(mart),
    }
    for name, df in pairs.items():
        sql_df = spark.sql(f"SELECT * FROM {name}")
        assert sql_df.columns == df.columns, name
        assert rows(sql_df) == rows(df), name
