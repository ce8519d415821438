"""Analyst views as Spark SQL over registered temp views.

The mart and the metrics table are registered under fixed names and the analyst views are
plain ``CREATE OR REPLACE TEMP VIEW`` statements, so analysts query them with ``spark.sql``.
Spark parses and plans them with the same Catalyst pipeline as the DataFrame forms in
``ledgerlake.operators.marts``. The as-of day is an explicit literal, never ``current_date()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MART_VIEW = "agg_game_daily_revenue"
METRICS_VIEW = "pipeline_metrics"

# View names, emitted columns and frames are those of the published analyst views.
VIEW_SQL = {
    "v_game_daily_kpis": f"""
SELECT game_key, payment_date, gross_revenue_eur, success_rate, txn_success_count, avg_txn_value_eur,
       CAST(SUM(gross_revenue_eur) OVER (PARTITION BY game_key ORDER BY payment_date
            ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DECIMAL(18,4)) AS revenue_7d,
       CAST(SUM(gross_revenue_eur) OVER (PARTITION BY game_key ORDER BY payment_date
            ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS DECIMAL(18,4)) AS revenue_28d,
       CAST(gross_revenue_eur AS DOUBLE)
         / NULLIF(CAST(LAG(gross_revenue_eur, 7) OVER (PARTITION BY game_key ORDER BY payment_date) AS DOUBLE), 0)
         - 1.0 AS wow_growth
FROM {MART_VIEW}""",
    "kpi_anomalies": f"""
SELECT game_key, payment_date, gross_revenue_eur, ROUND(z_score, 6) AS z_score,
       CASE WHEN ABS(z_score) > 3 THEN 'ALERT' WHEN ABS(z_score) > 2 THEN 'WARN' ELSE 'OK' END AS severity
FROM (
  SELECT game_key, payment_date, gross_revenue_eur,
         (CAST(gross_revenue_eur AS DOUBLE) - AVG(CAST(gross_revenue_eur AS DOUBLE)) OVER w)
               / NULLIF(STDDEV_SAMP(CAST(gross_revenue_eur AS DOUBLE)) OVER w, 0) AS z_score
  FROM {MART_VIEW}
  WINDOW w AS (PARTITION BY game_key ORDER BY payment_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)
) s""",
    "v_data_freshness": f"""
SELECT MAX(payment_date) AS latest_partition,
       DATEDIFF(DATE '{{as_of}}', MAX(payment_date)) AS days_behind,
       CASE WHEN MAX(payment_date) >= DATE_SUB(DATE '{{as_of}}', 1) THEN 'OK' ELSE 'STALE' END AS freshness_status
FROM {MART_VIEW}""",
    "v_completeness": f"""
SELECT payment_date, run_id, input_rows, output_rows, rejected_rows, quarantined_rows, completeness_ratio,
       CASE WHEN completeness_ratio >= 0.999 THEN 'OK' ELSE 'BREACH' END AS completeness_status
FROM (SELECT payment_date, run_id,
             CAST(SUM(input_rows) AS BIGINT) AS input_rows, CAST(SUM(output_rows) AS BIGINT) AS output_rows,
             CAST(SUM(rejected_rows) AS BIGINT) AS rejected_rows,
             CAST(SUM(quarantined_rows) AS BIGINT) AS quarantined_rows,
             CAST(SUM(output_rows) AS DOUBLE) / NULLIF(CAST(SUM(input_rows) AS DOUBLE), 0) AS completeness_ratio
      FROM {METRICS_VIEW} GROUP BY payment_date, run_id) a""",
    "v_reconciliation": f"""
SELECT payment_date, gross_revenue_eur AS gold_revenue_eur, txn_success_count AS gold_success_count
FROM {MART_VIEW}""",
}


def register_views(spark: SparkSession, mart: DataFrame, metrics: DataFrame | None = None, as_of=None) -> list[str]:
    """Register the mart (and metrics) and create the analyst views; returns the view names."""
    mart.createOrReplaceTempView(MART_VIEW)
    if metrics is not None:
        metrics.createOrReplaceTempView(METRICS_VIEW)
    created = []
    for name, body in VIEW_SQL.items():
        if name == "v_completeness" and metrics is None:
            continue
        if name == "v_data_freshness":
            if as_of is None:
                continue
            body = body.replace("{as_of}", str(as_of))
        spark.sql(f"CREATE OR REPLACE TEMP VIEW {name} AS {body}")
        created.append(name)
    return created
