"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each fixture of ``ledgerlake.fixtures`` appears here as a CTE with the same closed formulas, and
each query as plain SQL over those CTEs. Column names and types are aligned with the Spark
output: money DECIMAL(18,4), counts BIGINT, ratios DOUBLE computed from exact decimal sums.
"""

from __future__ import annotations

CTE: dict[str, str] = {}

CTE["f1"] = """
f1 AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS transaction_id,
         c.c_mktsegment AS game,
         CAST(o.o_orderdate AS DATE) AS payment_date,
         CAST(o.o_totalprice AS DECIMAL(18,4)) AS price,
         CASE c.c_nationkey % 5 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP'
              WHEN 3 THEN 'CHF' ELSE 'JPY' END AS currency,
         CASE WHEN o.o_orderkey % 17 = 0 THEN 'refunded'
              WHEN o.o_orderstatus = 'F' THEN 'success'
              WHEN o.o_orderstatus = 'P' THEN 'error' ELSE 'pending' END AS status,
         o.o_orderdate + INTERVAL 6 HOUR AS ingest_ts
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""

CTE["fx1"] = """
fx1 AS (
  SELECT p.code AS currency_code, d.rate_date,
         CAST(CAST(CASE WHEN p.code = 'EUR' THEN p.milli ELSE p.milli + dayofmonth(d.rate_date) % 13 END
                   AS DECIMAL(10,0)) / 1000 AS DECIMAL(10,6)) AS rate_to_eur
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS rate_date FROM orders
        WHERE o_orderdate IS NOT NULL) d,
       (VALUES ('EUR', 1000), ('USD', 910), ('GBP', 1170), ('CHF', 1040)) p(code, milli)
)"""

FACT_SELECT = """
  SELECT s.transaction_id, s.game AS game_key,
         CAST(year(s.payment_date) * 10000 + month(s.payment_date) * 100 + day(s.payment_date) AS INTEGER) AS date_key,
         s.currency AS currency_key, s.price,
         CAST(s.price * COALESCE(x.rate_to_eur, CAST(1 AS DECIMAL(10,6))) AS DECIMAL(18,4)) AS price_eur,
         s.status, s.payment_date, s.ingest_ts
  FROM {silver} s LEFT JOIN {fx} x ON s.currency = x.currency_code AND s.payment_date = x.rate_date"""

MART_SELECT = """
  SELECT game_key, payment_date, gross_revenue_eur, txn_success_count, txn_error_count, currency_count,
         CAST(gross_revenue_eur AS DOUBLE) / NULLIF(txn_success_count, 0) AS avg_txn_value_eur,
         txn_success_count / GREATEST(txn_success_count + txn_error_count, 1) AS success_rate
  FROM (
    SELECT game_key, payment_date,
           CAST(SUM(CASE WHEN status = 'success' THEN price_eur END) AS DECIMAL(18,4)) AS gross_revenue_eur,
           COUNT(*) FILTER (WHERE status = 'success') AS txn_success_count,
           COUNT(*) FILTER (WHERE status = 'error') AS txn_error_count,
           COUNT(DISTINCT currency_key) AS currency_count
    FROM {fact} GROUP BY game_key, payment_date
  ) a"""

CTE["fact1"] = "\nfact1 AS (" + FACT_SELECT.format(silver="f1", fx="fx1") + "\n)"
CTE["mart1"] = "\nmart1 AS (" + MART_SELECT.format(fact="fact1") + "\n)"

DEPENDS = {
    "fact1": ["f1", "fx1"],
    "mart1": ["fact1"],
}


def _expand(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in DEPENDS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_(names: list[str], body: str) -> str:
    """``WITH`` clause holding ``names`` and their dependencies, then ``body``."""
    ctes = [CTE[n] for n in _expand(names)]
    return "WITH" + ",".join(ctes) + "\n" + body


SQL: dict[str, str] = {}

SQL["agg_game_daily"] = with_(["mart1"], "SELECT * FROM mart1")
SQL["fact_payment"] = with_(["fact1"], "SELECT * FROM fact1")
SQL["masked_fact"] = with_(["fact1"], "SELECT transaction_id, game_key, date_key, status FROM fact1")

SQL["kpi_rolling"] = with_(
    ["mart1"],
    """
SELECT game_key, payment_date, gross_revenue_eur, success_rate, txn_success_count, avg_txn_value_eur,
       CAST(SUM(gross_revenue_eur) OVER (PARTITION BY game_key ORDER BY payment_date
            ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DECIMAL(18,4)) AS revenue_7d,
       CAST(SUM(gross_revenue_eur) OVER (PARTITION BY game_key ORDER BY payment_date
            ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS DECIMAL(18,4)) AS revenue_28d,
       CAST(gross_revenue_eur AS DOUBLE)
         / NULLIF(CAST(LAG(gross_revenue_eur, 7) OVER (PARTITION BY game_key ORDER BY payment_date) AS DOUBLE), 0)
         - 1.0 AS wow_growth
FROM mart1""",
)

SQL["kpi_rolling_calendar"] = with_(
    ["mart1"],
    """
SELECT game_key, payment_date, gross_revenue_eur,
       CAST(SUM(gross_revenue_eur) OVER w7 AS DECIMAL(18,4)) AS revenue_7d,
       CAST(SUM(gross_revenue_eur) OVER w28 AS DECIMAL(18,4)) AS revenue_28d,
       CAST(gross_revenue_eur AS DOUBLE) / NULLIF(CAST(SUM(gross_revenue_eur) OVER wb AS DOUBLE), 0) - 1.0 AS wow_growth
FROM (SELECT *, CAST(payment_date - DATE '1970-01-01' AS BIGINT) AS dn FROM mart1) m
WINDOW w7 AS (PARTITION BY game_key ORDER BY dn RANGE BETWEEN 6 PRECEDING AND CURRENT ROW),
       w28 AS (PARTITION BY game_key ORDER BY dn RANGE BETWEEN 27 PRECEDING AND CURRENT ROW),
       wb AS (PARTITION BY game_key ORDER BY dn RANGE BETWEEN 7 PRECEDING AND 7 PRECEDING)""",
)

SQL["kpi_anomalies"] = with_(
    ["mart1"],
    """
SELECT game_key, payment_date, gross_revenue_eur, ROUND(z_score, 6) AS z_score,
       CASE WHEN ABS(z_score) > 3 THEN 'ALERT' WHEN ABS(z_score) > 2 THEN 'WARN' ELSE 'OK' END AS severity
FROM (
  SELECT game_key, payment_date, gross_revenue_eur,
         (CAST(gross_revenue_eur AS DOUBLE) - AVG(CAST(gross_revenue_eur AS DOUBLE)) OVER w)
               / NULLIF(STDDEV_SAMP(CAST(gross_revenue_eur AS DOUBLE)) OVER w, 0) AS z_score
  FROM mart1
  WINDOW w AS (PARTITION BY game_key ORDER BY payment_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)
) s""",
)

FRESHNESS_AS_OF = "2001-08-03"
SQL["data_freshness"] = with_(
    ["mart1"],
    f"""
SELECT MAX(payment_date) AS latest_partition,
       CAST(DATE '{FRESHNESS_AS_OF}' - MAX(payment_date) AS INTEGER) AS days_behind,
       CASE WHEN MAX(payment_date) >= DATE '{FRESHNESS_AS_OF}' - INTERVAL 1 DAY THEN 'OK' ELSE 'STALE' END
         AS freshness_status
FROM mart1""",
)

SQL["reconciliation_gold"] = with_(
    ["mart1"],
    "SELECT payment_date, gross_revenue_eur AS gold_revenue_eur, txn_success_count AS gold_success_count FROM mart1",
)

SQL["dim_date"] = with_(
    ["f1"],
    """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
       CAST(isodow(d) AS INTEGER) AS iso_weekday, isodow(d) >= 6 AS is_weekend
FROM (SELECT CAST(unnest(generate_series(MIN(payment_date), MAX(payment_date), INTERVAL 1 DAY)) AS DATE) AS d
      FROM f1) s""",
)

PARTITION_VOLUME_THRESHOLD = 10
SQL["partition_volume"] = with_(
    ["f1"],
    f"""
SELECT payment_date, COUNT(*) AS row_count,
       CASE WHEN COUNT(*) >= {PARTITION_VOLUME_THRESHOLD} THEN 'spark' ELSE 'lean' END AS tier
FROM f1 GROUP BY payment_date""",
)

# --- dedup / merge / change feed / erasure over F1 ---------------------------------------------
CTE["dup1"] = """
dup1 AS (
  SELECT transaction_id, game, payment_date, price, currency,
         CASE WHEN status = 'success' THEN 'error' ELSE 'success' END AS status,
         ingest_ts + INTERVAL 1 DAY AS ingest_ts
  FROM f1 WHERE CAST(transaction_id AS BIGINT) % 10 = 0
)"""

LATE_TS = "TIMESTAMP '2001-09-01 00:00:00'"
CTE["late1"] = f"""
late1 AS (
  SELECT transaction_id, game, payment_date, price, currency,
         CASE WHEN status = 'success' THEN 'refunded' ELSE 'success' END AS status, {LATE_TS} AS ingest_ts
  FROM f1 WHERE CAST(transaction_id AS BIGINT) % 7 = 0
  UNION ALL
  SELECT transaction_id, game, payment_date, price, currency, status, {LATE_TS} AS ingest_ts
  FROM f1 WHERE CAST(transaction_id AS BIGINT) % 7 = 1
  UNION ALL
  SELECT 'late-' || transaction_id, game, payment_date + 1, price, currency, status, {LATE_TS} AS ingest_ts
  FROM f1 WHERE CAST(transaction_id AS BIGINT) % 7 = 2
)"""

# A plain, explicit formulation of MERGE for DuckDB (t = target, s = deduplicated source).
MERGE_SQL = """
  SELECT COALESCE(t.transaction_id, s.transaction_id) AS transaction_id,
         CASE WHEN t.transaction_id IS NOT NULL THEN t.game ELSE s.game END AS game,
         CASE WHEN t.transaction_id IS NOT NULL THEN t.payment_date ELSE s.payment_date END AS payment_date,
         CASE WHEN u.upd THEN s.price WHEN t.transaction_id IS NOT NULL THEN t.price ELSE s.price END AS price,
         CASE WHEN t.transaction_id IS NOT NULL THEN t.currency ELSE s.currency END AS currency,
         CASE WHEN u.upd THEN s.status WHEN t.transaction_id IS NOT NULL THEN t.status ELSE s.status END AS status,
         CASE WHEN u.upd THEN s.ingest_ts WHEN t.transaction_id IS NOT NULL THEN t.ingest_ts ELSE s.ingest_ts END
           AS ingest_ts
  FROM {target} t FULL OUTER JOIN {source} s ON t.transaction_id = s.transaction_id,
       LATERAL (SELECT t.transaction_id IS NOT NULL AND s.transaction_id IS NOT NULL
                       AND COALESCE(t.status <> s.status OR t.price <> s.price, FALSE) AS upd) u"""

DEDUP_SQL = """
  SELECT transaction_id, game, payment_date, price, currency, status, ingest_ts FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id
              ORDER BY ingest_ts DESC, game DESC, payment_date DESC, price DESC, currency DESC, status DESC) AS rn
    FROM {src} WHERE transaction_id IS NOT NULL) d WHERE rn = 1
  UNION ALL SELECT * FROM {src} WHERE transaction_id IS NULL"""

CTE["dupsrc1"] = "\ndupsrc1 AS (SELECT * FROM f1 UNION ALL SELECT * FROM dup1)"
CTE["late1d"] = "\nlate1d AS (" + DEDUP_SQL.format(src="late1") + "\n)"
CTE["merged1"] = "\nmerged1 AS (" + MERGE_SQL.format(target="f1", source="late1d") + "\n)"
CTE["merged1b"] = "\nmerged1b AS (" + MERGE_SQL.format(target="merged1", source="late1d") + "\n)"
CTE["erase1"] = """
erase1 AS (
  SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS transaction_id FROM orders WHERE o_custkey % 97 = 0
)"""
CTE["new1"] = """
new1 AS (
  SELECT m.* FROM merged1 m WHERE NOT EXISTS (SELECT 1 FROM erase1 e WHERE e.transaction_id = m.transaction_id)
)"""
DEPENDS.update({
    "dup1": ["f1"],
    "late1": ["f1"],
    "dupsrc1": ["f1", "dup1"],
    "late1d": ["late1"],
    "merged1": ["f1", "late1d"],
    "merged1b": ["merged1"],
    "new1": ["merged1", "erase1"],
})

SQL["dedup_latest"] = with_(["dupsrc1"], DEDUP_SQL.format(src="dupsrc1"))
SQL["merge_upsert"] = with_(["merged1"], "SELECT * FROM merged1")
SQL["merge_idempotent"] = with_(["merged1b"], "SELECT * FROM merged1b")
SQL["erase_ids"] = with_(
    ["f1", "erase1"],
    "SELECT f.* FROM f1 f WHERE NOT EXISTS (SELECT 1 FROM erase1 e WHERE e.transaction_id = f.transaction_id)",
)

_CF_COLS = "transaction_id, game, payment_date, price, currency, status, ingest_ts"


def _row_sql(side: str, kind: str) -> str:
    """A struct of one side's columns and the change type."""
    fields = ", ".join(f"{c}: {side}.{c}" for c in _CF_COLS.split(", "))
    return f"{{{{{fields}, _change_type: '{kind}'}}}}"


_CF_DIFF = " OR ".join(
    f"t.{c} IS DISTINCT FROM s.{c}" for c in ("game", "payment_date", "price", "currency", "status", "ingest_ts")
)
# Every CTE is computed once, the two versions meet in one join, and a joined row gives its 0 to 2 changes.
CHANGES_SQL = f"""
SELECT c.* FROM (
  SELECT unnest(CASE
    WHEN t.transaction_id IS NULL THEN [{_row_sql('s', 'insert')}]
    WHEN s.transaction_id IS NULL THEN [{_row_sql('t', 'delete')}]
    WHEN {_CF_DIFF} THEN [{_row_sql('t', 'update_preimage')}, {_row_sql('s', 'update_postimage')}]
    ELSE [] END) AS c
  FROM {{old}} t FULL JOIN {{new}} s ON t.transaction_id = s.transaction_id)"""
SQL["change_feed"] = with_(["f1", "new1"], CHANGES_SQL.format(old="f1", new="new1")).replace(" AS (", " AS MATERIALIZED (")

SQL["merge_indexed"] = with_(["new1"], "SELECT * FROM new1")
CTE["factn1"] = "\nfactn1 AS (" + FACT_SELECT.format(silver="new1", fx="fx1") + "\n)"
CTE["martn1"] = "\nmartn1 AS (" + MART_SELECT.format(fact="factn1") + "\n)"
DEPENDS.update({"factn1": ["new1", "fx1"], "martn1": ["factn1"]})
SQL["mart_from_changes"] = with_(["martn1"], "SELECT * FROM martn1")
SQL["kpi_refresh"] = with_(
    ["martn1"],
    """
SELECT * EXCLUDE (z), ROUND(z, 6) AS z_score,
       CASE WHEN ABS(z) > 3 THEN 'ALERT' WHEN ABS(z) > 2 THEN 'WARN' ELSE 'OK' END AS severity
FROM (
  SELECT *,
         CAST(SUM(gross_revenue_eur) OVER (o ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DECIMAL(18,4)) AS revenue_7d,
         CAST(SUM(gross_revenue_eur) OVER (o ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS DECIMAL(18,4)) AS revenue_28d,
         CAST(gross_revenue_eur AS DOUBLE) / NULLIF(CAST(LAG(gross_revenue_eur, 7) OVER o AS DOUBLE), 0) - 1.0 AS wow_growth,
         (CAST(gross_revenue_eur AS DOUBLE) - AVG(CAST(gross_revenue_eur AS DOUBLE)) OVER (o ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
           / NULLIF(STDDEV_SAMP(CAST(gross_revenue_eur AS DOUBLE)) OVER (o ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 0) AS z
  FROM martn1 WINDOW o AS (PARTITION BY game_key ORDER BY payment_date)) v""",
)
_DIFFERS = ", ".join(
    f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in ("payment_date", "game", "price", "currency", "status", "ingest_ts")
)
SQL["reconcile_rows"] = with_(
    ["f1", "new1"],
    f"""
SELECT * FROM (
  SELECT COALESCE(a.transaction_id, b.transaction_id) AS transaction_id,
         CASE WHEN b.transaction_id IS NULL THEN 'missing' WHEN a.transaction_id IS NULL THEN 'extra' ELSE 'altered' END AS kind,
         CAST(a.transaction_id IS NOT NULL AS BIGINT) AS n_left, CAST(b.transaction_id IS NOT NULL AS BIGINT) AS n_right,
         CASE WHEN a.transaction_id IS NULL OR b.transaction_id IS NULL THEN '' ELSE concat_ws(',', {_DIFFERS}) END AS differs
  FROM f1 a FULL JOIN new1 b ON a.transaction_id = b.transaction_id) r
WHERE kind <> 'altered' OR differs <> ''""",
)

RESTATE_DT = "1998-06-15"
RESTATE_DAYS = 7
CTE["restate_fact1"] = (
    "\nrestate_fact1 AS ("
    + FACT_SELECT.format(
        silver=f"(SELECT * FROM merged1 WHERE payment_date >= DATE '{RESTATE_DT}' - {RESTATE_DAYS} "
        f"AND payment_date < DATE '{RESTATE_DT}')",
        fx="fx1",
    )
    + "\n)"
)
DEPENDS["restate_fact1"] = ["merged1", "fx1"]
SQL["restate_window"] = with_(["restate_fact1"], MART_SELECT.format(fact="restate_fact1"))

# --- F2: payments from events, dirty variant and raw text -----------------------------------------
_CUR4 = "CASE e.user_id % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' ELSE 'CHF' END"
_STATUS2 = (
    "CASE e.event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'error' "
    "WHEN 'signup' THEN 'pending' WHEN 'click' THEN 'refunded' ELSE e.event_type END"
)
CTE["f2"] = f"""
f2 AS (
  SELECT CAST(e.event_id AS VARCHAR) AS transaction_id, 'g' || CAST(e.user_id % 5 AS VARCHAR) AS game,
         CAST(e.ts AS DATE) AS payment_date, CAST(e.value AS DECIMAL(18,4)) AS price,
         {_CUR4} AS currency, {_STATUS2} AS status, e.ts AS ingest_ts
  FROM events e
)"""
_SLOT = "CASE WHEN e.event_id % 11 = 0 THEN (e.event_id // 11) % 5 END"
CTE["d2k"] = f"""
d2k AS (
  SELECT e.event_id AS _id,
         CASE WHEN {_SLOT} = 4 THEN NULL ELSE CAST(e.event_id AS VARCHAR) END AS transaction_id,
         'g' || CAST(e.user_id % 5 AS VARCHAR) AS game,
         CASE WHEN {_SLOT} = 3 THEN NULL ELSE CAST(e.ts AS DATE) END AS payment_date,
         CASE WHEN {_SLOT} = 0 THEN NULL WHEN e.event_id % 19 = 0 THEN -CAST(e.value AS DECIMAL(18,4))
              ELSE CAST(e.value AS DECIMAL(18,4)) END AS price,
         CASE WHEN {_SLOT} = 2 THEN NULL WHEN e.event_id % 13 = 0 THEN lower({_CUR4}) ELSE {_CUR4} END AS currency,
         CASE WHEN {_SLOT} = 1 THEN NULL ELSE {_STATUS2} END AS status,
         e.ts AS ingest_ts
  FROM events e
)"""
CTE["d2"] = "\nd2 AS (SELECT transaction_id, game, payment_date, price, currency, status, ingest_ts FROM d2k)"
CTE["raw2"] = """
raw2 AS (
  SELECT _id,
         CASE WHEN _id % 41 = 0 THEN repeat('x', 65) ELSE transaction_id END AS transaction_id,
         CASE WHEN _id % 43 = 0 THEN '' ELSE game END AS game,
         CASE WHEN _id % 31 = 0 THEN concat_ws('-', CAST(year(payment_date) AS VARCHAR),
                   CAST(month(payment_date) AS VARCHAR), CAST(day(payment_date) AS VARCHAR))
              WHEN _id % 37 = 0 THEN CAST(payment_date AS VARCHAR) || 'T00:00:00'
              ELSE CAST(payment_date AS VARCHAR) END AS payment_date,
         CASE WHEN _id % 23 = 0 THEN CAST(price AS VARCHAR) || '7'
              WHEN _id % 29 = 0 THEN CAST(price AS VARCHAR) || '0000'
              WHEN _id % 53 = 0 THEN '1e2'
              WHEN _id % 59 = 0 THEN '99999999999999999999'
              WHEN _id % 61 = 0 THEN 'NaN'
              ELSE CAST(price AS VARCHAR) END AS price,
         CASE WHEN _id % 67 = 0 THEN currency || chr(10) ELSE currency END AS currency,
         status, ingest_ts, _id % 47 = 0 AS has_extra
  FROM d2k
)"""
DEPENDS.update({"d2": ["d2k"], "raw2": ["d2k"]})

CONTRACT_AS_OF = "2024-01-25"


def contract_checked(src: str, as_of: str) -> str:
    """SQL twin of ``contract.with_errors``: ``src`` columns plus ``errors`` (comma-joined)."""
    return f"""
  SELECT *, concat_ws(',',
      CASE WHEN transaction_id IS NULL OR length(transaction_id) < 1 THEN 'transaction_id_missing' END,
      CASE WHEN length(transaction_id) > 64 THEN 'transaction_id_too_long' END,
      CASE WHEN game IS NULL OR length(game) < 1 THEN 'game_missing' END,
      CASE WHEN length(game) > 128 THEN 'game_too_long' END,
      CASE WHEN NOT (d_ok AND d IS NOT NULL) THEN 'payment_date_invalid' END,
      CASE WHEN d_ok AND d IS NOT NULL AND d > DATE '{as_of}' THEN 'payment_date_future' END,
      CASE WHEN NOT p_ok THEN 'price_invalid' END,
      CASE WHEN p_ok AND NOT p_zero AND (num IS NULL OR TRY_CAST(num AS DECIMAL(18,4)) IS NULL)
           THEN 'price_out_of_range' END,
      CASE WHEN p_ok AND (p_zero OR COALESCE(num <= 0, FALSE)) THEN 'price_not_positive' END,
      CASE WHEN p_ok AND num IS NOT NULL AND COALESCE(
             (NOT contains(lower(p), 'e') AND regexp_matches(p, '\\.[0-9]{{4}}[0-9]*[1-9]')) OR num <> CAST(round(num, 4) AS DECIMAL(38,18)),
             FALSE) THEN 'price_too_precise' END,
      CASE WHEN NOT COALESCE(regexp_full_match(currency, '[A-Z]{{3}}'), FALSE) THEN 'currency_invalid' END,
      CASE WHEN NOT COALESCE(status IN ('success', 'error', 'pending', 'refunded'), FALSE) THEN 'status_invalid' END,
      CASE WHEN has_extra THEN 'extra_fields' END) AS errors
  FROM (
    SELECT *, trim(price) AS p, TRY_CAST(trim(price) AS DECIMAL(38,18)) AS num,
           COALESCE(regexp_full_match(trim(price), '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?'), FALSE) AS p_ok,
           COALESCE(regexp_full_match(trim(price), '[+-]?(0+\\.?0*|\\.0+)([eE][+-]?[0-9]+)?'), FALSE) AS p_zero,
           COALESCE(regexp_full_match(payment_date, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([T ]00:00(:00(\\.0+)?)?)?'), FALSE) AS d_ok,
           TRY_CAST(substr(payment_date, 1, 10) AS DATE) AS d
    FROM {src}) c0"""


CTE["chk2"] = "\nchk2 AS (" + contract_checked("raw2", CONTRACT_AS_OF) + "\n)"
DEPENDS["chk2"] = ["raw2"]

SQL["contract_errors"] = with_(
    ["chk2"],
    """
SELECT error, COUNT(*) AS n_rows
FROM (SELECT unnest(string_split(errors, ',')) AS error FROM chk2 WHERE errors <> '') s
GROUP BY error""",
)
SQL["quarantine_rows"] = with_(["chk2"], "SELECT transaction_id, errors FROM chk2 WHERE errors <> ''")
SQL["contract_valid"] = with_(
    ["chk2"],
    """
SELECT transaction_id, game, TRY_CAST(substr(payment_date, 1, 10) AS DATE) AS payment_date,
       CAST(TRY_CAST(trim(price) AS DECIMAL(38,18)) AS DECIMAL(18,4)) AS price, currency, status, ingest_ts
FROM chk2 WHERE errors = ''""",
)

DQ_AS_OF = "2024-01-25"
DQ_RULES = (
    ("transaction_id_not_null", "fail", "transaction_id IS NOT NULL"),
    ("price_positive", "quarantine", "price > 0"),
    ("status_in_enum", "quarantine", "status IN ('success', 'error', 'pending', 'refunded')"),
    ("currency_iso", "quarantine", "regexp_matches(currency, '^[A-Z]{3}$')"),
    ("payment_date_not_future", "fail", f"payment_date <= DATE '{DQ_AS_OF}'"),
    ("price_sane_upper", "warn", "price < 100000"),
)
SQL["dq_evaluate"] = with_(
    ["d2"],
    "\nUNION ALL\n".join(
        f"SELECT '{n}' AS expectation, '{s}' AS severity, COUNT(*) FILTER (WHERE NOT ({p})) AS violations FROM d2"
        for n, s, p in DQ_RULES
    ),
)
_FAILED = "concat_ws(',', " + ", ".join(
    f"CASE WHEN NOT COALESCE({p}, FALSE) THEN '{n}' END" for n, s, p in DQ_RULES
) + ")"
_HARD = " OR ".join(f"NOT COALESCE({p}, FALSE)" for n, s, p in DQ_RULES if s != "warn")
SQL["dq_quarantined"] = with_(
    ["d2"], f"SELECT transaction_id, {_FAILED} AS dq_failed FROM d2 WHERE {_HARD}"
)
SQL["dq_bad_ids"] = with_(
    ["d2"],
    "SELECT DISTINCT transaction_id FROM d2 WHERE "
    + " OR ".join(f"COALESCE(NOT ({p}), FALSE)" for n, s, p in DQ_RULES if s != "warn"),
)


def sk_sql(*cols: str) -> str:
    """SQL twin of ``row_digest``: 60-bit prefix of SHA-256 over the canonical row text."""
    parts = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '\\N')" for c in cols)
    return f"CAST(('0x' || substr(sha256(concat_ws('|', {parts})), 1, 15)) AS BIGINT)"


def key_sql(*texts: str) -> str:
    """SQL twin of ``content_key`` for text expressions."""
    parts = ", ".join(f"COALESCE(CAST(length({t}) AS VARCHAR) || ':' || {t}, '-')" for t in texts)
    return f"sha256(concat_ws('|', {parts}))"


# --- retry queue over F2 rejects -------------------------------------------------------------------
RETRY_ENQUEUE_AS_OF = "2024-01-10"
RETRY_NOW = "2024-01-20 00:00:00"
RETRY_REPLAY_AS_OF = "2024-01-20"
ENQUEUE_NOW = "2024-01-10 06:00:00"
_PAY = ("transaction_id", "game", "payment_date", "price", "currency", "status")
CTE["chk2q"] = "\nchk2q AS (" + contract_checked("raw2", RETRY_ENQUEUE_AS_OF) + "\n)"
# The JSON line of a record (NULL fields left out, a line feed escaped), as the fixture writes it.
_FIELDS = ", ".join(f"""'"{c}":"' || replace({c}, chr(10), '\\n') || '"'""" for c in _PAY)
_RAW_LINE = f"""('{{' || concat_ws(',', {_FIELDS}) || CASE WHEN has_extra THEN ',"extra_field":"boom"' ELSE '' END || '}}')"""
_QUEUE_ID = key_sql(*_PAY, _RAW_LINE)
CTE["q2"] = f"""
q2 AS (
  SELECT {_QUEUE_ID} AS queue_id, transaction_id, game, payment_date, price, currency, status, has_extra,
         CAST(_id % 5 + 1 AS INTEGER) AS attempt_count, errors AS last_error, ingest_ts AS eligible_at,
         ingest_ts
  FROM chk2q WHERE errors <> ''
)"""
CTE["due2"] = f"""
due2 AS (SELECT * FROM q2 WHERE eligible_at <= TIMESTAMP '{RETRY_NOW}' AND attempt_count < 5)"""
CTE["bump2"] = f"""
bump2 AS (
  SELECT * REPLACE (attempt_count + 1 AS attempt_count,
         TIMESTAMP '{RETRY_NOW}' + to_hours(CAST(pow(2, attempt_count + 1) AS BIGINT)) AS eligible_at)
  FROM due2
)"""
DEPENDS.update({"chk2q": ["raw2"], "q2": ["chk2q"], "due2": ["q2"], "bump2": ["due2"]})
_QCOLS = "queue_id, transaction_id, attempt_count, last_error, eligible_at"
SQL["retry_enqueue"] = with_(
    ["chk2q"],
    f"""
SELECT {_QUEUE_ID} AS queue_id, transaction_id, CAST(1 AS INTEGER) AS attempt_count, errors AS last_error,
       TIMESTAMP '{ENQUEUE_NOW}' AS eligible_at
FROM chk2q WHERE errors <> ''""",
)
SQL["retry_due"] = with_(["due2"], f"SELECT {_QCOLS} FROM due2")
SQL["retry_reschedule"] = with_(
    ["bump2"],
    f"""
SELECT {_QCOLS} FROM bump2 WHERE attempt_count < 5
UNION ALL
SELECT {_QCOLS} FROM q2 WHERE queue_id NOT IN (SELECT queue_id FROM due2)""",
)
SQL["dead_letter"] = with_(["bump2"], f"SELECT {_QCOLS} FROM bump2 WHERE attempt_count >= 5")
CTE["rechk2"] = "\nrechk2 AS (" + contract_checked("due2", RETRY_REPLAY_AS_OF) + "\n)"
DEPENDS["rechk2"] = ["due2"]
SQL["replay"] = with_(
    ["rechk2"],
    """
SELECT queue_id, transaction_id, attempt_count,
       CASE WHEN errors = '' THEN 'merged' WHEN attempt_count + 1 >= 5 THEN 'dead' ELSE 'requeued' END AS outcome
FROM rechk2""",
)

_TYPED = """transaction_id, game, TRY_CAST(substr(payment_date, 1, 10) AS DATE) AS payment_date,
       CAST(TRY_CAST(trim(price) AS DECIMAL(38,18)) AS DECIMAL(18,4)) AS price, currency, status, ingest_ts"""
SQL["replay_silver"] = with_(
    ["chk2q", "rechk2"],
    f"""
SELECT {_TYPED} FROM chk2q WHERE errors = ''
UNION ALL
SELECT {_TYPED} FROM rechk2 WHERE errors = ''""",
)
SQL["replay_queue"] = with_(
    ["rechk2", "q2"],
    f"""
SELECT queue_id, transaction_id, CAST(attempt_count + 1 AS INTEGER) AS attempt_count, last_error,
       TIMESTAMP '{RETRY_NOW}' + to_hours(CAST(pow(2, attempt_count + 1) AS BIGINT)) AS eligible_at
FROM rechk2 WHERE errors <> '' AND attempt_count + 1 < 5
UNION ALL
SELECT {_QCOLS} FROM q2 WHERE queue_id NOT IN (SELECT queue_id FROM due2)""",
)
SQL["quarantine_sink"] = with_(["chk2"], f"SELECT {_RAW_LINE} AS record, errors FROM chk2 WHERE errors <> ''")

# --- dimensions, SCD2 and joins over F1 --------------------------------------------------------
SCD2_AS_OF = "1998-01-01 00:00:00"
CTE["games"] = "\ngames AS (SELECT DISTINCT c_mktsegment AS game_key FROM customer)"
CTE["dimg"] = f"""
dimg AS (
  SELECT {sk_sql('game_key', "TIMESTAMP '1990-01-01 00:00:00'")} AS game_sk, game_key, lower(game_key) AS game_name,
         'genre_' || CAST(length(game_key) % 3 AS VARCHAR) AS genre, 'studio_' || substr(game_key, 1, 2) AS studio,
         TIMESTAMP '1990-01-01 00:00:00' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
  FROM games WHERE game_key <> 'MACHINERY'
  UNION ALL
  SELECT {sk_sql('game_key', "TIMESTAMP '1980-01-01 00:00:00'")}, game_key, lower(game_key), 'legacy',
         'studio_' || substr(game_key, 1, 2), TIMESTAMP '1980-01-01 00:00:00', TIMESTAMP '1990-01-01 00:00:00', FALSE
  FROM games WHERE game_key = 'AUTOMOBILE'
)"""
CTE["gupd"] = """
gupd AS (
  SELECT game_key, lower(game_key) AS game_name,
         CASE WHEN length(game_key) % 2 = 0 THEN 'genre_new' ELSE 'genre_' || CAST(length(game_key) % 3 AS VARCHAR) END
           AS genre,
         'studio_' || substr(game_key, 1, 2) AS studio
  FROM games
)"""
_GDIFF = "(c.game_name IS DISTINCT FROM u.game_name OR c.genre IS DISTINCT FROM u.genre OR c.studio IS DISTINCT FROM u.studio)"
CTE["scd"] = f"""
scd AS (
  SELECT * FROM dimg WHERE NOT is_current
  UNION ALL
  SELECT c.* FROM dimg c LEFT JOIN gupd u ON c.game_key = u.game_key
  WHERE c.is_current AND (u.game_key IS NULL OR NOT {_GDIFF})
  UNION ALL
  SELECT c.game_sk, c.game_key, c.game_name, c.genre, c.studio, c.valid_from, TIMESTAMP '{SCD2_AS_OF}', FALSE
  FROM dimg c JOIN gupd u ON c.game_key = u.game_key WHERE c.is_current AND {_GDIFF}
  UNION ALL
  SELECT {sk_sql('u.game_key', f"TIMESTAMP '{SCD2_AS_OF}'")}, u.game_key, u.game_name, u.genre, u.studio,
         TIMESTAMP '{SCD2_AS_OF}', CAST(NULL AS TIMESTAMP), TRUE
  FROM gupd u LEFT JOIN (SELECT * FROM dimg WHERE is_current) c ON c.game_key = u.game_key
  WHERE c.game_key IS NULL OR {_GDIFF}
)"""
CTE["dimc"] = "\ndimc AS (SELECT DISTINCT currency_code FROM fx1)"
DEPENDS.update({"dimg": ["games"], "gupd": ["games"], "scd": ["dimg", "gupd"], "dimc": ["fx1"]})

SQL["scd2_apply"] = with_(["scd"], "SELECT * FROM scd")
CTE["hist1"] = """
hist1 AS (
  SELECT game_key, since, since + CASE WHEN month(since) % 2 = 0 THEN INTERVAL 400 DAY ELSE INTERVAL 30 DAY END AS recorded_at,
         'genre_' || CAST(n % 3 AS VARCHAR) AS genre
  FROM (SELECT c.c_mktsegment AS game_key, CAST(date_trunc('month', o.o_orderdate) AS TIMESTAMP) AS since, COUNT(*) AS n
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2) m
  UNION ALL
  SELECT DISTINCT c.c_mktsegment, CAST(date_trunc('month', o.o_orderdate) AS TIMESTAMP),
         CAST(date_trunc('month', o.o_orderdate) AS TIMESTAMP) + INTERVAL 500 DAY, 'fixed'
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE month(o.o_orderdate) % 5 = 0
)"""
# Points in time, the last recorded of each; runs of equal ones; the next run's start ends a version.
SQL["scd2_backdated"] = with_(
    ["dimg", "hist1"],
    f"""
SELECT {sk_sql('game_key', 'since')} AS game_sk, game_key, game_name, genre, studio, since AS valid_from, valid_to, valid_to IS NULL AS is_current
FROM (
  SELECT *, LEAD(since) OVER (PARTITION BY game_key ORDER BY since) AS valid_to FROM (
    SELECT *, LAG(opened) OVER k AS o, LAG(game_name) OVER k AS gn, LAG(genre) OVER k AS ge, LAG(studio) OVER k AS st,
           ROW_NUMBER() OVER k AS nth
    FROM (
      SELECT * FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY game_key, since ORDER BY recorded_at DESC NULLS LAST, opened DESC) AS rn
        FROM (
          SELECT game_key, valid_from AS since, TRUE AS opened, game_name, genre, studio, CAST(NULL AS TIMESTAMP) AS recorded_at FROM dimg
          UNION ALL SELECT game_key, valid_to, FALSE, NULL, NULL, NULL, NULL FROM dimg WHERE valid_to IS NOT NULL
          UNION ALL SELECT game_key, since, TRUE, lower(game_key), genre, 'studio_' || substr(game_key, 1, 2), recorded_at FROM hist1) p) r
      WHERE rn = 1) l
    WINDOW k AS (PARTITION BY game_key ORDER BY since)) c
  WHERE nth = 1 OR opened <> o OR game_name IS DISTINCT FROM gn OR genre IS DISTINCT FROM ge OR studio IS DISTINCT FROM st) v
WHERE opened""",
)
SQL["scd2_asof"] = with_(
    ["fact1", "scd"],
    """
SELECT f.transaction_id, f.game_key, f.payment_date, d.game_sk, d.genre
FROM fact1 f LEFT JOIN scd d ON f.game_key = d.game_key AND d.valid_from <= CAST(f.payment_date AS TIMESTAMP)
     AND CAST(f.payment_date AS TIMESTAMP) < COALESCE(d.valid_to, TIMESTAMP '9999-12-31 00:00:00')""",
)
SQL["salted_join"] = with_(
    ["fact1", "dimg"],
    "SELECT f.transaction_id, f.game_key, d.genre, d.is_current FROM fact1 f LEFT JOIN dimg d ON f.game_key = d.game_key",
)
SQL["orphans_game"] = with_(
    ["fact1", "dimg"],
    "SELECT f.* FROM fact1 f WHERE NOT EXISTS (SELECT 1 FROM dimg d WHERE d.is_current AND d.game_key = f.game_key)",
)
SQL["orphans_currency"] = with_(
    ["fact1", "dimc"],
    "SELECT f.* FROM fact1 f WHERE NOT EXISTS (SELECT 1 FROM dimc d WHERE d.currency_code = f.currency_key)",
)
SQL["referential_summary"] = with_(
    ["fact1", "dimg", "dimc"],
    """
SELECT COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM dimg d WHERE d.is_current AND d.game_key = f.game_key))
         AS fact_game_orphans,
       COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM dimc d WHERE d.currency_code = f.currency_key))
         AS fact_currency_orphans
FROM fact1 f""",
)
SQL["reconciliation"] = with_(
    ["f1", "fact1", "mart1"],
    """
SELECT payment_date,
       COALESCE(silver_revenue, 0)::DECIMAL(28,4) AS silver_revenue,
       COALESCE(gold_revenue_eur, 0)::DECIMAL(28,4) AS gold_revenue_eur,
       COALESCE(silver_success_count, 0)::BIGINT AS silver_success_count,
       COALESCE(gold_success_count, 0)::BIGINT AS gold_success_count,
       abs(COALESCE(silver_revenue, 0) - COALESCE(gold_revenue_eur, 0))::DECIMAL(28,4) AS revenue_drift,
       abs(COALESCE(silver_revenue, 0) - COALESCE(gold_revenue_eur, 0)) <= 1000000 AS revenue_ok,
       COALESCE(silver_success_count, 0) = COALESCE(gold_success_count, 0) AS count_ok,
       COALESCE(fact_revenue_eur, 0) = COALESCE(gold_revenue_eur, 0) AS eur_ok
FROM (SELECT payment_date, SUM(price)::DECIMAL(28,4) AS silver_revenue, COUNT(*) AS silver_success_count
      FROM f1 WHERE status = 'success' GROUP BY payment_date) s
FULL OUTER JOIN (SELECT payment_date, SUM(price_eur)::DECIMAL(28,4) AS fact_revenue_eur
      FROM fact1 WHERE status = 'success' GROUP BY payment_date) f USING (payment_date)
FULL OUTER JOIN (SELECT payment_date, SUM(gross_revenue_eur)::DECIMAL(28,4) AS gold_revenue_eur,
      SUM(txn_success_count)::BIGINT AS gold_success_count FROM mart1 GROUP BY payment_date) g USING (payment_date)""",
)

STALE_AS_OF = "2001-08-09"
SQL["freshness_alarm"] = with_(
    ["mart1"],
    f"""
SELECT MAX(payment_date) AS latest_partition, CAST(DATE '{STALE_AS_OF}' - MAX(payment_date) AS INTEGER) AS days_behind,
       CASE WHEN MAX(payment_date) >= DATE '{STALE_AS_OF}' - INTERVAL 1 DAY THEN 'OK' ELSE 'STALE' END AS freshness_status,
       CAST(DATE '{STALE_AS_OF}' - MAX(payment_date) AS INTEGER) > 1 AS freshness_alarm
FROM mart1""",
)
SQL["reconciliation_alarm"] = with_(
    ["merged1", "mart1"],
    """
SELECT payment_date, concat_ws(',', CASE WHEN NOT abs(COALESCE(s.r, 0) - COALESCE(g.r, 0)) <= 1000000 THEN 'revenue' END,
         CASE WHEN COALESCE(s.n, 0) <> COALESCE(g.n, 0) THEN 'count' END) AS failed,
       abs(COALESCE(s.r, 0) - COALESCE(g.r, 0)) > 1000000 OR COALESCE(s.n, 0) <> COALESCE(g.n, 0) AS reconciliation_alarm
FROM (SELECT payment_date, SUM(price) AS r, COUNT(*) AS n FROM merged1 WHERE status = 'success' GROUP BY payment_date) s
FULL OUTER JOIN (SELECT payment_date, SUM(gross_revenue_eur) AS r, SUM(txn_success_count) AS n FROM mart1 GROUP BY payment_date) g
  USING (payment_date)""",
)

# --- pipeline metrics, SLO views and alarms over F2 -----------------------------------------------
QUARANTINE_SPIKE_ROWS = 5
CTE["met2"] = """
met2 AS (
  SELECT 'daily_payments' AS dag_id, 'bronze_to_silver' AS task_id, 'run_' || strftime(run_hour, '%Y%m%d%H') AS run_id,
         CAST(CAST(run_hour AS DATE) AS VARCHAR) AS payment_date, input_rows,
         input_rows - quarantined_rows - CASE WHEN run_hour = TIMESTAMP '2024-01-15 13:00:00' THEN 1 ELSE 0 END
           AS output_rows,
         CAST(0 AS BIGINT) AS rejected_rows, quarantined_rows, run_hour + INTERVAL 59 MINUTE AS recorded_at
  FROM (SELECT date_trunc('hour', ts) AS run_hour, COUNT(*) AS input_rows,
               COUNT(*) FILTER (WHERE event_type = 'view') AS quarantined_rows
        FROM events GROUP BY 1) h
  UNION ALL
  SELECT 'daily_payments', 'bronze_to_silver', 'run_' || strftime(run_hour, '%Y%m%d%H') || '_noop',
         CAST(CAST(run_hour AS DATE) AS VARCHAR), 0, 0, 0, 0, run_hour + INTERVAL 60 MINUTE
  FROM (SELECT DISTINCT date_trunc('hour', ts) AS run_hour FROM events) h0 WHERE hour(run_hour) = 0
)"""
SQL["completeness"] = with_(
    ["met2"],
    """
SELECT payment_date, run_id, input_rows, output_rows, rejected_rows, quarantined_rows, completeness_ratio,
       CASE WHEN completeness_ratio >= 0.999 THEN 'OK' ELSE 'BREACH' END AS completeness_status
FROM (SELECT payment_date, run_id, SUM(input_rows)::BIGINT AS input_rows, SUM(output_rows)::BIGINT AS output_rows,
             SUM(rejected_rows)::BIGINT AS rejected_rows, SUM(quarantined_rows)::BIGINT AS quarantined_rows,
             CAST(SUM(output_rows) AS DOUBLE) / NULLIF(CAST(SUM(input_rows) AS DOUBLE), 0) AS completeness_ratio
      FROM met2 GROUP BY payment_date, run_id) a""",
)
SQL["row_balance"] = with_(
    ["met2"],
    """
SELECT run_id, payment_date, input_rows, output_rows, rejected_rows, quarantined_rows,
       input_rows - (output_rows + rejected_rows + quarantined_rows) AS leaked_rows
FROM met2 WHERE input_rows <> output_rows + rejected_rows + quarantined_rows""",
)
SQL["quarantine_spike"] = with_(
    ["met2"],
    f"""
SELECT w AS window_start, w + INTERVAL 1 HOUR AS window_end, quarantined_rows, min_completeness,
       quarantined_rows > {QUARANTINE_SPIKE_ROWS} AS quarantine_alarm,
       COALESCE(min_completeness < 0.999, FALSE) AS completeness_alarm
FROM (SELECT date_trunc('hour', recorded_at) AS w, SUM(quarantined_rows)::BIGINT AS quarantined_rows,
             MIN(CAST(output_rows AS DOUBLE) / NULLIF(CAST(input_rows AS DOUBLE), 0)) AS min_completeness
      FROM met2 GROUP BY 1) a""",
)

# --- batch manifests and ingestion state over F1 ---------------------------------------------------
_F1COLS = ("transaction_id", "game", "payment_date", "price", "currency", "status", "ingest_ts")
CTE["man1"] = f"""
man1 AS (
  SELECT payment_date AS report_date,
         'run_' || CAST(year(payment_date) * 10000 + month(payment_date) * 100 + day(payment_date) AS VARCHAR) AS run_id,
         COUNT(*) AS rows, CAST(SUM(CAST({sk_sql(*_F1COLS)} AS DECIMAL(38,0))) AS VARCHAR) AS checksum
  FROM f1 GROUP BY payment_date
)"""
DEPENDS["man1"] = ["f1"]
SQL["batch_manifest"] = with_(["man1"], "SELECT * FROM man1")
SQL["new_batches"] = with_(
    ["man1"],
    """
SELECT m.* FROM man1 m WHERE NOT EXISTS (
  SELECT 1 FROM man1 s WHERE s.report_date = m.report_date AND s.checksum = m.checksum
         AND day(s.report_date) % 2 = 0 AND day(s.report_date) <> 1)""",
)

RECORDED_AT = "2001-09-01 00:00:00"
SQL["ingestion_record"] = with_(
    ["man1"],
    f"SELECT report_date, run_id, rows, checksum, 'OK' AS status, TIMESTAMP '{RECORDED_AT}' AS recorded_at FROM man1",
)
SQL["schema_evolve"] = with_(
    ["f1"],
    "SELECT transaction_id, game, payment_date, price, CAST(NULL AS VARCHAR) AS currency, status, ingest_ts FROM f1",
)
SQL["table_layout"] = with_(["f1"], "SELECT * FROM f1")

SILVER_TO_GOLD_DT = "1996-03-15"
SQL["silver_to_gold"] = with_(["mart1"], f"SELECT * FROM mart1 WHERE payment_date = DATE '{SILVER_TO_GOLD_DT}'")

# --- bronze landing, lean tier, bronze -> silver (batch and stream) over F2 -------------------------
CTE["land2"] = """
land2 AS (
  SELECT _id, transaction_id, game, payment_date, price, currency, status, has_extra,
         CAST(ingest_ts AS DATE) AS dt, 'a' AS run_id
  FROM raw2
  UNION ALL
  SELECT _id, transaction_id, game, payment_date, price, currency,
         CASE WHEN status = 'success' THEN 'error' ELSE 'success' END, has_extra,
         CAST(ingest_ts + INTERVAL 1 HOUR AS DATE), 'b'
  FROM raw2 WHERE _id % 10 = 0
)"""
CTE["chkland"] = "\nchkland AS (" + contract_checked("land2", CONTRACT_AS_OF) + "\n)"
CTE["validland"] = """
validland AS (
  SELECT transaction_id, game, TRY_CAST(substr(payment_date, 1, 10) AS DATE) AS payment_date,
         CAST(TRY_CAST(trim(price) AS DECIMAL(38,18)) AS DECIMAL(18,4)) AS price, currency, status,
         CAST(dt AS TIMESTAMP) + CASE run_id WHEN 'a' THEN INTERVAL 6 HOUR WHEN 'b' THEN INTERVAL 18 HOUR
                                    ELSE INTERVAL 0 HOUR END AS ingest_ts,
         dt, run_id
  FROM chkland WHERE errors = ''
)"""
DEPENDS.update({"land2": ["raw2"], "chkland": ["land2"], "validland": ["chkland"]})

LATEST_VALID = """
  SELECT transaction_id, game, payment_date, price, currency, status, ingest_ts FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY ingest_ts DESC) AS rn
    FROM validland WHERE {where}) v WHERE rn = 1"""

SQL["bronze_scan"] = with_(
    ["land2"], "SELECT transaction_id, game, payment_date, price, currency, status, dt, run_id FROM land2"
)
LEAN_DT = "2024-01-15"
SQL["lean_transform"] = with_(
    ["validland"],
    f"""
SELECT transaction_id, game, payment_date, price, currency, status FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY run_id DESC) AS rn
  FROM validland WHERE dt = DATE '{LEAN_DT}') v WHERE rn = 1""",
)
SQL["lean_stored"] = SQL["lean_transform"]
B2S_DT = "2024-01-15"
SQL["bronze_to_silver"] = with_(
    ["validland"], LATEST_VALID.format(where=f"dt IN (DATE '{B2S_DT}' - 1, DATE '{B2S_DT}')")
)
SQL["stream_upsert"] = with_(["validland"], LATEST_VALID.format(where="TRUE"))
SQL["stream_quarantine_spike"] = with_(
    ["chkland"],
    f"""
SELECT w AS window_start, w + INTERVAL 1 HOUR AS window_end, COUNT(*) AS quarantined_rows,
       COUNT(*) > {QUARANTINE_SPIKE_ROWS} AS quarantine_alarm
FROM (SELECT CAST(dt AS TIMESTAMP) + CASE run_id WHEN 'a' THEN INTERVAL 6 HOUR ELSE INTERVAL 18 HOUR END AS w
      FROM chkland WHERE errors <> '') v
GROUP BY w""",
)
SQL["stream_dedup"] = with_(["land2"], f"SELECT DISTINCT {_RAW_LINE} AS value, dt FROM land2 WHERE run_id = 'a'")

# Two daily runs: what was landed, what passed, what was sent twice, what was set aside.
CTE["chkrun"] = """
chkrun AS (
  SELECT * FROM (""" + contract_checked("land2", B2S_DT) + f""") a WHERE dt = DATE '{B2S_DT}'
  UNION ALL
  SELECT * FROM (""" + contract_checked("land2", "2024-01-14") + f""") b WHERE dt = DATE '{B2S_DT}' - 1
)"""
DEPENDS["chkrun"] = ["land2"]
SQL["run_metrics"] = with_(
    ["chkrun"],
    """
SELECT 'daily_payments' AS dag_id, 'bronze_to_silver' AS task_id, 'run_' || CAST(dt AS VARCHAR) AS run_id,
       CAST(dt AS VARCHAR) AS payment_date, COUNT(*) AS input_rows,
       COUNT(DISTINCT transaction_id) FILTER (WHERE errors = '') AS output_rows,
       COUNT(*) FILTER (WHERE errors = '') - COUNT(DISTINCT transaction_id) FILTER (WHERE errors = '') AS rejected_rows,
       COUNT(*) FILTER (WHERE errors <> '') AS quarantined_rows, CAST(dt + 1 AS TIMESTAMP) AS recorded_at
FROM chkrun GROUP BY dt""",
)

# The retry cycle in closed form: a reject of run k fails at the replays k + 1, k + 2, ... unless its only
# fault is a day that the replay's as-of day has reached; its fourth failure is its fifth attempt.
CTE["chkever"] = "\nchkever AS (" + contract_checked("raw2", "2999-01-01") + "\n)"
CTE["cycle"] = f"""
cycle AS (
  SELECT DISTINCT ON (queue_id) * FROM (
    SELECT {_QUEUE_ID} AS queue_id, transaction_id, CAST(_id % 6 AS INTEGER) AS k, errors,
           greatest(0, d - DATE '{RETRY_ENQUEUE_AS_OF}') AS ripe
    FROM chkever WHERE errors <> '' OR d > DATE '{RETRY_ENQUEUE_AS_OF}') c
  ORDER BY queue_id, k
)"""
CTE["cycled"] = """
cycled AS (
  SELECT *, CASE WHEN errors = '' AND greatest(ripe, k + 1) <= least(k + 4, 5) THEN -1 ELSE least(k + 4, 5) - k END AS failures
  FROM cycle
)"""
DEPENDS.update({"chkever": ["raw2"], "cycle": ["chkever"], "cycled": ["cycle"]})
SQL["retry_cycle"] = with_(
    ["cycled"],
    """
SELECT queue_id, transaction_id, CAST(1 + failures AS INTEGER) AS attempt_count,
       TIMESTAMP '2024-01-20 00:00:00' + to_days(k + CAST(failures AS INTEGER))
         + CASE WHEN failures = 0 THEN INTERVAL 0 HOUR ELSE to_hours(CAST(pow(2, 1 + failures) AS BIGINT)) END AS eligible_at,
       CASE WHEN failures = 4 THEN 'dead' ELSE 'queue' END AS place
FROM cycled WHERE failures >= 0""",
)
SQL["schema_history_scan"] = with_(
    ["f1"],
    """
SELECT transaction_id, game, payment_date, price, CASE WHEN year(payment_date) >= 1994 THEN currency END AS currency, status,
       CASE WHEN year(payment_date) >= 1997 THEN ingest_ts END AS ingest_ts
FROM f1""",
)

SQL["dim_currency"] = with_(["f1"], "SELECT DISTINCT currency AS currency_code FROM f1 WHERE currency IS NOT NULL")

# --- two daily runs; the second one brings rows of the first day, 13 days late -----------------------
LATE_FROM_DT = "2024-01-02"
CTE["fx2"] = CTE["fx1"].replace("fx1 AS", "fx2 AS").replace("CAST(o_orderdate AS DATE)", "CAST(ts AS DATE)").replace(
    "FROM orders", "FROM events"
).replace("o_orderdate IS NOT NULL", "ts IS NOT NULL")
CTE["lateland2"] = f"""
lateland2 AS (
  SELECT * REPLACE (CASE WHEN dt = DATE '{LATE_FROM_DT}' AND _id % 7 = 3 THEN DATE '{B2S_DT}' ELSE dt END AS dt) FROM land2
)"""
CTE["chklate"] = "\nchklate AS (" + contract_checked("lateland2", CONTRACT_AS_OF) + "\n)"
CTE["validlate"] = CTE["validland"].replace("validland AS", "validlate AS").replace("chkland", "chklate")
CTE["factlate"] = (
    "\nfactlate AS ("
    + FACT_SELECT.format(
        silver="("
        + LATEST_VALID.format(where=f"dt IN (DATE '{LATE_FROM_DT}', DATE '{B2S_DT}')").replace("validland", "validlate")
        + ")",
        fx="fx2",
    )
    + "\n)"
)
DEPENDS.update({"lateland2": ["land2"], "chklate": ["lateland2"], "validlate": ["chklate"], "factlate": ["validlate", "fx2"]})
SQL["run_day_gold"] = with_(["factlate"], MART_SELECT.format(fact="factlate"))
