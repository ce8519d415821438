"""Analyst marts over the daily KPI table: rolling windows, anomalies, SLO views.

Windows partition by game over the *mart* (one row per game-day), so a game that holds a third
of the raw payments still contributes at most one row per calendar day here: window
partitions are bounded by the calendar, not by the payment volume.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import MONEY, content_key, date_lit, row_digest, safe_ratio

SEVERITY_ALERT_Z = 3.0
SEVERITY_WARN_Z = 2.0
COMPLETENESS_SLO = 0.999
RECONCILIATION_TOLERANCE = 1_000_000


def _by_game(order: str = "payment_date"):
    return Window.partitionBy("game_key").orderBy(order)


def kpi_rolling(mart: DataFrame) -> DataFrame:
    """7- and 28-row rolling revenue and week-over-week growth per game.

    Frames count rows (days present), not calendar days, matching the published view; see
    ``kpi_rolling_calendar`` for the gap-safe variant.
    """
    w = _by_game()
    rev = F.col("gross_revenue_eur")
    prev7 = F.lag(rev, 7).over(w)
    return mart.select(
        "game_key",
        "payment_date",
        "gross_revenue_eur",
        "success_rate",
        "txn_success_count",
        "avg_txn_value_eur",
        F.sum(rev).over(w.rowsBetween(-6, 0)).cast(MONEY).alias("revenue_7d"),
        F.sum(rev).over(w.rowsBetween(-27, 0)).cast(MONEY).alias("revenue_28d"),
        (safe_ratio(rev, prev7) - F.lit(1.0)).alias("wow_growth"),
    )


def kpi_rolling_calendar(mart: DataFrame) -> DataFrame:
    """Calendar-true variant: frames over day numbers, growth against exactly 7 days back."""
    day = F.datediff(F.col("payment_date"), F.lit(_dt.date(1970, 1, 1)))
    w = Window.partitionBy("game_key").orderBy(day)
    rev = F.col("gross_revenue_eur")
    prev7 = F.sum(rev).over(w.rangeBetween(-7, -7))
    return mart.select(
        "game_key",
        "payment_date",
        "gross_revenue_eur",
        F.sum(rev).over(w.rangeBetween(-6, 0)).cast(MONEY).alias("revenue_7d"),
        F.sum(rev).over(w.rangeBetween(-27, 0)).cast(MONEY).alias("revenue_28d"),
        (safe_ratio(rev, prev7) - F.lit(1.0)).alias("wow_growth"),
    )


def severity_of(z: Column) -> Column:
    return F.when(F.abs(z) > SEVERITY_ALERT_Z, "ALERT").when(F.abs(z) > SEVERITY_WARN_Z, "WARN").otherwise("OK")


def kpi_anomalies(mart: DataFrame, digits: int = 6) -> DataFrame:
    """Trailing 28-row z-score of daily revenue (excluding the day itself) and a severity.

    NULL revenue, a single prior value (sample stddev NULL) or zero spread give a NULL z-score,
    which is reported as OK.
    """
    w = _by_game().rowsBetween(-28, -1)
    rev = F.col("gross_revenue_eur").cast("double")
    mu = F.avg(rev).over(w)
    sigma = F.stddev_samp(rev).over(w)
    z = (rev - mu) / F.nullif(sigma, F.lit(0.0))
    scored = mart.select("game_key", "payment_date", "gross_revenue_eur", z.alias("z_score"))
    # The severity is taken from the exact score; only the reported score is rounded.
    return scored.withColumn("severity", severity_of(F.col("z_score"))).withColumn("z_score", F.round("z_score", digits))


# --- rolling and anomaly views refreshed where the mart changed --------------------------------------
#: Rows after a changed one that its value reaches (the z-score's frame is the longest), and rows
#: before a refreshed one that its frames read.
REACH = 28


def kpi_views(mart: DataFrame, by: tuple[str, ...] = ("game_key",)) -> DataFrame:
    """The columns of ``kpi_rolling`` and ``kpi_anomalies`` together, in one pass over the mart."""
    w = Window.partitionBy(*by).orderBy("payment_date")
    rev = F.col("gross_revenue_eur")
    before = w.rowsBetween(-REACH, -1)
    amount = rev.cast("double")
    z = (amount - F.avg(amount).over(before)) / F.nullif(F.stddev_samp(amount).over(before), F.lit(0.0))
    scored = mart.select(
        "*",
        F.sum(rev).over(w.rowsBetween(-6, 0)).cast(MONEY).alias("revenue_7d"),
        F.sum(rev).over(w.rowsBetween(-27, 0)).cast(MONEY).alias("revenue_28d"),
        (safe_ratio(rev, F.lag(rev, 7).over(w)) - F.lit(1.0)).alias("wow_growth"),
        z.alias("z_score"),
    )
    return scored.withColumn("severity", severity_of(F.col("z_score"))).withColumn("z_score", F.round("z_score", 6))


def affected_rows(mart: DataFrame, changed: DataFrame) -> DataFrame:
    """``game_key, payment_date, island, affected``: the rows of the new mart that a refresh has to read.

    ``changed`` holds the (game, day) whose mart row came, went or changed. Frames count
    rows, so a change reaches the ``REACH`` rows after it, wherever in the calendar they are, and a row that came
    or went moves the frames of as many. Ranges and the ``REACH`` rows of context
    before them that touch one another form an island. Only keys of games with a change are looked at.
    """
    marked = changed.select("game_key", "payment_date").distinct()
    keys = mart.select("game_key", "payment_date").join(marked.select("game_key").distinct(), "game_key", "left_semi")
    spots = keys.withColumns({"here": F.lit(1), "hit": F.lit(0)}).unionByName(marked.withColumns({"here": F.lit(0), "hit": F.lit(1)}))
    spots = spots.groupBy("game_key", "payment_date").agg(F.max("here").alias("here"), F.max("hit").alias("hit"))
    w = _by_game()
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = w.rowsBetween(1, Window.unboundedFollowing)
    spots = spots.withColumn("place", F.sum("here").over(so_far))
    # A row that went starts its range at the next row that is there.
    spots = spots.withColumn("start", F.when(F.col("hit") == 1, F.col("place") + 1 - F.col("here")))
    spots = spots.withColumns({"since": F.max("start").over(so_far), "until": F.min("start").over(later)}).where("here = 1")
    affected = F.coalesce(F.col("place") <= F.col("since") + REACH, F.lit(False))
    context = F.coalesce(F.col("place") >= F.col("until") - REACH, F.lit(False))
    spots = spots.withColumn("affected", affected).where(affected | context)
    # Rows of an island stand one after another.
    opens = F.when(F.col("place") - F.lag("place").over(w) == 1, 0).otherwise(1)
    return spots.withColumn("opens", opens).select("game_key", "payment_date", F.sum("opens").over(so_far).alias("island"), "affected")


def refresh_kpis(views: DataFrame, mart: DataFrame, changed: DataFrame) -> DataFrame:
    """``views`` (``kpi_views`` of the mart before) brought to the new ``mart``.

    Only the islands of ``affected_rows`` are computed again, each from its own rows; all other rows
    of the views stay as they are, and those of rows that went are dropped.
    """
    spots = affected_rows(mart, changed)
    rows = mart.join(spots, ["game_key", "payment_date"])
    fresh = kpi_views(rows, ("game_key", "island")).where("affected").select(*views.columns)
    stale = spots.where("affected").select("game_key", "payment_date").unionByName(changed.select("game_key", "payment_date"))
    return views.join(stale.distinct(), ["game_key", "payment_date"], "left_anti").select(*views.columns).unionByName(fresh)


def data_freshness(mart: DataFrame, as_of: str | _dt.date) -> DataFrame:
    """One row: latest partition, days behind ``as_of``, OK when at most one day behind."""
    latest = F.max("payment_date")
    return mart.agg(
        latest.alias("latest_partition"),
        F.datediff(date_lit(as_of), latest).alias("days_behind"),
        F.when(latest >= F.date_sub(date_lit(as_of), 1), "OK").otherwise("STALE").alias("freshness_status"),
    )


def completeness(metrics: DataFrame, slo: float = COMPLETENESS_SLO) -> DataFrame:
    """Rows out vs rows in per (payment_date, run_id); BREACH below the SLO or when undefined."""
    agg = metrics.groupBy("payment_date", "run_id").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("input_rows", "output_rows", "rejected_rows", "quarantined_rows")]
    )
    ratio = safe_ratio("output_rows", "input_rows")
    return agg.withColumn("completeness_ratio", ratio).withColumn(
        "completeness_status",
        F.when(F.col("completeness_ratio") >= F.lit(slo), "OK").otherwise("BREACH"),
    )


def reconciliation_gold(mart: DataFrame) -> DataFrame:
    """Per-row reconciliation surface of the mart."""
    return mart.select(
        "payment_date",
        F.col("gross_revenue_eur").alias("gold_revenue_eur"),
        F.col("txn_success_count").alias("gold_success_count"),
    )


def reconciliation(
    silver: DataFrame,
    fact: DataFrame,
    mart: DataFrame,
    tolerance: float = RECONCILIATION_TOLERANCE,
) -> DataFrame:
    """Per day: silver vs gold success counts (exact) and revenue.

    ``silver_revenue`` is in native currency and compared with the EUR mart under the coarse
    ``tolerance`` (a total-loss guard); ``fact_revenue_eur`` is compared exactly with the mart.
    Each side is a partial aggregate down to one row per day before the full outer join, so
    the join shuffles days, not payments.
    """
    ok = F.col("status") == F.lit("success")
    s = silver.where(ok).groupBy("payment_date").agg(
        F.sum("price").cast("decimal(28,4)").alias("silver_revenue"),
        F.count(F.lit(1)).alias("silver_success_count"),
    )
    f = fact.where(ok).groupBy("payment_date").agg(
        F.sum("price_eur").cast("decimal(28,4)").alias("fact_revenue_eur")
    )
    g = mart.groupBy("payment_date").agg(
        F.sum("gross_revenue_eur").cast("decimal(28,4)").alias("gold_revenue_eur"),
        F.sum("txn_success_count").cast("bigint").alias("gold_success_count"),
    )
    j = s.join(f, "payment_date", "full_outer").join(g, "payment_date", "full_outer")
    zero = F.lit(0).cast("decimal(28,4)")
    drift = F.abs(F.coalesce("silver_revenue", zero) - F.coalesce("gold_revenue_eur", zero))
    return j.select(
        "payment_date",
        F.coalesce("silver_revenue", zero).alias("silver_revenue"),
        F.coalesce("gold_revenue_eur", zero).alias("gold_revenue_eur"),
        F.coalesce("silver_success_count", F.lit(0).cast("bigint")).alias("silver_success_count"),
        F.coalesce("gold_success_count", F.lit(0).cast("bigint")).alias("gold_success_count"),
        drift.cast("decimal(28,4)").alias("revenue_drift"),
        (drift <= F.lit(tolerance)).alias("revenue_ok"),
        (F.coalesce("silver_success_count", F.lit(0)) == F.coalesce("gold_success_count", F.lit(0))).alias("count_ok"),
        (F.coalesce("fact_revenue_eur", zero) == F.coalesce("gold_revenue_eur", zero)).alias("eur_ok"),
    )


# --- reconciliation row by row ------------------------------------------------------------------
BUCKETS = 64


def bucket_digests(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], by: str = "payment_date", buckets: int = BUCKETS) -> DataFrame:
    """Row count and content digest of every (day, key bucket); rows in any order give the same."""
    digest = row_digest([*keys, by, *columns]).cast("decimal(38,0)")
    return _bucketed(rows, keys, buckets).groupBy(by, "_ll_bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(digest).alias("digest"))


def _bucketed(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return rows.withColumn("_ll_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def differing_buckets(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], by: str = "payment_date", buckets: int = BUCKETS
) -> DataFrame:
    """``(by, bucket)`` whose digests differ or that one side lacks. Only digests are joined: days x buckets rows a side."""
    a = bucket_digests(left, keys, columns, by, buckets).alias("a")
    b = bucket_digests(right, keys, columns, by, buckets).alias("b")
    same = F.col(f"a.{by}").eqNullSafe(F.col(f"b.{by}")) & (F.col("a._ll_bucket") == F.col("b._ll_bucket"))
    differ = ~(F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.digest").eqNullSafe(F.col("b.digest")))
    return a.join(b, same, "full_outer").where(differ).select(
        F.coalesce(f"a.{by}", f"b.{by}").alias(by), F.coalesce("a._ll_bucket", "b._ll_bucket").alias("_ll_bucket")
    )


def reconcile_rows(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] = ("transaction_id",),
    columns: Sequence[str] | None = None,
    by: str = "payment_date",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Every key that ``right`` lacks, has too much or holds with other values: ``keys, kind, n_left, n_right, differs``.

    Digests of (day, key bucket) are compared first; rows are fetched from buckets that differ and from
    no others, so equal data are never joined. ``kind`` is ``missing``, ``extra`` or ``altered``;
    ``differs`` names the columns whose values differ, in order (the day among them: a row that moved
    to another day has both its buckets opened). A key with several rows is compared as a multiset.
    Rows with a NULL key are compared by their content: an unequal number of equal ones is ``altered``.
    """
    keys = list(keys)
    columns = [c for c in (columns or left.columns) if c not in keys and c != by]
    found = differing_buckets(left, right, keys, columns, by, buckets)
    values = [by, *columns]
    own = F.lit(False)
    for k in keys:
        own = own | F.col(k).isNull()

    def drilled(side: DataFrame, n: str) -> DataFrame:
        wanted = found.select(F.col(by).alias("_ll_by"), F.col("_ll_bucket").alias("_ll_b"))
        rows = _bucketed(side, keys, buckets)
        rows = rows.join(wanted, F.col(by).eqNullSafe(F.col("_ll_by")) & (F.col("_ll_bucket") == F.col("_ll_b")), "left_semi")
        # One key may have many rows: their digests are summed for each column before the sides meet.
        sums = [F.sum(row_digest([c]).cast("decimal(38,0)")).alias(f"_ll_d{i}") for i, c in enumerate(values)]
        whole = F.sum(row_digest(values).cast("decimal(38,0)")).alias("_ll_all")
        content = F.when(own, content_key([*keys, *values])).otherwise(F.lit("")).alias("_ll_content")
        return rows.groupBy(*keys, content).agg(F.count(F.lit(1)).alias(n), whole, *sums)

    a, b = drilled(left, "n_left").alias("a"), drilled(right, "n_right").alias("b")
    cond = F.col("a._ll_content") == F.col("b._ll_content")
    for k in keys:
        cond = cond & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    in_a, in_b = F.col("a.n_left").isNotNull(), F.col("b.n_right").isNotNull()
    kind = F.when(~in_b, "missing").when(~in_a, "extra").otherwise("altered")
    parts = [F.when(in_a & in_b & (F.col(f"a._ll_d{i}") != F.col(f"b._ll_d{i}")), F.lit(c)) for i, c in enumerate(values)]
    same = F.col("a._ll_all").eqNullSafe(F.col("b._ll_all")) & F.col("a.n_left").eqNullSafe(F.col("b.n_right"))
    return a.join(b, cond, "full_outer").where(~same).select(
        *[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys],
        kind.alias("kind"),
        F.coalesce("n_left", F.lit(0)).alias("n_left"),
        F.coalesce("n_right", F.lit(0)).alias("n_right"),
        F.concat_ws(",", *parts).alias("differs"),
    )
