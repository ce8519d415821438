"""Silver -> gold: star-schema fact, daily KPI mart, date/currency dimensions, masking."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import MONEY, RATE, date_key, date_lit, decimal_lit

# Columns of the published fact and of its masked projection.
FACT_COLUMNS = (
    "transaction_id",
    "game_key",
    "date_key",
    "currency_key",
    "price",
    "price_eur",
    "status",
    "payment_date",
    "ingest_ts",
)
MASKED_FACT_COLUMNS = ("transaction_id", "game_key", "date_key", "status")


def build_fact(
    silver: DataFrame,
    fx: DataFrame,
    *,
    with_fx_flag: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Fact rows: renamed keys, ``yyyyMMdd`` date key and EUR price.

    The FX table is one row per (currency, day). No hint: adaptive execution broadcasts it when
    its measured bytes allow, and splits a skewed day otherwise. A missing rate
    converts at 1.0 (the price is taken as EUR); ``with_fx_flag`` adds ``fx_missing`` so a
    caller can count or reject such rows; ``keep`` names further columns to carry along. The product is cast once to DECIMAL(18,4)
    (half-up), keeping the fact in exact decimal arithmetic.
    """
    rates = fx.select(
        F.col("currency_code").alias("_fx_code"),
        F.col("rate_date").alias("_fx_date"),
        F.col("rate_to_eur").cast(RATE).alias("_fx_rate"),
    )
    joined = silver.join(
        rates,
        (silver["currency"] == rates["_fx_code"]) & (silver["payment_date"] == rates["_fx_date"]),
        "left",
    )
    rate = F.coalesce(F.col("_fx_rate"), decimal_lit("1.000000", RATE))
    cols = [
        F.col("transaction_id"),
        F.col("game").alias("game_key"),
        date_key("payment_date").alias("date_key"),
        F.col("currency").alias("currency_key"),
        F.col("price").cast(MONEY).alias("price"),
        (F.col("price") * rate).cast(MONEY).alias("price_eur"),
        F.col("status"),
        F.col("payment_date"),
        F.col("ingest_ts"),
    ]
    if with_fx_flag:
        cols.append(F.col("_fx_rate").isNull().alias("fx_missing"))
    return joined.select(*cols, *keep)


def build_agg_game_daily(fact: DataFrame) -> DataFrame:
    """Daily KPI per (game, day): revenue, success/error counts, currencies, success rate.

    One grouped aggregate; Catalyst runs it as partial (map-side) + final aggregation, so a
    hot game is pre-reduced in every map task before the shuffle. Revenue is NULL for a day
    without successful payments; ``success_rate`` ignores pending and refunded rows and is 0.0
    when there are neither successes nor errors.
    """
    ok = F.col("status") == F.lit("success")
    err = F.col("status") == F.lit("error")
    agg = fact.groupBy("game_key", "payment_date").agg(
        F.sum(F.when(ok, F.col("price_eur"))).cast(MONEY).alias("gross_revenue_eur"),
        F.count_if(ok).alias("txn_success_count"),
        F.count_if(err).alias("txn_error_count"),
        F.count_distinct("currency_key").alias("currency_count"),
    )
    return _with_ratios(agg)


def _with_ratios(agg: DataFrame) -> DataFrame:
    return agg.select(
        "game_key",
        "payment_date",
        "gross_revenue_eur",
        "txn_success_count",
        "txn_error_count",
        "currency_count",
        (F.col("gross_revenue_eur").cast("double") / F.nullif(F.col("txn_success_count"), F.lit(0)))
        .alias("avg_txn_value_eur"),
        (
            F.col("txn_success_count")
            / F.greatest(F.col("txn_success_count") + F.col("txn_error_count"), F.lit(1))
        ).alias("success_rate"),
    )


# --- the mart kept up by changes ------------------------------------------------------------------
#: One row for each game, day and currency: counts and sums from which the mart follows.
STATE_KEYS = ("game_key", "payment_date", "currency_key")
STATE_SUMS = ("n_rows", "n_success", "n_error", "revenue_eur")
_SUM = "decimal(28,4)"


def _state_sums(rows: DataFrame, sign: Column) -> DataFrame:
    ok = F.col("status") == F.lit("success")
    err = F.col("status") == F.lit("error")
    zero = F.lit(0).cast(_SUM)

    def counted(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, sign)), F.lit(0)).cast("long")

    revenue = F.sum(F.when(ok, (F.col("price_eur") * sign).cast(_SUM)))
    return rows.groupBy(*STATE_KEYS).agg(
        counted(F.lit(True)).alias("n_rows"),
        counted(ok).alias("n_success"),
        counted(err).alias("n_error"),
        F.coalesce(revenue, zero).cast(_SUM).alias("revenue_eur"),
    )


def mart_state(fact: DataFrame) -> DataFrame:
    """What the mart has to remember so that rows can be taken back out of it.

    A revenue is a sum and can be reduced; a distinct count cannot, so rows are counted by
    currency, and a currency leaves the count with its last row.
    """
    return _state_sums(fact, F.lit(1))


def mart_deltas(feed: DataFrame, fx: DataFrame) -> DataFrame:
    """Signed changes of the mart's state from a feed of silver changes.

    Rows that go (preimages, deletes) count -1 and rows that come +1; the feed is converted to
    EUR with the rates of its days, which must be the ones its rows were first converted with.
    Groups whose changes cancel out are left out.
    """
    gone = F.col("_change_type").isin("update_preimage", "delete")
    signed = feed.withColumn("_ll_sign", F.when(gone, -1).otherwise(1))
    sums = _state_sums(build_fact(signed, fx, keep=("_ll_sign",)), F.col("_ll_sign"))
    return sums.where(" or ".join(f"{c} <> 0" for c in STATE_SUMS))


def fold_state(state: DataFrame, deltas: DataFrame) -> DataFrame:
    """The state after signed changes; a group whose last row went is gone."""
    both = state.select(*STATE_KEYS, *STATE_SUMS).unionByName(deltas.select(*STATE_KEYS, *STATE_SUMS))
    kinds = {"revenue_eur": _SUM}
    return both.groupBy(*STATE_KEYS).agg(*(F.sum(c).cast(kinds.get(c, "long")).alias(c) for c in STATE_SUMS)).where("n_rows <> 0")


def mart_of_state(state: DataFrame) -> DataFrame:
    """The daily mart (``build_agg_game_daily``) from its state."""
    agg = state.groupBy("game_key", "payment_date").agg(
        F.sum(F.when(F.col("n_success") > 0, F.col("revenue_eur"))).cast(MONEY).alias("gross_revenue_eur"),
        F.sum("n_success").alias("txn_success_count"),
        F.sum("n_error").alias("txn_error_count"),
        F.count("currency_key").alias("currency_count"),
    )
    return _with_ratios(agg)


def masked_fact(fact: DataFrame) -> DataFrame:
    """Secure projection for non-finance readers: every row, no price columns."""
    return fact.select(*MASKED_FACT_COLUMNS)


def filter_day(df: DataFrame, dt: str | _dt.date, column: str = "payment_date") -> DataFrame:
    """Typed-literal day filter (prunes directory partitions and row groups)."""
    return df.where(F.col(column) == date_lit(dt))


def filter_days(
    df: DataFrame, start: str | _dt.date, end_exclusive: str | _dt.date, column: str = "payment_date"
) -> DataFrame:
    """Half-open typed range ``[start, end)`` on the partition column."""
    c = F.col(column)
    return df.where((c >= date_lit(start)) & (c < date_lit(end_exclusive)))


def dim_date(dates: DataFrame, column: str = "payment_date") -> DataFrame:
    """Contiguous calendar from the first to the last day in ``dates``.

    The min/max is a global partial aggregate (one row), and the spine is bounded by the
    number of calendar days, not by the number of input rows.
    """
    bounds = dates.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    spine = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return spine.select(
        date_key("d").alias("date_key"),
        F.col("d").alias("date"),
        F.year("d").alias("year"),
        F.quarter("d").alias("quarter"),
        F.month("d").alias("month"),
        F.dayofmonth("d").alias("day"),
        (F.weekday("d") + 1).alias("iso_weekday"),
        (F.weekday("d") >= 5).alias("is_weekend"),
    )


def dim_currency(*sources: DataFrame, column: str = "currency_code") -> DataFrame:
    """Distinct currency codes from the supplied tables."""
    out = None
    for src in sources:
        part = src.select(F.col(column).alias("currency_code"))
        out = part if out is None else out.unionByName(part)
    return out.where(F.col("currency_code").isNotNull()).distinct()
