"""Payments-shaped inputs derived from the driver's tables with closed formulas.

Everything here is a Spark plan over ``orders``/``customer``/``events``, so the work grows with
the tables, and every formula has a twin in ``ledgerlake.oracle`` so DuckDB can rebuild the same
rows. No random values and no current time: all as-of moments are fixed arguments.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import MONEY, RATE, date_key, row_digest, ts_lit

# ---------------------------------------------------------------------------------------------
# Fixed values of the fixtures (kept together, in natural order).
# ---------------------------------------------------------------------------------------------
CURRENCY_BY_NATION_MOD5 = ("EUR", "USD", "GBP", "CHF", "JPY")
CURRENCY_BY_USER_MOD4 = ("EUR", "USD", "GBP", "CHF")
# Base rate to EUR in thousandths; EUR is held at 1.000 and JPY has no rate at all.
FX_BASE_MILLI = (("EUR", 1000), ("USD", 910), ("GBP", 1170), ("CHF", 1040))
EVENT_STATUS = (("purchase", "success"), ("error", "error"), ("signup", "pending"), ("click", "refunded"))
ORDER_STATUS = (("F", "success"), ("P", "error"))  # anything else is pending
OMITTED_GAME = "MACHINERY"  # left out of dim_game so orphans exist
CLOSED_VERSION_GAME = "AUTOMOBILE"  # also carries one closed SCD2 version
DIM_VALID_FROM = "1990-01-01 00:00:00"
DIM_CLOSED_FROM = "1980-01-01 00:00:00"
F1_INGEST_OFFSET_HOURS = 6
LATE_BATCH_TS = "2001-09-01 00:00:00"


_SPLITS: dict[tuple[str, str], int] = {}


def table(spark: SparkSession, sf_dir: str, name: str, spread_small: bool = True) -> DataFrame:
    """One of the driver's tables. Each is a single Parquet file with one row group, so it is
    spread over the cores when it would otherwise be scanned by a single task. The split count
    of a path is probed once per application (the input files do not change)."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    df = spark.read.parquet(path)
    if not spread_small:
        return df
    from ledgerlake.sources.tables import spread

    try:
        key = (spark.sparkContext.applicationId, path)
        if key not in _SPLITS:
            _SPLITS[key] = df.rdd.getNumPartitions()
        return spread(df, known_partitions=_SPLITS[key])
    except Exception:
        return spread(df)


def _case(col: Column, pairs, default: Column | None) -> Column:
    expr = None
    for src, dst in pairs:
        expr = F.when(col == F.lit(src), F.lit(dst)) if expr is None else expr.when(col == F.lit(src), F.lit(dst))
    return expr.otherwise(default) if default is not None else expr


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


# ---------------------------------------------------------------------------------------------
# payments from orders (sparse calendar)
# ---------------------------------------------------------------------------------------------
def payments_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    status = F.when(F.pmod("o_orderkey", F.lit(17)) == 0, F.lit("refunded")).otherwise(
        _case(F.col("o_orderstatus"), ORDER_STATUS, F.lit("pending"))
    )
    return j.select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("c_mktsegment").alias("game"),
        F.col("o_orderdate").cast("date").alias("payment_date"),
        F.col("o_totalprice").cast(MONEY).alias("price"),
        _pick(CURRENCY_BY_NATION_MOD5, F.pmod("c_nationkey", F.lit(5))).alias("currency"),
        status.alias("status"),
        (F.col("o_orderdate") + F.expr(f"INTERVAL {F1_INGEST_OFFSET_HOURS} HOURS")).alias("ingest_ts"),
    )


# ---------------------------------------------------------------------------------------------
# payments from events (dense calendar, carries invalid rows)
# ---------------------------------------------------------------------------------------------
def payments_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.concat(F.lit("g"), F.pmod("user_id", F.lit(5)).cast("string")).alias("game"),
        F.col("ts").cast("date").alias("payment_date"),
        F.col("value").cast(MONEY).alias("price"),
        _pick(CURRENCY_BY_USER_MOD4, F.pmod("user_id", F.lit(4))).alias("currency"),
        _case(F.col("event_type"), EVENT_STATUS, F.col("event_type")).alias("status"),
        F.col("ts").alias("ingest_ts"),
    )


def payments_events_dirty_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 with NULLs and bad values injected by key formulas, plus the event key ``_id``."""
    base = payments_events(spark, sf_dir).withColumn("_id", F.col("transaction_id").cast("bigint"))
    k = F.col("_id")
    null_slot = F.when(F.pmod(k, F.lit(11)) == 0, F.pmod(F.floor(k / 11), F.lit(5)))
    return base.select(
        "_id",
        F.when(null_slot == 4, F.lit(None).cast("string")).otherwise(F.col("transaction_id")).alias("transaction_id"),
        "game",
        F.when(null_slot == 3, F.lit(None).cast("date")).otherwise(F.col("payment_date")).alias("payment_date"),
        F.when(null_slot == 0, F.lit(None).cast(MONEY))
        .when(F.pmod(k, F.lit(19)) == 0, -F.col("price"))
        .otherwise(F.col("price"))
        .alias("price"),
        F.when(null_slot == 2, F.lit(None).cast("string"))
        .when(F.pmod(k, F.lit(13)) == 0, F.lower("currency"))
        .otherwise(F.col("currency"))
        .alias("currency"),
        F.when(null_slot == 1, F.lit(None).cast("string")).otherwise(F.col("status")).alias("status"),
        "ingest_ts",
    )


def payments_events_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 with NULLs and bad values injected by key formulas (3-valued DQ checks)."""
    return payments_events_dirty_keyed(spark, sf_dir).drop("_id")


def raw_events(spark: SparkSession, sf_dir: str, resend: bool = False) -> DataFrame:
    """Bronze-shaped raw rows (all STRING plus the JSON line) with contract corruptions.

    Adds the landing day ``dt`` (date of ``ingest_ts``) and ``run_id``: originals land in run
    ``a``; with ``resend`` every tenth id is sent again one hour later with a flipped status,
    in run ``b`` of its own landing day.
    """
    raw = _raw_from_dirty(payments_events_dirty_keyed(spark, sf_dir)).withColumn("run_id", F.lit("a"))
    if resend:
        k = F.col("_id")
        flipped = F.when(F.col("status") == "success", F.lit("error")).otherwise(F.lit("success"))
        again = (
            raw.where(F.pmod(k, F.lit(10)) == 0)
            .withColumn("status", flipped)
            .withColumn("ingest_ts", F.col("ingest_ts") + F.expr("INTERVAL 1 HOURS"))
            .withColumn("run_id", F.lit("b"))
        )
        raw = raw.unionByName(again)
    return _with_raw_line(raw.withColumn("dt", F.col("ingest_ts").cast("date")))


def _raw_from_dirty(d: DataFrame) -> DataFrame:
    """Text form of the dirty rows, with one contract corruption per key formula."""
    k = F.col("_id")
    price_txt = F.col("price").cast("string")
    date_txt = F.col("payment_date").cast("string")
    unpadded = F.concat_ws(
        "-",
        F.year("payment_date").cast("string"),
        F.month("payment_date").cast("string"),
        F.dayofmonth("payment_date").cast("string"),
    )
    raw = d.select(
        "_id",
        F.when(F.pmod(k, F.lit(41)) == 0, F.repeat(F.lit("x"), 65))
        .otherwise(F.col("transaction_id"))
        .alias("transaction_id"),
        F.when(F.pmod(k, F.lit(43)) == 0, F.lit("")).otherwise(F.col("game")).alias("game"),
        F.when(F.pmod(k, F.lit(31)) == 0, unpadded)
        .when(F.pmod(k, F.lit(37)) == 0, F.concat(date_txt, F.lit("T00:00:00")))
        .otherwise(date_txt)
        .alias("payment_date"),
        F.when(F.pmod(k, F.lit(23)) == 0, F.concat(price_txt, F.lit("7")))
        .when(F.pmod(k, F.lit(29)) == 0, F.concat(price_txt, F.lit("0000")))
        .when(F.pmod(k, F.lit(53)) == 0, F.lit("1e2"))
        .when(F.pmod(k, F.lit(59)) == 0, F.lit("99999999999999999999"))
        .when(F.pmod(k, F.lit(61)) == 0, F.lit("NaN"))
        .otherwise(price_txt)
        .alias("price"),
        F.when(F.pmod(k, F.lit(67)) == 0, F.concat(F.col("currency"), F.lit("\n")))
        .otherwise(F.col("currency"))
        .alias("currency"),
        "status",
        "ingest_ts",
    )
    return raw


def _with_raw_line(raw: DataFrame) -> DataFrame:
    """The record as a JSON line; every 47th id also carries a key outside the contract."""
    cols = ["transaction_id", "game", "payment_date", "price", "currency", "status"]
    line = F.to_json(F.struct(*[F.col(c) for c in cols]))
    with_extra = F.concat(F.expr("substring(_line, 1, length(_line) - 1)"), F.lit(',"extra_field":"boom"}'))
    return (
        raw.withColumn("_line", line)
        .withColumn("raw_line", F.when(F.pmod(F.col("_id"), F.lit(47)) == 0, with_extra).otherwise(F.col("_line")))
        .drop("_line")
    )


# ---------------------------------------------------------------------------------------------
# derived dimensions and batches
# ---------------------------------------------------------------------------------------------
def fx_rates_for(dates: DataFrame, date_col: str = "payment_date") -> DataFrame:
    """One rate per (day, currency) for the days in ``dates``; JPY deliberately absent.

    The output is bounded by days x 4 currencies, whatever the size of ``dates``' source.
    """
    days = dates.select(F.col(date_col).alias("rate_date")).where(F.col("rate_date").isNotNull()).distinct()
    pairs = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(m).alias("milli")) for c, m in FX_BASE_MILLI])
    x = days.select("rate_date", F.explode(pairs).alias("p"))
    milli = F.when(F.col("p.code") == "EUR", F.col("p.milli")).otherwise(
        F.col("p.milli") + F.pmod(F.dayofmonth("rate_date"), F.lit(13))
    )
    return x.select(
        F.col("p.code").alias("currency_code"),
        "rate_date",
        (milli.cast("decimal(10,0)") / F.lit(1000)).cast(RATE).alias("rate_to_eur"),
    )


def fx_rates_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("payment_date"))
    return fx_rates_for(o)


def fx_rates_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("payment_date"))
    return fx_rates_for(e)


def _sk(game_key: Column, valid_from: Column) -> Column:
    return row_digest([game_key, valid_from])


def dim_game(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current version per F1 game except one omitted game, plus one closed version."""
    games = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("game_key")).distinct()
    cur = games.where(F.col("game_key") != F.lit(OMITTED_GAME)).select(
        "game_key",
        F.lower("game_key").alias("game_name"),
        F.concat(F.lit("genre_"), F.pmod(F.length("game_key"), F.lit(3)).cast("string")).alias("genre"),
        F.concat(F.lit("studio_"), F.substring("game_key", 1, 2)).alias("studio"),
        ts_lit(DIM_VALID_FROM).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    closed = games.where(F.col("game_key") == F.lit(CLOSED_VERSION_GAME)).select(
        "game_key",
        F.lower("game_key").alias("game_name"),
        F.lit("legacy").alias("genre"),
        F.concat(F.lit("studio_"), F.substring("game_key", 1, 2)).alias("studio"),
        ts_lit(DIM_CLOSED_FROM).alias("valid_from"),
        ts_lit(DIM_VALID_FROM).alias("valid_to"),
        F.lit(False).alias("is_current"),
    )
    both = cur.unionByName(closed)
    return both.select(_sk(F.col("game_key"), F.col("valid_from")).alias("game_sk"), *both.columns)


def game_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New attribute snapshot for every F1 game: even-length names change genre."""
    games = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("game_key")).distinct()
    genre = F.when(F.pmod(F.length("game_key"), F.lit(2)) == 0, F.lit("genre_new")).otherwise(
        F.concat(F.lit("genre_"), F.pmod(F.length("game_key"), F.lit(3)).cast("string"))
    )
    return games.select(
        "game_key",
        F.lower("game_key").alias("game_name"),
        genre.alias("genre"),
        F.concat(F.lit("studio_"), F.substring("game_key", 1, 2)).alias("studio"),
    )


def game_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements about every F1 game's genre, one for each month with orders (and a correction for every
    fifth month), recorded in another order than the months': odd months soon, even ones a year later."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("game_key"))
    month = F.to_timestamp_ntz(F.date_format("o_orderdate", "yyyy-MM-01 00:00:00")).alias("at")
    counts = o.join(c, o["o_custkey"] == c["c_custkey"]).groupBy("game_key", month).agg(F.count(F.lit(1)).alias("n"))
    number = F.month("at")
    delay = F.when(number % 2 == 0, F.expr("INTERVAL 400 DAYS")).otherwise(F.expr("INTERVAL 30 DAYS"))
    first = counts.select(
        "game_key", "at", (F.col("at") + delay).alias("recorded_at"), F.concat(F.lit("genre_"), F.pmod("n", F.lit(3)).cast("string")).alias("genre")
    )
    fixed = counts.where(number % 5 == 0).select("game_key", "at", (F.col("at") + F.expr("INTERVAL 500 DAYS")).alias("recorded_at"), F.lit("fixed").alias("genre"))
    both = first.unionByName(fixed)
    return both.select(
        "game_key", "at", "recorded_at", F.lower("game_key").alias("game_name"), "genre",
        F.concat(F.lit("studio_"), F.substring("game_key", 1, 2)).alias("studio"),
    )


def dim_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx_rates_orders(spark, sf_dir).select("currency_code").distinct()


def duplicate_batch(silver: DataFrame) -> DataFrame:
    """Every tenth id re-sent one day later with a flipped status."""
    k = F.col("transaction_id").cast("bigint")
    flipped = F.when(F.col("status") == "success", F.lit("error")).otherwise(F.lit("success"))
    return silver.where(F.pmod(k, F.lit(10)) == 0).select(
        "transaction_id",
        "game",
        "payment_date",
        "price",
        "currency",
        flipped.alias("status"),
        (F.col("ingest_ts") + F.expr("INTERVAL 1 DAYS")).alias("ingest_ts"),
    )


def late_batch(silver: DataFrame) -> DataFrame:
    """Update (k%7=0, flipped status), no-op (k%7=1) and insert (k%7=2, new ids) branches,
    derived in one pass over ``silver``."""
    k = F.pmod(F.col("transaction_id").cast("bigint"), F.lit(7))
    flipped = F.when(F.col("status") == "success", F.lit("refunded")).otherwise(F.lit("success"))
    is_new = k == 2
    return silver.where(k.isin(0, 1, 2)).select(
        F.when(is_new, F.concat(F.lit("late-"), F.col("transaction_id"))).otherwise(F.col("transaction_id")).alias("transaction_id"),
        "game",
        F.when(is_new, F.date_add("payment_date", 1)).otherwise(F.col("payment_date")).alias("payment_date"),
        "price",
        "currency",
        F.when(k == 0, flipped).otherwise(F.col("status")).alias("status"),
        ts_lit(LATE_BATCH_TS).alias("ingest_ts"),
    )


def erasure_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every order of customers with c_custkey % 97 = 0 (an erasure request)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return o.where(F.pmod("o_custkey", F.lit(97)) == 0).select(
        F.col("o_orderkey").cast("string").alias("transaction_id")
    )


LEAK_HOUR = "2024-01-15 13:00:00"


def pipeline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metrics row per hourly run of F2, one leaking run, one empty run per day."""
    e = table(spark, sf_dir, "events").select("ts", "event_type")
    hourly = (
        # Hour bucket computed on the wall-clock text, so it does not depend on the session zone.
        e.groupBy(F.to_timestamp_ntz(F.date_format("ts", "yyyy-MM-dd HH:00:00")).alias("run_hour"))
        .agg(F.count(F.lit(1)).alias("input_rows"), F.count_if(F.col("event_type") == "view").alias("quarantined_rows"))
    )
    run_hour = F.col("run_hour").cast("timestamp_ntz")
    leak = F.when(run_hour == ts_lit(LEAK_HOUR), F.lit(1)).otherwise(F.lit(0))
    runs = hourly.select(
        F.lit("daily_payments").alias("dag_id"),
        F.lit("bronze_to_silver").alias("task_id"),
        F.concat(F.lit("run_"), F.date_format(run_hour, "yyyyMMddHH")).alias("run_id"),
        run_hour.cast("date").cast("string").alias("payment_date"),
        F.col("input_rows").cast("bigint").alias("input_rows"),
        (F.col("input_rows") - F.col("quarantined_rows") - leak).cast("bigint").alias("output_rows"),
        F.lit(0).cast("bigint").alias("rejected_rows"),
        F.col("quarantined_rows").cast("bigint").alias("quarantined_rows"),
        (run_hour + F.expr("INTERVAL 59 MINUTES")).alias("recorded_at"),
    )
    empty = runs.where(F.hour(F.col("recorded_at")) == 0).select(
        "dag_id",
        "task_id",
        F.concat(F.col("run_id"), F.lit("_noop")).alias("run_id"),
        "payment_date",
        *[F.lit(0).cast("bigint").alias(c) for c in ("input_rows", "output_rows", "rejected_rows", "quarantined_rows")],
        (F.col("recorded_at") + F.expr("INTERVAL 1 MINUTES")).alias("recorded_at"),
    )
    return runs.unionByName(empty)


def manifests(silver: DataFrame) -> DataFrame:
    """Batch manifest of F1 per day (one landed batch per payment day)."""
    from ledgerlake.operators.ops import batch_manifest

    batches = silver.withColumn("report_date", F.col("payment_date")).withColumn(
        "run_id", F.concat(F.lit("run_"), date_key("payment_date").cast("string"))
    )
    return batch_manifest(batches, ["report_date", "run_id"], list(silver.columns))


def ingestion_state(manifest: DataFrame) -> DataFrame:
    """Even days landed OK, day 1 of each month FAILED, the rest never recorded."""
    dom = F.dayofmonth("report_date")
    return manifest.where((F.pmod(dom, F.lit(2)) == 0) | (dom == 1)).select(
        "report_date",
        "run_id",
        "rows",
        "checksum",
        F.when(dom == 1, F.lit("FAILED")).otherwise(F.lit("OK")).alias("status"),
        F.to_timestamp_ntz(F.concat(F.col("report_date").cast("string"), F.lit(" 23:00:00"))).alias("recorded_at"),
    )


RETRY_ENQUEUE_AS_OF = "2024-01-10"
RETRY_NOW = "2024-01-20 00:00:00"


def retry_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rejects of F2 (checked as of ``RETRY_ENQUEUE_AS_OF``) with attempts 1..5 and
    ``eligible_at`` at their event time, so some are due at ``RETRY_NOW`` and some are not."""
    from ledgerlake.operators import contract, retry

    checked = contract.with_errors(raw_events(spark, sf_dir), RETRY_ENQUEUE_AS_OF)
    bad = checked.where(F.size("errors") > 0)
    return bad.select(
        retry.queue_id().alias(retry.QUEUE_KEY),
        "transaction_id",
        "game",
        "payment_date",
        "price",
        "currency",
        "status",
        "raw_line",
        (F.pmod("_id", F.lit(5)) + 1).cast("int").alias("attempt_count"),
        F.array_join("errors", ",").alias("last_error"),
        F.col("ingest_ts").alias("eligible_at"),
        F.col("ingest_ts").alias("arrived_at"),
    )


# Landing time of a bronze run: run ``a`` lands at 06:00 and run ``b`` at 18:00 of its day.
RUN_LANDING_HOURS = (("a", 6), ("b", 18))


RETRY_CYCLE_RUNS = 6
RETRY_CYCLE_FROM = "2024-01-20"


def retry_rejects(spark: SparkSession, sf_dir: str, run: int) -> DataFrame:
    """Contract rejects of F2 as of ``RETRY_ENQUEUE_AS_OF`` that run ``run`` of the retry cycle meets."""
    from ledgerlake.operators import contract

    checked = contract.with_errors(raw_events(spark, sf_dir), RETRY_ENQUEUE_AS_OF)
    return checked.where((F.size("errors") > 0) & (F.pmod("_id", F.lit(RETRY_CYCLE_RUNS)) == run))


def landing_ts() -> Column:
    """Arrival time of a bronze record, from its ``dt``/``run_id`` partition values."""
    hours = _case(F.col("run_id"), RUN_LANDING_HOURS, F.lit(0))
    return F.col("dt").cast("timestamp_ntz") + F.make_interval(hours=hours.cast("int"))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table read as a file stream (the table file is the only match)."""
    schema = table(spark, sf_dir, "events").schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .option("maxFilesPerTrigger", "1")
        .parquet(sf_dir)
    )
