"""Row contract for raw payment records, as column expressions (no Python UDF).

Raw rows carry every field as STRING (plus optionally the raw JSON line), so the contract
sees the text the provider sent. Each rule yields an error name; a row is good when its
``errors`` array is empty. Accepted forms:

* ``transaction_id`` 1..64 and ``game`` 1..128 characters (code points; blank allowed);
* ``payment_date`` ISO ``yyyy-MM-dd``, optionally with a midnight time, not after ``as_of``;
* ``price`` a decimal number (sign, fraction, exponent, surrounding white space allowed; no
  ``_`` between digits) > 0 with at most 4 significant decimals (trailing zeros do not count),
  fitting DECIMAL(18,4);
* ``currency`` exactly three capital letters (a trailing newline is *not* accepted);
* ``status`` one of the enum values; no keys beyond the six fields in the raw line.

Known leniency: after a STRING read a JSON number and a JSON string look alike, so a numeric
``currency`` or ``transaction_id`` is judged by its text.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import MONEY, date_lit, ts_lit
from ledgerlake.schemas import MAX_GAME_LEN, MAX_TRANSACTION_ID_LEN, PAYMENT_COLUMNS, VALID_STATUS

# Error names in report order, and the accepted text patterns.
ERROR_NAMES = (
    "transaction_id_missing",
    "transaction_id_too_long",
    "game_missing",
    "game_too_long",
    "payment_date_invalid",
    "payment_date_future",
    "price_invalid",
    "price_out_of_range",
    "price_not_positive",
    "price_too_precise",
    "currency_invalid",
    "status_invalid",
    "extra_fields",
)
PRICE_PATTERN = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
PRICE_EXCESS_FRACTION = r"\.[0-9]{4}[0-9]*[1-9]"
PRICE_ZERO = r"^[+-]?(0+\.?0*|\.0+)([eE][+-]?[0-9]+)?$"
DATE_PATTERN = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}([T ]00:00(:00(\.0+)?)?)?\z"
CURRENCY_PATTERN = r"\A[A-Z]{3}\z"
WIDE_DECIMAL = "decimal(38,18)"


def _price_text() -> Column:
    return F.trim(F.col("price"), F.lit(" \t\n\r\f\x0b"))


def parsed_price() -> Column:
    """Exact value of the price text (DECIMAL(38,18)); NULL when unparseable."""
    return _price_text().try_cast(WIDE_DECIMAL)


def parsed_date() -> Column:
    return F.substring(F.col("payment_date"), 1, 10).try_cast("date")


def error_flags(as_of, raw_line_col: str | None = "raw_line", columns=None) -> list[tuple[str, Column]]:
    """(error name, condition) pairs; a condition is TRUE when the row breaks the rule."""
    tid, game = F.col("transaction_id"), F.col("game")
    p = _price_text()
    num = parsed_price()
    syntax_ok = F.coalesce(p.rlike(PRICE_PATTERN), F.lit(False))
    d_ok = F.coalesce(F.col("payment_date").rlike(DATE_PATTERN), F.lit(False))
    d = parsed_date()
    date_valid = d_ok & d.isNotNull()
    narrow = num.try_cast(MONEY)
    zero = F.coalesce(p.rlike(PRICE_ZERO), F.lit(False))
    # Compare at scale 18 on both sides: a plain ``num != round(num, 4)`` is widened by Spark
    # to DECIMAL(38,17) and would round an 18th-decimal digit away.
    excess = (~p.contains("e") & ~p.contains("E") & p.rlike(PRICE_EXCESS_FRACTION)) | (
        num != F.round(num, 4).cast(WIDE_DECIMAL)
    )
    flags = [
        ("transaction_id_missing", tid.isNull() | (F.length(tid) < 1)),
        ("transaction_id_too_long", F.coalesce(F.length(tid) > MAX_TRANSACTION_ID_LEN, F.lit(False))),
        ("game_missing", game.isNull() | (F.length(game) < 1)),
        ("game_too_long", F.coalesce(F.length(game) > MAX_GAME_LEN, F.lit(False))),
        ("payment_date_invalid", ~date_valid),
        ("payment_date_future", date_valid & (d > date_lit(as_of))),
        ("price_invalid", ~syntax_ok),
        # A zero with a large exponent ("0e38") does not parse as DECIMAL(38,18) but is zero.
        ("price_out_of_range", syntax_ok & ~zero & (num.isNull() | narrow.isNull())),
        ("price_not_positive", syntax_ok & (zero | F.coalesce(num <= 0, F.lit(False)))),
        ("price_too_precise", syntax_ok & num.isNotNull() & F.coalesce(excess, F.lit(False))),
        ("currency_invalid", ~F.coalesce(F.col("currency").rlike(CURRENCY_PATTERN), F.lit(False))),
        ("status_invalid", ~F.coalesce(F.col("status").isin(*VALID_STATUS), F.lit(False))),
    ]
    if raw_line_col and (columns is None or raw_line_col in columns):
        allowed = F.array(*[F.lit(c) for c in PAYMENT_COLUMNS])
        extra = F.size(F.array_except(F.json_object_keys(F.col(raw_line_col)), allowed)) > 0
        flags.append(("extra_fields", F.coalesce(extra, F.lit(False))))
    return flags


def error_text(df: DataFrame, as_of, raw_line_col: str | None = "raw_line") -> Column:
    """Comma-joined names of broken rules in ``ERROR_NAMES`` order ('' for a good row).

    ``concat_ws`` skips NULLs, so unbroken rules vanish without a lambda: the expression stays
    inside whole-stage code generation (``array_compact`` would compile to an interpreted
    higher-order ``filter``).
    """
    flags = error_flags(as_of, raw_line_col, df.columns)
    return F.concat_ws(",", *[F.when(cond, F.lit(name)) for name, cond in flags])


def contract_errors(df: DataFrame, as_of, raw_line_col: str | None = "raw_line") -> Column:
    """``array<string>`` of broken rules in ``ERROR_NAMES`` order (empty for a good row)."""
    text = error_text(df, as_of, raw_line_col)
    return F.when(text == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(text, ","))


def with_errors(df: DataFrame, as_of, raw_line_col: str | None = "raw_line") -> DataFrame:
    """``df`` plus ``errors`` (array of broken rule names), each rule evaluated once per row.

    The rule text is produced inside ``inline(array(struct(...)))``: a filter on ``errors``
    (e.g. good vs bad rows) cannot be pushed below that generator, so Catalyst does not
    substitute the whole contract expression into the filter and evaluate it twice; it also
    keeps the generated code of the stage small enough to compile.
    """
    packed = F.struct(*[F.col(c) for c in df.columns], error_text(df, as_of, raw_line_col).alias("_ll_err"))
    checked = df.select(F.inline(F.array(packed)))
    errors = F.when(F.col("_ll_err") == F.lit(""), F.array().cast("array<string>")).otherwise(
        F.split(F.col("_ll_err"), ",")
    )
    return checked.withColumn("errors", errors).drop("_ll_err")


def typed(df: DataFrame, ingest_ts=None, keep=()) -> DataFrame:
    """Convert contract-valid raw rows to the silver schema (plus the ``keep`` columns).

    ``ingest_ts`` is a literal time, a Column, or None to use the row's own ``ingest_ts``.
    """
    if ingest_ts is None:
        ts = F.col("ingest_ts") if "ingest_ts" in df.columns else F.lit(None)
        ts = ts.cast("timestamp_ntz")
    elif isinstance(ingest_ts, Column):
        ts = ingest_ts
    else:
        ts = ts_lit(ingest_ts)
    return df.select(
        "transaction_id",
        "game",
        parsed_date().alias("payment_date"),
        parsed_price().cast(MONEY).alias("price"),
        "currency",
        "status",
        ts.alias("ingest_ts"),
        *keep,
    )


def split_contract(
    raw: DataFrame, as_of, ingest_ts=None, raw_line_col: str | None = "raw_line", keep=()
) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: good rows typed to the silver schema; bad rows keep their raw fields, the
    record as received (the raw line, or the fields as JSON if there is none) and ``errors``."""
    checked = with_errors(raw, as_of, raw_line_col)
    good = typed(checked.where(F.size("errors") == 0), ingest_ts, keep)
    record = F.to_json(F.struct(*[F.col(c) for c in PAYMENT_COLUMNS]))
    if raw_line_col and raw_line_col in raw.columns:
        record = F.coalesce(F.col(raw_line_col), record)
    keep = [c for c in checked.columns if c not in ("errors",)]
    bad = checked.where(F.size("errors") > 0).select(*keep, record.alias("record"), "errors")
    return good, bad


def assert_contract(raw: DataFrame, as_of, raw_line_col: str | None = "raw_line") -> None:
    """All-or-nothing gate: raise when any row breaks the contract."""
    checked = with_errors(raw, as_of, raw_line_col)
    if not checked.where(F.size("errors") > 0).isEmpty():
        summary = error_summary(checked).collect()
        raise ValueError("contract violations: " + ", ".join(f"{r['error']}={r['n_rows']}" for r in summary))


def error_summary(checked: DataFrame) -> DataFrame:
    """Rows per error name (a row with several errors counts once per error)."""
    return checked.select(F.explode("errors").alias("error")).groupBy("error").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def write_quarantine(bad: DataFrame, path: str, dt, run_id: str) -> None:
    """Write bad rows as JSON lines ``{record, errors}`` under ``dt=/run_id=``.

    Dynamic partition overwrite replaces only this run's folder, so re-running a day rewrites
    its quarantine output instead of appending duplicates.
    """
    day = dt.isoformat() if isinstance(dt, _dt.date) else str(dt)
    (
        bad.select("record", "errors", F.lit(day).alias("dt"), F.lit(run_id).alias("run_id"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt", "run_id")
        .json(path)
    )
