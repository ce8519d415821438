"""Scalar expressions shared by the operators."""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Money is DECIMAL(18,4) end to end; FX rates are DECIMAL(10,6) so that price x rate stays
# within 38 digits in every engine that reads the tables.
MONEY = DecimalType(18, 4)
RATE = DecimalType(10, 6)

NULL_TOKEN = "\\N"
FIELD_SEP = "|"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decimal_lit(value: str | int | Decimal, dtype: DecimalType = MONEY) -> Column:
    """A typed decimal literal (a bare ``lit(1.0)`` would turn decimal arithmetic into double)."""
    return F.lit(Decimal(str(value))).cast(dtype)


def ts_lit(value: str | _dt.datetime | _dt.date) -> Column:
    """A TIMESTAMP_NTZ literal. All as-of times are explicit arguments, never ``now()``."""
    if isinstance(value, _dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = str(value)
    return F.to_timestamp_ntz(F.lit(text))


def date_lit(value: str | _dt.date) -> Column:
    text = value.isoformat() if isinstance(value, _dt.date) else str(value)
    return F.to_date(F.lit(text))


def date_key(c: str | Column) -> Column:
    """DATE -> yyyyMMdd INT surrogate, with integer arithmetic instead of string formatting."""
    d = col_of(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / NULLIF(den, 0)`` in double precision."""
    return col_of(num).cast("double") / F.nullif(col_of(den).cast("double"), F.lit(0.0))


def canonical_text(cols: list[str | Column]) -> Column:
    """One string per row: each value cast to string, NULL as ``\\N``, joined by ``|``."""
    parts = [F.coalesce(col_of(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.concat_ws(FIELD_SEP, *parts)


def content_key(cols: list[str | Column]) -> Column:
    """SHA-256 (hex) of a row. Every value is written with its length, so no two rows share a text."""
    texts = [col_of(c).cast("string") for c in cols]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat_ws(FIELD_SEP, *parts), 256)


def hex60(hex_col: Column) -> Column:
    """First 15 hex digits of a digest as a non-negative BIGINT (60 bits)."""
    return F.conv(F.substring(hex_col, 1, 15), 16, 10).cast("bigint")


def row_digest(cols: list[str | Column]) -> Column:
    """A 60-bit SHA-256 digest of a row's canonical text (order-insensitive when summed)."""
    return hex60(F.sha2(canonical_text(cols), 256))
