"""Column-expression helpers (all JVM-side built-ins; no Python UDFs)."""

from ledgerlake.functions.exprs import (
    MONEY,
    RATE,
    date_key,
    decimal_lit,
    hex60,
    row_digest,
    safe_ratio,
    ts_lit,
)

__all__ = [
    "MONEY",
    "RATE",
    "date_key",
    "decimal_lit",
    "hex60",
    "row_digest",
    "safe_ratio",
    "ts_lit",
]
