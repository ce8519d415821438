"""Brute-force check of the payment_date rules against a Python datetime model."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlake.operators import contract

AS_OF = dt.date(2025, 6, 1)
SHAPE = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}([T ]00:00(:00(\.0+)?)?)?")


def model(text):
    if text is None or not SHAPE.fullmatch(text):
        return ["payment_date_invalid"]
    try:
        d = dt.date(int(text[0:4]), int(text[5:7]), int(text[8:10]))
    except ValueError:
        return ["payment_date_invalid"]
    return ["payment_date_future"] if d > AS_OF else []


def _two(lo, hi):
    return st.integers(lo, hi).map(lambda v: f"{v:02d}")


dates = st.builds(
    lambda y, m, d, sep, tail: f"{y:04d}{sep}{m}{sep}{d}{tail}",
    st.integers(1000, 9999),
    _two(0, 13),
    _two(0, 32),
    st.sampled_from(["-", "-", "-", "/", ""]),
    st.sampled_from(["", "", "T00:00:00", " 00:00", "T00:00:00.000", "T01:00:00", "Z", " "]),
)
texts = st.one_of(dates, st.sampled_from(["", "2025-1-3", "20250103", " 2025-01-03", "2024-02-29", "2023-02-29"]), st.none())


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=100, max_size=300))
def test_date_rules_match_model(spark, values):
    schema = StructType([StructField("payment_date", StringType(), True)])
    df = spark.createDataFrame([(v,) for v in values], schema)
    flags = [(n, c) for n, c in contract.error_flags(AS_OF, None, ["payment_date"]) if n.startswith("payment_date")]
    names = F.concat_ws(",", *[F.when(c, F.lit(n)) for n, c in flags])
    got = [r[0] for r in df.select(names.alias("e")).collect()]
    for v, g in zip(values, got):
        assert g == ",".join(model(v)), (v, g)
