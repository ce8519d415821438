"""Brute-force check of the price rules: Spark expressions vs an exact Python Decimal model."""

import decimal
import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlake.operators import contract

PRICE_RE = re.compile(r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?")
EXCESS_RE = re.compile(r"\.[0-9]{4}[0-9]*[1-9]")
CTX = decimal.Context(prec=400, rounding=ROUND_HALF_UP)


def model(text):
    """Price errors by the contract's rules, computed with exact decimals."""
    if text is None:
        return ["price_invalid"]
    p = text.strip(" ")
    if not PRICE_RE.fullmatch(p):
        return ["price_invalid"]
    d = CTX.create_decimal(p)
    num = d.quantize(Decimal(1).scaleb(-18), rounding=ROUND_HALF_UP, context=CTX)
    wide_ok = abs(num) < Decimal(10) ** 20
    narrow = num.quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP, context=CTX)
    narrow_ok = wide_ok and abs(narrow) < Decimal(10) ** 14
    errs = []
    if not (wide_ok and narrow_ok):
        errs.append("price_out_of_range")
    if wide_ok and num <= 0:
        errs.append("price_not_positive")
    if wide_ok:
        excess = ("e" not in p.lower() and EXCESS_RE.search(p) is not None) or num != narrow
        if excess:
            errs.append("price_too_precise")
    return errs


digits = st.text(alphabet="0123456789", min_size=0, max_size=24)
numbers = st.builds(
    lambda sign, whole, frac, dot, exp, pad: f"{pad}{sign}{whole}{'.' if dot else ''}{frac if dot else ''}{exp}{pad}",
    st.sampled_from(["", "+", "-"]),
    digits,
    digits,
    st.booleans(),
    st.one_of(st.just(""), st.builds(lambda e, n: f"{e}{n}", st.sampled_from(["e", "E", "e-", "e+"]), st.integers(0, 40))),
    st.sampled_from(["", " ", "  "]),
)
prices = st.one_of(numbers, st.sampled_from(["NaN", "Infinity", "", "1,5", "0x10", "1e", ".", "-"]), st.none())


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(prices, min_size=100, max_size=300))
def test_price_rules_match_exact_model(spark, texts):
    schema = StructType([StructField("price", StringType(), True)])
    df = spark.createDataFrame([(t,) for t in texts], schema)
    flags = [(n, c) for n, c in contract.error_flags("2025-01-01", None, ["price"]) if n.startswith("price")]
    names = F.concat_ws(",", *[F.when(c, F.lit(n)) for n, c in flags])
    got = [r[0] for r in df.select(names.alias("e")).collect()]
    for text, g in zip(texts, got):
        expected = ",".join(model(text))
        assert g == expected, (text, g, expected)
