"""Contract rows through the column-expression contract (the reference's test intents plus
the edge cases of the contract semantics)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlake.operators import contract
from ledgerlake.schemas import RAW_PAYMENT

AS_OF = "2025-06-01"


def _ok(**over):
    row = {
        "transaction_id": "tx1",
        "game": "funny-game",
        "payment_date": "2025-01-03",
        "price": "2.10",
        "currency": "EUR",
        "status": "success",
    }
    row.update(over)
    return row


def _errors(spark, record: dict, as_of=AS_OF):
    line = json.dumps(record)
    fields = [record.get(c) for c in RAW_PAYMENT.fieldNames()]
    schema = StructType(RAW_PAYMENT.fields + [StructField("raw_line", StringType(), True)])
    df = spark.createDataFrame([(*fields, line)], schema)
    return df.select(contract.contract_errors(df, as_of).alias("e")).first()["e"]


def test_valid(spark):
    assert _errors(spark, _ok()) == []


def test_valid_row_is_typed(spark):
    raw = spark.createDataFrame([tuple(_ok().values())], RAW_PAYMENT)
    good, bad = contract.split_contract(raw, AS_OF, ingest_ts="2025-01-04 00:00:00", raw_line_col=None)
    row = good.first()
    assert bad.count() == 0
    assert str(row["price"]) == "2.1000" and row["payment_date"] == dt.date(2025, 1, 3)


@pytest.mark.parametrize(
    "patch,error",
    [
        ({"price": "0"}, "price_not_positive"),
        ({"price": "-1"}, "price_not_positive"),
        ({"currency": "Eur"}, "currency_invalid"),
        ({"status": "unknown"}, "status_invalid"),
        ({"payment_date": "9999-01-01"}, "payment_date_future"),
        ({"extra_field": "boom"}, "extra_fields"),
    ],
)
def test_drift_rejected(spark, patch, error):
    assert error in _errors(spark, _ok(**patch))


def test_future_date_rejected(spark):
    nxt = (dt.date.fromisoformat(AS_OF) + dt.timedelta(days=366)).isoformat()
    assert _errors(spark, _ok(payment_date=nxt)) == ["payment_date_future"]


@pytest.mark.parametrize(
    "patch,expected",
    [
        ({"price": "1.23000000"}, []),
        ({"price": "1e2"}, []),
        ({"price": " 2.5 "}, []),
        ({"price": "1.23456"}, ["price_too_precise"]),
        ({"price": "1.0000000000000000000000001"}, ["price_too_precise"]),
        ({"price": "1e-5"}, ["price_too_precise"]),
        ({"price": "NaN"}, ["price_invalid"]),
        ({"price": "Infinity"}, ["price_invalid"]),
        ({"price": ""}, ["price_invalid"]),
        ({"price": None}, ["price_invalid"]),
        ({"price": "99999999999999999999"}, ["price_out_of_range"]),
        ({"currency": "EUR\n"}, ["currency_invalid"]),
        ({"payment_date": "2025-1-3"}, ["payment_date_invalid"]),
        ({"payment_date": "20250103"}, ["payment_date_invalid"]),
        ({"payment_date": " 2025-01-03"}, ["payment_date_invalid"]),
        ({"payment_date": "2025-02-30"}, ["payment_date_invalid"]),
        ({"payment_date": "2025-01-03T00:00:00"}, []),
        ({"transaction_id": "x" * 64}, []),
        ({"transaction_id": "x" * 65}, ["transaction_id_too_long"]),
        ({"transaction_id": ""}, ["transaction_id_missing"]),
        ({"game": " "}, []),
        ({"game": "g" * 129}, ["game_too_long"]),
    ],
)
def test_edge_cases(spark, patch, expected):
    assert _errors(spark, _ok(**patch)) == expected


def test_assert_contract_raises(spark):
    raw = spark.createDataFrame([tuple(_ok(price="0").values())], RAW_PAYMENT)
    with pytest.raises(ValueError, match="price_not_positive"):
        contract.assert_contract(raw, AS_OF, raw_line_col=None)


def test_split_balances(spark):
    recs = [_ok(transaction_id=f"t{i}", price=str(i - 3)) for i in range(10)]
    raw = spark.createDataFrame([tuple(r.values()) for r in recs], RAW_PAYMENT)
    good, bad = contract.split_contract(raw, AS_OF, raw_line_col=None)
    assert good.count() + bad.count() == raw.count()
    assert bad.where(F.col("record").isNull()).count() == 0
