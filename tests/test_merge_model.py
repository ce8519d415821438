"""Brute-force check of merge_upsert / dedup_latest against a plain Python MERGE model."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlake.operators import merge as mg
from ledgerlake.schemas import SILVER_PAYMENT

KEYS = st.sampled_from(["a", "b", "c", "d", "e", None])
STATUS = st.sampled_from(["success", "error", "pending", None])
PRICE = st.sampled_from([Decimal("1.0000"), Decimal("2.5000"), None])
DAY = st.sampled_from([dt.date(2025, 1, 1), dt.date(2025, 1, 2)])
TS = st.sampled_from([dt.datetime(2025, 1, d) for d in (1, 2, 3)])
ROW = st.tuples(KEYS, st.just("g"), DAY, PRICE, st.just("EUR"), STATUS, TS)


def latest(rows):
    """dedup_latest: per non-NULL key the max by (ingest_ts, rest...) with NULLs smallest."""
    def sort_key(r):
        order = (r[6], r[1], r[2], r[3], r[4], r[5])
        return tuple((v is not None, v if v is not None else 0) for v in order)

    best = {}
    for r in rows:
        if r[0] is None:
            continue
        if r[0] not in best or sort_key(r) > sort_key(best[r[0]]):
            best[r[0]] = r
    return list(best.values()) + [r for r in rows if r[0] is None]


def merge_model(target, source, newer_only=False):
    src = latest(source)
    by_key = {r[0]: r for r in src if r[0] is not None}
    out = []
    for t in target:
        s = by_key.pop(t[0], None) if t[0] is not None else None
        if s is None:
            out.append(t)
            continue
        differs = (t[5] is not None and s[5] is not None and t[5] != s[5]) or (
            t[3] is not None and s[3] is not None and t[3] != s[3]
        )
        if newer_only and not s[6] >= t[6]:
            differs = False
        out.append((t[0], t[1], t[2], s[3], t[4], s[5], s[6]) if differs else t)
    out.extend(by_key.values())
    out.extend(r for r in src if r[0] is None)
    return sorted(out, key=repr)


unique_target = st.lists(ROW, max_size=8).map(lambda rs: list({r[0]: r for r in rs if r[0] is not None}.values()))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(unique_target, st.lists(ROW, max_size=10), st.booleans())
def test_merge_matches_model(spark, target, source, newer_only):
    t = spark.createDataFrame(target, SILVER_PAYMENT)
    s = spark.createDataFrame(source, SILVER_PAYMENT)
    got = sorted((tuple(r) for r in mg.merge_upsert(t, s, newer_only="ingest_ts" if newer_only else None).collect()), key=repr)
    assert got == merge_model(target, source, newer_only)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, max_size=15))
def test_dedup_matches_model(spark, rows_):
    df = spark.createDataFrame(rows_, SILVER_PAYMENT)
    got = sorted((tuple(r) for r in mg.dedup_latest(df).collect()), key=repr)
    assert got == sorted(latest(rows_), key=repr)
