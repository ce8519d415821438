"""Brute-force check of scd2_apply against a plain Python SCD2 model."""

import datetime as dt
import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlake.operators import scd2
from ledgerlake.schemas import DIM_GAME

AS_OF = dt.datetime(2025, 1, 1)
FROM = dt.datetime(2020, 1, 1)
KEYS = ["a", "b", "c", "d"]
ATTR = st.sampled_from(["x", "y", None])


def sk(key, ts):
    text = f"{key}|{ts:%Y-%m-%d %H:%M:%S}"
    return int(hashlib.sha256(text.encode()).hexdigest()[:15], 16)


def model(dim, updates):
    out = [r for r in dim if not r[7]]
    upd = {u[0]: u for u in updates}
    seen = set()
    for r in (r for r in dim if r[7]):
        seen.add(r[1])
        u = upd.get(r[1])
        if u is not None and (r[2], r[3], r[4]) != (u[1], u[2], u[3]):
            out.append(r[:6] + (AS_OF, False))
            out.append((sk(u[0], AS_OF), u[0], u[1], u[2], u[3], AS_OF, None, True))
        else:
            out.append(r)
    for key, u in upd.items():
        if key not in seen:
            out.append((sk(key, AS_OF), key, u[1], u[2], u[3], AS_OF, None, True))
    return sorted(out, key=repr)


current = st.lists(st.tuples(st.sampled_from(KEYS), ATTR, ATTR, ATTR), max_size=4).map(
    lambda rs: [(sk(k, FROM), k, n, g, s, FROM, None, True) for k, n, g, s in {r[0]: r for r in rs}.values()]
)
history = st.lists(st.tuples(st.sampled_from(KEYS), ATTR), max_size=2).map(
    lambda rs: [(i, k, "old", g, None, dt.datetime(2010, 1, 1), FROM, False) for i, (k, g) in enumerate(rs)]
)
snapshot = st.lists(st.tuples(st.sampled_from(KEYS + ["e"]), ATTR, ATTR, ATTR), max_size=5).map(
    lambda rs: list({r[0]: r for r in rs}.values())
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(current, history, snapshot)
def test_scd2_apply_matches_model(spark, cur, hist, upd):
    dim = spark.createDataFrame(cur + hist, DIM_GAME)
    updates = spark.createDataFrame(upd, "game_key string, game_name string, genre string, studio string")
    got = sorted((tuple(r) for r in scd2.scd2_apply(dim, updates, AS_OF).collect()), key=repr)
    assert got == model(cur + hist, upd)
