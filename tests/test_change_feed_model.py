"""Brute-force check of change_feed against a Python diff of two keyed tables."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlake.operators import merge as mg

SCHEMA = "transaction_id string, status string, price int"
ROWS = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", "d", None]), st.sampled_from(["s", "e", None]), st.sampled_from([1, 2, None])),
    max_size=6,
).map(lambda rs: list({r[0]: r for r in rs if r[0] is not None}.values()) + [r for r in rs if r[0] is None][:2])


def model(old, new):
    o = {r[0]: r for r in old if r[0] is not None}
    n = {r[0]: r for r in new if r[0] is not None}
    out = []
    for k, r in o.items():
        if k not in n:
            out.append(r + ("delete",))
        elif r != n[k]:
            out += [r + ("update_preimage",), n[k] + ("update_postimage",)]
    out += [r + ("insert",) for k, r in n.items() if k not in o]
    out += [r + ("delete",) for r in old if r[0] is None] + [r + ("insert",) for r in new if r[0] is None]
    return sorted(out, key=repr)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS, ROWS)
def test_change_feed_matches_model(spark, old, new):
    o = spark.createDataFrame(old, SCHEMA)
    n = spark.createDataFrame(new, SCHEMA)
    got = sorted((tuple(r) for r in mg.change_feed(o, n).collect()), key=repr)
    assert got == model(old, new)
