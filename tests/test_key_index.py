"""Key index: MERGE and erasure without scanning silver, crashes, rebuilds; the mart and views kept up by changes."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerlake.operators import gold, marts, merge
from ledgerlake.plans import pipeline
from ledgerlake.schemas import SILVER_PAYMENT
from ledgerlake.sources import key_index, publication, tables

FX = "currency_code string, rate_date date, rate_to_eur decimal(10,6)"


def batch_of(draw, n, ids=60):
    out = []
    for _ in range(n):
        key = draw.choice([f"t{draw.randrange(ids)}"] * 9 + [None])
        day = dt.date(2024, 1, 1 + draw.randrange(12))
        out.append(
            (key, draw.choice("abc"), day, Decimal(draw.randrange(1, 900)) / 100, draw.choice(["EUR", "USD", "XXX", None]),
             draw.choice(["success", "error", "pending", None]), dt.datetime(2024, 2, 1, draw.randrange(24), draw.randrange(60)))
        )
    return out


def frame(spark, data):
    return spark.createDataFrame(data, SILVER_PAYMENT)


def merged_by_hand(table, batch):
    """A plain MERGE: the batch's newest row a key; status, price and arrival change, the rest stays."""
    best = {}
    for r in batch:
        if r[0] is not None:
            key = (r[6], r[1], r[2], r[3], r[4] or "", r[5] or "")
            if r[0] not in best or key > best[r[0]][0]:
                best[r[0]] = (key, r)
    out = dict(table)
    for k, (_, r) in best.items():
        if k not in out:
            out[k] = r
            continue
        t = out[k]
        differs = any(None not in (t[i], r[i]) and t[i] != r[i] for i in (3, 5))
        if differs and r[6] >= t[6]:
            out[k] = (*t[:3], r[3], t[4], r[5], r[6])
    return out


@pytest.fixture
def indexed(tmp_path):
    path = str(tmp_path / "silver")
    return path, key_index.index_of(path, n_buckets=8)


def stored(spark, path):
    return {r["transaction_id"]: tuple(r) for r in spark.read.parquet(path).select(*SILVER_PAYMENT.names).collect() if r["transaction_id"]}


def test_merges_and_erasures_equal_a_plain_merge(spark, indexed):
    path, index = indexed
    draw = random.Random(1)
    table, keyless = {}, 0
    for turn in range(5):
        batch = batch_of(draw, 40)
        got = key_index.merge_indexed(spark, path, frame(spark, batch), index, newer_only="ingest_ts")
        before, table = table, merged_by_hand(table, batch)
        keyless += sum(r[0] is None for r in batch)
        assert stored(spark, path) == table
        assert spark.read.parquet(path).where("transaction_id is null").count() == keyless
        changed = {table[k][2] for k in table if table[k] != before.get(k)} | {r[2] for r in batch if r[0] is None}
        assert set(got.touched) == changed  # days in which nothing changes are not written
        if turn == 2:
            gone = spark.createDataFrame([(k,) for k in sorted(table)[::3]] + [("nobody",), (None,)], "transaction_id string")
            fed = key_index.erase_indexed(spark, path, gone, index).feed(spark)
            assert fed.count() == len(sorted(table)[::3]) and {r[0] for r in fed.select("_change_type").distinct().collect()} == {"delete"}
            table = {k: r for i, (k, r) in enumerate(sorted(table.items())) if i % 3}
            assert stored(spark, path) == table
    key_index.compact(spark, index, SILVER_PAYMENT)
    batch = batch_of(draw, 40)
    key_index.merge_indexed(spark, path, frame(spark, batch), index, newer_only="ingest_ts")
    assert stored(spark, path) == merged_by_hand(table, batch)
    empty = key_index.merge_indexed(spark, path, frame(spark, []), index)
    assert empty.touched == [] and empty.feed(spark) is None


def test_probe_reads_the_buckets_of_its_keys_and_no_silver(spark, indexed):
    path, index = indexed
    rows_ = [(f"k{i}", "g", dt.date(2024, 1, 1 + i % 9), Decimal(1), "EUR", "success", dt.datetime(2024, 1, 1)) for i in range(300)]
    key_index.merge_indexed(spark, path, frame(spark, rows_), index)
    keys = spark.createDataFrame([("k7",), ("k8",)], "transaction_id string")
    found = key_index.probe(spark, index, keys, SILVER_PAYMENT)
    assert {(r[0], r[1]) for r in found.collect()} == {("k7", dt.date(2024, 1, 8)), ("k8", dt.date(2024, 1, 9))}
    assert found.inputFiles() and all("/silver_keys/" in f for f in found.inputFiles())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "CartesianProduct" not in plan
    # With silver out of reach, finding the days still works.
    hidden = path + "-moved"
    fs, p = tables.fs_path(spark, path)
    fs.rename(p, tables.fs_path(spark, hidden)[1])
    assert key_index.probe(spark, index, keys, SILVER_PAYMENT).count() == 2
    fs.rename(tables.fs_path(spark, hidden)[1], p)


def test_a_missing_index_is_built_and_a_dead_run_is_repeated(spark, indexed, monkeypatch):
    path, index = indexed
    draw = random.Random(3)
    first, second = batch_of(draw, 30), batch_of(draw, 30)
    first, second = ([r for r in b if r[0]] for b in (first, second))
    key_index.merge_indexed(spark, path, frame(spark, first), index, newer_only="ingest_ts")
    other = key_index.index_of(path, n_buckets=5)  # another number of buckets: another index, built from the table
    table = merged_by_hand({}, first)

    def dies(*_args, **_kwargs):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(key_index, "_apply", dies)  # after the new keys were added, before the table was written
    with pytest.raises(RuntimeError):
        key_index.merge_indexed(spark, path, frame(spark, second), other, newer_only="ingest_ts")
    monkeypatch.undo()
    assert stored(spark, path) == table
    n = key_index.entries(spark, other, SILVER_PAYMENT).count()
    key_index.merge_indexed(spark, path, frame(spark, second), other, newer_only="ingest_ts")
    assert stored(spark, path) == merged_by_hand(table, second)
    assert key_index.entries(spark, other, SILVER_PAYMENT).count() == n  # not added again


def test_merge_changes_equal_the_diff_of_both_versions(spark):
    draw = random.Random(4)
    old = frame(spark, list(merged_by_hand({}, batch_of(draw, 60)).values()))
    batch = merge.dedup_latest(frame(spark, batch_of(draw, 60)))
    new = merge.merge_upsert(old, batch, dedup_source=False, newer_only="ingest_ts")
    feed = merge.merge_changes(old, batch, newer_only="ingest_ts")
    assert rows(feed) == rows(merge.change_feed(old, new).select(*feed.columns))
    assert rows(merge.apply_changes(old, feed)) == rows(new)
    ids = old.select("transaction_id").limit(7)
    assert rows(merge.apply_changes(old, merge.erase_changes(old, ids))) == rows(merge.erase(old, ids))


def test_bloom_filters_are_as_large_as_their_files_need(spark, tmp_path):
    data = spark.range(2000).select(F.col("id").cast("string").alias("transaction_id"), F.lit(dt.date(2024, 1, 1)).alias("payment_date"))

    def size(folder, **options):
        tables.overwrite_partitions(data.coalesce(1), str(tmp_path / folder), **options)
        return sum(f.stat().st_size for f in (tmp_path / folder).rglob("*.parquet"))

    assert size("plain") < size("bloom", bloom_filter_cols=("transaction_id",)) < 2 * size("plain2")


# --- the mart and its views -------------------------------------------------------------------------
def rates(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(80)]
    return spark.createDataFrame([(c, d, Decimal(r) / 100) for d in days for c, r in (("EUR", 100), ("USD", 90 + d.day))], FX)


def test_mart_from_changes_equals_a_rebuild(spark, tmp_path):
    draw = random.Random(6)
    fx = rates(spark)
    path = str(tmp_path / "silver")
    paths = pipeline.MartPaths(*(str(tmp_path / x) for x in ("mart", "state", "journal")))
    for turn in range(4):
        if turn == 3:
            ids = spark.read.parquet(path).select("transaction_id").distinct().limit(30)
            change = key_index.erase_indexed(spark, path, ids)
        else:
            change = key_index.merge_indexed(spark, path, frame(spark, batch_of(draw, 50)))
        feed = change.feed(spark)
        pipeline.refresh_mart(spark, paths, feed, fx, f"f{turn}")
        pipeline.refresh_mart(spark, paths, feed, fx, f"f{turn}")  # a feed counts once
        want = gold.build_agg_game_daily(gold.build_fact(spark.read.parquet(path), fx))
        assert rows(spark.read.parquet(paths.mart).select(*want.columns)) == rows(want)
    state = spark.read.parquet(paths.state)
    assert state.where("n_rows <= 0").count() == 0


def test_a_publication_cut_in_two_is_finished(spark, tmp_path, monkeypatch):
    def part(name, day, v):
        return publication.Publication.of(spark.createDataFrame([(day, v)], "payment_date date, v long"), str(tmp_path / name))

    journal, day, other = str(tmp_path / "journal"), dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    publication.publish(spark, journal, "r1", [part("a", day, 1), part("b", day, 1)], [day], "payment_date")
    seen = []

    def dies(df, path, *args):
        if seen:
            raise RuntimeError("driver lost")
        seen.append(path)
        return replace(df, path, *args)

    replace = tables.replace_days
    monkeypatch.setattr(tables, "replace_days", dies)
    with pytest.raises(RuntimeError):
        publication.publish(spark, journal, "r2", [part("a", other, 2), part("b", other, 2)], [day, other], "payment_date")
    monkeypatch.undo()
    assert not publication.was_published(spark, journal, "r2")
    assert publication.finish(spark, journal) == ["r2"] and publication.finish(spark, journal) == []
    for name in "ab":  # the first day was emptied, the second written, in both
        assert [tuple(r) for r in spark.read.parquet(str(tmp_path / name)).select("payment_date", "v").collect()] == [(other, 2)]


def mart_rows(draw, days, games=("a", "b", "c")):
    return {
        (g, dt.date(2024, 1, 1) + dt.timedelta(days=d)): Decimal(draw.randrange(1, 10**6)) / 100 if draw.random() < 0.9 else None
        for g in games
        for d in range(days)
        if draw.random() < 0.6
    }


def mart_frame(spark, data):
    return spark.createDataFrame([(g, d, v) for (g, d), v in data.items()], "game_key string, payment_date date, gross_revenue_eur decimal(18,4)")


def test_refreshed_views_equal_full_views(spark):
    draw = random.Random(8)
    for _ in range(4):
        old = mart_rows(draw, 400)
        new = dict(old)
        for _ in range(draw.randrange(1, 7)):  # rows change, go and come
            key = draw.choice(sorted(new))
            kind = draw.randrange(3)
            if kind == 0:
                new[key] = Decimal(draw.randrange(10**6))
            elif kind == 1:
                del new[key]
            else:
                new[key[0], dt.date(2024, 1, 1) + dt.timedelta(days=draw.randrange(-5, 420))] = Decimal(5)
        changed = [k for k in old.keys() | new.keys() if old.get(k, -1) != new.get(k, -1)]
        mart, touched = mart_frame(spark, new), spark.createDataFrame(changed, "game_key string, payment_date date")
        views = marts.kpi_views(mart_frame(spark, old))
        got = marts.refresh_kpis(views, mart, touched)
        assert rows(got) == rows(marts.kpi_views(mart).select(*got.columns))
        read = marts.affected_rows(mart, touched).count()
        assert read <= len(changed) * (2 * marts.REACH + 1) and read < len(new)


def test_islands_of_far_changes_are_apart(spark):
    data = {("a", dt.date(2020, 1, 1) + dt.timedelta(days=d)): Decimal(d) for d in range(400)}
    hit = [("a", dt.date(2020, 1, 1) + dt.timedelta(days=d)) for d in (50, 60, 300)]
    got = marts.affected_rows(mart_frame(spark, data), spark.createDataFrame(hit, "game_key string, payment_date date"))
    spans = {r["island"]: (r["n"], r["k"]) for r in got.groupBy("island").agg(F.count("*").alias("n"), F.count_if("affected").alias("k")).collect()}
    assert sorted(spans.values()) == [(28 + 29, 29), (28 + 39, 39)]
    views = marts.kpi_views(mart_frame(spark, data))
    assert {"revenue_7d", "z_score", "severity"} <= set(views.columns)


# --- row-level reconciliation -------------------------------------------------------------------
def test_reconciled_rows_equal_a_comparison_by_hand(spark):
    draw = random.Random(9)
    left = [r for r in merged_by_hand({}, batch_of(draw, 200, 150)).values()]
    right = list(left)
    for i in sorted(draw.sample(range(len(left)), 20), reverse=True):
        row = list(right[i])
        kind = draw.randrange(4)
        if kind == 0:
            del right[i]
        elif kind == 1:
            row[2] = dt.date(2024, 3, 3)  # moved to another day
            right[i] = tuple(row)
        elif kind == 2:
            row[3], row[5] = Decimal("0.01"), None
            right[i] = tuple(row)
        else:
            right.append(right[i])  # twice
    left += [(None, "n", dt.date(2024, 1, 1), Decimal(1), "EUR", "success", None)] * 3
    right += [(None, "n", dt.date(2024, 1, 1), Decimal(1), "EUR", "success", None)] * 2 + [("new", "n", None, None, None, None, None)]
    names = SILVER_PAYMENT.names
    want = set()
    norm = lambda r: tuple(str(x) if not isinstance(x, Decimal) else f"{x:.4f}" for x in r)
    for key in {r[0] or norm(r) for r in left + right}:
        a, b = ([r for r in side if (r[0] or norm(r)) == key] for side in (left, right))
        if sorted(map(norm, a)) != sorted(map(norm, b)):
            kind = "missing" if not b else "extra" if not a else "altered"
            order = ["payment_date", *[c for c in names if c not in ("transaction_id", "payment_date")]]
            parts = [c for c in order if sorted(norm(r)[names.index(c)] for r in a) != sorted(norm(r)[names.index(c)] for r in b)]
            want.add(((a or b)[0][0], kind, len(a), len(b), ",".join(parts) if kind == "altered" else ""))
    a, b = frame(spark, left), frame(spark, right)
    got = {tuple(r) for r in marts.reconcile_rows(a, b, buckets=16).collect()}
    assert got == want and marts.reconcile_rows(a, a).count() == 0
    assert marts.differing_buckets(a, a, ["transaction_id"], ["price"]).count() == 0
    opened = marts.differing_buckets(a, b, ["transaction_id"], names[1:], buckets=16).count()
    assert 0 < opened < a.select("payment_date", F.pmod(F.xxhash64("transaction_id"), F.lit(16))).distinct().count()
