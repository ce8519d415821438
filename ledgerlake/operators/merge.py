"""Keyed upsert (MERGE semantics), change feed, dedup and erasure as DataFrame operators.

Design notes for scale:

* Dedup is a grouped ``max(struct(order..., rest...))``: an aggregate, so Spark combines
  map-side and a key with millions of copies is reduced in every map task before the shuffle
  (a ``row_number`` window would drag the whole hot group into one task).
* Rows with a NULL key can never match. They go through the same join and aggregation as the
  others, under a second key (``_spread``) that deals them over all reducers, so every input is
  read once.
* The upsert itself is one full-outer join; the Parquet sink restricts the target to the
  partitions the batch touches, so a daily batch rewrites days, not the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_KEYS = ("transaction_id",)
DEFAULT_UPDATE_COLS = ("status", "price", "ingest_ts")
DEFAULT_COMPARE_COLS = ("status", "price")
CHANGE_TYPES = ("insert", "delete", "update_preimage", "update_postimage")


def _any_null(keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


_SPREAD = "_ll_spread"


def _spread(cols: Sequence[str], keys: Sequence[str]) -> Column:
    """0 for a row with all its keys, else a number from its hash: NULL keys meet in no one reducer."""
    return F.when(_any_null(keys), F.pmod(F.xxhash64(*cols), F.lit(1 << 20)) + 1).otherwise(0)


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    order_by: Sequence[str] = ("ingest_ts",),
    latest: bool = True,
) -> DataFrame:
    """One row per key: the greatest (``latest=True``) by ``order_by``, ties by the other columns.

    Deterministic superset of ``dropDuplicates(keys)``. Rows with a NULL key are not
    identifiable: all of them are kept. Equal ones are counted within their scan task and
    written out again that many times, which costs no second read of the input.
    """
    keys, order_by = list(keys), list(order_by)
    cols = list(df.columns)
    rest = [c for c in cols if c not in keys and c not in order_by]
    packed = F.struct(*[F.col(c) for c in order_by + rest])
    no_key = _any_null(keys)
    rows = df.select(
        *keys,
        packed.alias("_ll_row"),
        F.when(no_key, packed).alias("_ll_own"),
        F.when(no_key, F.spark_partition_id()).otherwise(-1).alias("_ll_task"),
    )
    pick = F.max("_ll_row") if latest else F.min("_ll_row")
    agg = rows.groupBy(*keys, "_ll_own", "_ll_task").agg(pick.alias("_ll_row"), F.count(F.lit(1)).alias("_ll_n"))
    copies = F.when(no_key, F.col("_ll_n")).otherwise(F.lit(1)).cast("int")
    agg = agg.withColumn("_ll_copy", F.explode(F.sequence(F.lit(1), copies)))
    return agg.select(*keys, *[F.col(f"_ll_row.{c}").alias(c) for c in order_by + rest]).select(*cols)


def assert_unique_keys(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> None:
    """Raise if a key occurs twice (MERGE has no defined winner for duplicate source keys)."""
    dup = df.where(~_any_null(keys)).groupBy(*keys).count().where(F.col("count") > 1)
    if not dup.isEmpty():
        raise ValueError(f"duplicate keys in merge source on {list(keys)}")


def _changed(cols: Sequence[str], null_safe: bool) -> Column:
    cond = F.lit(False)
    for c in cols:
        t, s = F.col(f"_t.{c}"), F.col(f"_s.{c}")
        cond = cond | (~t.eqNullSafe(s) if null_safe else (t != s))
    return F.coalesce(cond, F.lit(False))


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    *,
    update_cols: Sequence[str] = DEFAULT_UPDATE_COLS,
    compare_cols: Sequence[str] = DEFAULT_COMPARE_COLS,
    null_safe: bool = False,
    dedup_source: bool = True,
    source_order: Sequence[str] = ("ingest_ts",),
    newer_only: str | None = None,
    with_action: bool = False,
) -> DataFrame:
    """New target after ``MERGE INTO target USING source ON keys``.

    * matched and any ``compare_cols`` differ -> ``update_cols`` take the source value; all
      other columns (e.g. ``payment_date``) keep the target value;
    * matched otherwise -> unchanged (so re-running the same batch is a no-op);
    * not matched -> the source row is inserted (a NULL-key source row is always inserted).

    With the default ``null_safe=False`` a NULL on either side of a compare column counts as
    "no change", as in SQL ``<>``. ``newer_only`` names an arrival-time column: a matched row
    is then only updated by a source row that is not older, so out-of-order delivery (e.g.
    stream micro-batches) converges to the same table. ``with_action`` adds
    ``_merge_action`` (``update``, ``insert``, ``none``).
    """
    keys = list(keys)
    cols = list(target.columns)
    source = source.select(*cols)
    if dedup_source:
        source = dedup_latest(source, keys, source_order)
    else:
        assert_unique_keys(source, keys)
    j = _full_join(target, source, keys)
    in_t = F.col("_t._ll_t").isNotNull()
    in_s = F.col("_s._ll_s").isNotNull()
    upd = in_t & in_s & _changed(compare_cols, null_safe)
    if newer_only:
        upd = upd & F.coalesce(F.col(f"_s.{newer_only}") >= F.col(f"_t.{newer_only}"), F.lit(True))

    out = []
    for c in cols:
        tc, sc = F.col(f"_t.{c}"), F.col(f"_s.{c}")
        if c in keys:
            out.append(F.when(in_t, tc).otherwise(sc).alias(c))
        elif c in update_cols:
            out.append(F.when(upd, sc).when(in_t, tc).otherwise(sc).alias(c))
        else:
            out.append(F.when(in_t, tc).otherwise(sc).alias(c))
    if with_action:
        out.append(F.when(upd, "update").when(in_t, "none").otherwise("insert").alias("_merge_action"))
    return j.select(*out)


def _full_join(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of ``_t`` and ``_s`` on the keys; rows with a NULL key stay unmatched.

    Equality never holds for a NULL key, and the spread of such a row differs from 0, so the
    join keeps it as a row of its own side while dealing it by its hash.
    """
    t = target.withColumn(_SPREAD, _spread(target.columns, keys)).withColumn("_ll_t", F.lit(True)).alias("_t")
    s = source.withColumn(_SPREAD, _spread(source.columns, keys)).withColumn("_ll_s", F.lit(True)).alias("_s")
    cond = F.col(f"_t.{_SPREAD}") == F.col(f"_s.{_SPREAD}")
    for k in keys:
        cond = cond & (F.col(f"_t.{k}") == F.col(f"_s.{k}"))
    return t.join(s, cond, "full_outer")


def merge_changes(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    *,
    update_cols: Sequence[str] = DEFAULT_UPDATE_COLS,
    compare_cols: Sequence[str] = DEFAULT_COMPARE_COLS,
    null_safe: bool = False,
    newer_only: str | None = None,
) -> DataFrame:
    """The change feed that ``merge_upsert`` of a source with one row a key would cause.

    One left join from the source's side: what it emits has the size of the source, however
    large the target is, and no two versions of the target are compared. An update gives its pre- and
    its postimage, a source row without a target row (or with a NULL key) an ``insert``.
    """
    keys, cols = list(keys), list(target.columns)
    t = target.where(~_any_null(keys)).withColumn("_ll_t", F.lit(True)).alias("_t")
    s = source.select(*cols, _spread(cols, keys).alias(_SPREAD)).alias("_s")
    # A NULL key matches nothing; its spread deals such rows over all reducers.
    cond = F.col(f"_s.{_SPREAD}") == F.lit(0)
    for k in keys:
        cond = cond & (F.col(f"_t.{k}") == F.col(f"_s.{k}"))
    j = s.join(t, cond, "left")
    known = F.col("_t._ll_t").isNotNull()
    update = _changed(compare_cols, null_safe)
    if newer_only:
        update = update & F.coalesce(F.col(f"_s.{newer_only}") >= F.col(f"_t.{newer_only}"), F.lit(True))

    def row(kind: str, source_cols: Sequence[str]) -> Column:
        return F.struct(*[F.col(f"{'_s' if c in source_cols else '_t'}.{c}").alias(c) for c in cols], F.lit(kind).alias("_change_type"))

    images = F.array(row("update_preimage", ()), row("update_postimage", [c for c in update_cols if c not in keys]))
    changes = F.when(~known, F.array(row("insert", cols))).when(update, images)
    return j.select(F.explode(changes).alias("_c")).select("_c.*")


def erase_changes(target: DataFrame, ids: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """The change feed of ``erase``: a ``delete`` for every row whose key is in ``ids``."""
    keys = list(keys)
    wanted = ids.select(*keys).where(~_any_null(keys)).distinct()
    return target.join(wanted, keys, "left_semi").select(*target.columns, F.lit("delete").alias("_change_type"))


def apply_changes(target: DataFrame, feed: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """``target`` after a feed of changes to unique keys: rows of a preimage or a delete go, postimages and inserts come."""
    keys, cols = list(keys), list(target.columns)
    gone = feed.where(F.col("_change_type").isin("update_preimage", "delete")).select(*keys)
    come = feed.where(F.col("_change_type").isin("update_postimage", "insert")).select(*cols)
    return target.join(gone, keys, "left_anti").unionByName(come)


def change_feed(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    compare_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Row-level changes from ``old`` to ``new`` with ``_change_type``.

    One full-outer join and one pass: each joined row emits an array of 0, 1 or 2 change rows
    that is exploded in place (no re-scan per change type). Values are compared null-safely.
    NULL-key rows cannot be paired, so old ones are reported as deletes and new ones as
    inserts; replaying the feed on ``old`` still yields ``new``.
    """
    keys = list(keys)
    cols = list(old.columns)
    compare = list(compare_cols) if compare_cols is not None else [c for c in cols if c not in keys]
    j = _full_join(old, new.select(*cols), keys)
    in_t = F.col("_t._ll_t").isNotNull()
    in_s = F.col("_s._ll_s").isNotNull()
    changed = _changed(compare, null_safe=True)

    def side(prefix: str, kind: str) -> Column:
        return F.struct(*[F.col(f"{prefix}.{c}").alias(c) for c in cols], F.lit(kind).alias("_change_type"))

    # No ``otherwise``: an unchanged row yields NULL, which explodes to nothing.
    changes = (
        F.when(in_t & in_s & changed, F.array(side("_t", "update_preimage"), side("_s", "update_postimage")))
        .when(in_t & ~in_s, F.array(side("_t", "delete")))
        .when(~in_t & in_s, F.array(side("_s", "insert")))
    )
    return j.select(F.explode(changes).alias("_c")).select("_c.*")


def apply_change_feed(old: DataFrame, feed: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """Replay a change feed on ``old`` (inverse of ``change_feed``; used by property tests)."""
    keys = list(keys)
    cols = list(old.columns)
    removed = feed.where(F.col("_change_type").isin("delete", "update_preimage")).select(*cols)
    added = feed.where(F.col("_change_type").isin("insert", "update_postimage")).select(*cols)
    kept = old.exceptAll(removed)
    return kept.unionByName(added)


def erase(
    df: DataFrame,
    ids: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
) -> DataFrame:
    """Remove every row whose key is in ``ids`` (right-to-erasure).

    No hint: the ids grow with the data, so adaptive execution decides by their measured bytes.
    """
    keys = list(keys)
    req = ids.select(*keys).where(~_any_null(keys)).distinct()
    return df.join(req, keys, "left_anti")
