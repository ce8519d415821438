"""Slowly changing dimension, type 2: apply attribute snapshots and look up versions as of a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import row_digest, ts_lit

SK = "game_sk"
FAR_FUTURE = "9999-12-31 00:00:00"


def surrogate_key(key: F.Column, valid_from: F.Column) -> F.Column:
    """Stable 60-bit surrogate key from (business key, version start).

    Computed row by row on the executors, so assigning keys never needs a global ordering
    (an identity counter would funnel all new versions through one task).
    """
    return row_digest([key, valid_from])


def scd2_apply(
    dim: DataFrame,
    updates: DataFrame,
    as_of,
    key: str = "game_key",
    tracked: Sequence[str] = ("game_name", "genre", "studio"),
    sk: str = SK,
) -> DataFrame:
    """New dimension after applying an attribute snapshot ``updates`` at ``as_of``.

    * key current and any tracked attribute differs (NULL-safe): the current row is closed
      (``valid_to = as_of``, ``is_current = false``) and a new current version is added;
    * key unknown: a first version is added;
    * key absent from ``updates`` or unchanged: nothing changes; history rows pass through.

    One full-outer join of current rows with the snapshot; each joined row emits 0-2 rows.
    """
    tracked = list(tracked)
    at = ts_lit(as_of)
    cur = dim.where(F.col("is_current")).alias("c")
    hist = dim.where(~F.col("is_current") | F.col("is_current").isNull())
    upd = updates.select(key, *tracked).withColumn("_ll_u", F.lit(True)).alias("u")
    j = cur.withColumn("_ll_c", F.lit(True)).alias("c").join(upd, F.col(f"c.{key}") == F.col(f"u.{key}"), "full_outer")
    in_c = F.col("c._ll_c").isNotNull()
    in_u = F.col("u._ll_u").isNotNull()
    diff = F.lit(False)
    for c in tracked:
        diff = diff | ~F.col(f"c.{c}").eqNullSafe(F.col(f"u.{c}"))
    changed = in_c & in_u & diff

    def row(src: str, valid_from, valid_to, current: bool, sk_col) -> F.Column:
        return F.struct(
            sk_col.alias(sk),
            F.col(f"{src}.{key}").alias(key),
            *[F.col(f"{src}.{c}").alias(c) for c in tracked],
            valid_from.alias("valid_from"),
            valid_to.alias("valid_to"),
            F.lit(current).alias("is_current"),
        )

    keep = row("c", F.col("c.valid_from"), F.col("c.valid_to"), True, F.col(f"c.{sk}"))
    closed = row("c", F.col("c.valid_from"), at, False, F.col(f"c.{sk}"))
    fresh = row("u", at, F.lit(None).cast("timestamp_ntz"), True, surrogate_key(F.col(f"u.{key}"), at))
    out = (
        F.when(changed, F.array(closed, fresh))
        .when(in_c, F.array(keep))
        .otherwise(F.array(fresh))
    )
    applied = j.select(F.explode(out).alias("r")).select("r.*")
    return applied.unionByName(hist.select(*applied.columns))


# --- changes in any order of time --------------------------------------------------------------------
def scd2_timeline(dim: DataFrame, key: str = "game_key", tracked: Sequence[str] = ("game_name", "genre", "studio")) -> DataFrame:
    """The dimension as points in time: from ``at`` on, a key has these attributes, or none (``open`` is false).

    Each version gives its start, and its end where no other version starts there. ``recorded_at`` is
    null: any later statement about the same time wins.
    """
    recorded = F.lit(None).cast("timestamp_ntz").alias("recorded_at")
    starts = dim.select(key, F.col("valid_from").alias("at"), F.lit(True).alias("open"), *tracked, recorded)
    nothing = [F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in tracked]
    ends = dim.where(F.col("valid_to").isNotNull()).select(key, F.col("valid_to").alias("at"), F.lit(False).alias("open"), *nothing, recorded)
    return _latest(starts.unionByName(ends), key, tracked)


def _latest(points: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """One point for each key and time: the last recorded, before any end; ties by the attributes."""
    rank = F.struct(F.col("recorded_at"), F.col("open"), *[F.col(c) for c in tracked])
    kept = points.where(F.col(key).isNotNull() & F.col("at").isNotNull()).groupBy(key, "at").agg(F.max(rank).alias("r"))
    return kept.select(key, "at", "r.open", *[F.col(f"r.{c}").alias(c) for c in tracked], "r.recorded_at")


def scd2_record(timeline: DataFrame, updates: DataFrame, key: str = "game_key", tracked: Sequence[str] = ("game_name", "genre", "studio")) -> DataFrame:
    """The timeline after ``updates`` (``key, at, recorded_at, tracked...``), in whatever order of time they come.

    An update holds from its time until the key's next point, so a back-dated one splits the version
    it falls into. Of several for one time the last recorded wins, so batches may be
    applied in any order, or twice. An update without a time or a key says nothing.
    """
    rows = updates.select(key, F.col("at").cast("timestamp_ntz").alias("at"), F.lit(True).alias("open"), *tracked, "recorded_at")
    return _latest(timeline.unionByName(rows), key, tracked)


def scd2_of_timeline(timeline: DataFrame, key: str = "game_key", tracked: Sequence[str] = ("game_name", "genre", "studio"), sk: str = SK) -> DataFrame:
    """The dimension of a timeline: one version for each run of points with the same attributes.

    Points stay in the timeline even where they change nothing, so a later back-dated update between
    two equal ones still ends at the second.
    """
    w = Window.partitionBy(key).orderBy("at")
    state = F.struct("open", *tracked)
    same = state.eqNullSafe(F.lag(state).over(w))
    # Only points at which something changes bound a version.
    points = timeline.withColumn("_ll_same", F.coalesce(same, F.lit(False))).where(~F.col("_ll_same"))
    versions = points.withColumn("valid_to", F.lead("at").over(w)).where("open")
    return versions.select(
        surrogate_key(F.col(key), F.col("at")).alias(sk),
        key,
        *tracked,
        F.col("at").alias("valid_from"),
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def scd2_backdated(dim: DataFrame, updates: DataFrame, key: str = "game_key", tracked: Sequence[str] = ("game_name", "genre", "studio")) -> DataFrame:
    """The dimension after updates of any times (``scd2_timeline``, ``scd2_record``, ``scd2_of_timeline``)."""
    return scd2_of_timeline(scd2_record(scd2_timeline(dim, key, tracked), updates, key, tracked), key, tracked)


def scd2_asof(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str = "game_key",
    fact_time: str = "payment_date",
    key: str = "game_key",
    attrs: Sequence[str] = (SK, "genre"),
) -> DataFrame:
    """Attach the dimension version valid at each fact's time (``valid_from <= t < valid_to``).

    Equi-join on the key plus a range condition. Adaptive execution broadcasts the dimension
    when its measured bytes allow; else it is a shuffle join whose skewed partitions it splits.
    """
    d = dim.select(
        F.col(key).alias("_ll_k"),
        F.col("valid_from").alias("_ll_from"),
        F.coalesce(F.col("valid_to"), ts_lit(FAR_FUTURE)).alias("_ll_to"),
        *[F.col(a) for a in attrs],
    )
    t = F.col(fact_time).cast("timestamp_ntz")
    cond = (F.col(fact_key) == F.col("_ll_k")) & (F.col("_ll_from") <= t) & (t < F.col("_ll_to"))
    return fact.join(d, cond, "left").drop("_ll_k", "_ll_from", "_ll_to")
