"""Join helpers: salted skew join, orphan (anti) joins."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than this share of the rows, so there are fewer than 1 / share.
HOT_SHARE = 0.005
#: Salts of fact rows with a NULL key, which need no copies on the other side.
NULL_SALTS = 1 << 20


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """The keys that hold more than ``share`` of all rows: fewer than ``1 / share`` of them.

    One aggregation (pre-reduced on the map side) and a scalar subquery for the total.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_ll_n"))
    total = df.agg(F.count(F.lit(1)).cast("double").alias("_ll_total")).scalar()
    return counts.where(F.col("_ll_n") > F.lit(share) * total).select(key)


def _hot_hashes(df: DataFrame, key: str, share: float) -> Column:
    """Hashes of the keys above ``share`` of the rows: fewer than ``1 / share``.

    One pass without a shuffle of the keys: a frequent-items sketch a task, merged. What it over-
    or underestimates only changes which keys are dealt over several reducers.
    """
    k = math.ceil(1 / share)
    top = F.expr(f"approx_top_k(_ll_h, {k}, {max(4096, 16 * k)})")
    hot = df.select(F.xxhash64(key).alias("_ll_h")).agg(top.alias("top"), F.count(F.lit(1)).alias("n"))
    above = F.filter("top", lambda x: x["count"] > F.lit(share) * F.col("n"))
    return hot.select(F.transform(above, lambda x: x["item"]).alias("hot")).scalar()


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    n_salt: int = 16,
    how: str = "left",
    salt_cols: Sequence[str] | None = None,
    share: float = HOT_SHARE,
) -> DataFrame:
    """A shuffle join in which every hot key of ``fact`` is dealt over ``n_salt`` reducers.

    The result equals ``fact.join(dim, key, how)`` as a multiset. A fact row with a hot key gets
    a salt from the hash of ``salt_cols`` (default: all columns), which a retried task repeats;
    only the hot keys' dim rows are copied, once for each salt. Other keys join as they are. Fact
    rows with a NULL key match nothing, so they are dealt over all reducers without any copies.
    The hot keys are one value of the plan (fewer than ``1 / share`` hashes, found once for both sides); no
    side is broadcast.
    """
    if how not in ("left", "inner"):
        raise ValueError("salted_join supports left and inner joins")
    salt, hot = "_ll_salt", _hot_hashes(fact, key, share)
    is_hot = F.coalesce(F.array_contains(hot, F.xxhash64(key)), F.lit(False))
    row = F.xxhash64(*(salt_cols or fact.columns))
    dealt = F.when(F.col(key).isNull(), F.pmod(row, F.lit(NULL_SALTS))).when(is_hot, F.pmod(row, F.lit(n_salt))).otherwise(F.lit(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(n_salt - 1))).otherwise(F.array(F.lit(0)))
    dim_s = dim.withColumn(salt, F.explode(copies))
    return fact.withColumn(salt, dealt.cast("int")).join(dim_s.hint("merge"), [key, salt], how).drop(salt)


def current_rows(dim: DataFrame) -> DataFrame:
    """SCD2 dims contribute only their current version to integrity checks."""
    return dim.filter(F.col("is_current")) if "is_current" in dim.columns else dim


def orphans(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str,
) -> DataFrame:
    """Fact rows whose ``key`` has no current row in ``dim`` (NULL keys are orphans)."""
    cur = current_rows(dim).select(F.col(dim_key).alias("_ll_dim_key")).distinct()
    return fact.join(cur, fact[key] == cur["_ll_dim_key"], "left_anti")
