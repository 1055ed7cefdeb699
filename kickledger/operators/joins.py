"""Joins against dimension tables (clubs, players, competitions).

They are joined plainly: the planner broadcasts a dimension where its
statistics, or the sizes AQE measures, stay below
``spark.sql.autoBroadcastJoinThreshold``. Otherwise it is a shuffle join, and
AQE splits a skewed partition (one key with a third of all rows) into several
tasks. Where AQE is off, or on request, the rows of hot keys are joined apart
(``split_join``): hot keys are found by one pass of a frequent-items sketch,
which tasks merge, and are few by construction.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickledger.session import materialize

HOT_SHARE = 0.01          # a key of this share of all rows is hot, so there are at most a hundred
TRACKED_KEYS = 10_000     # of the sketch: counts are right to well below a thousandth of all rows
HOT_DIMENSION_ROWS = 100_000


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner", skew: str = "auto") -> DataFrame:
    """Join a large fact table to a dimension.

    ``dim`` should already be projected to the columns the join needs. A hot
    key of a shuffle join is handled by AQE's skew-join split
    (``skew="aqe"``; no job runs while the frame is built) or by
    ``split_join`` (``skew="split"``, which looks for hot keys at once);
    ``"auto"`` splits only when AQE is off in the session.
    """
    if skew == "auto":
        aqe = fact.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
        skew = "aqe" if aqe else "split"
    if skew == "split" and isinstance(on, str) and how in ("inner", "left"):
        return split_join(fact, dim, on, how)
    return fact.join(dim, on, how)


def hot_keys(fact: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold at least ``share`` of all rows, stored: no sample, one pass over the key column.

    The sketch's counts are off by a few rows in ``TRACKED_KEYS``, far less
    than the share asks for, so no hot key is missed; a key just below it may
    be among them, which changes no result. At most ``1 / share`` keys.
    """
    most = max(1, math.ceil(1 / share))
    rows = fact.where(F.col(key).isNotNull())
    found = rows.agg(F.expr(f"approx_top_k(`{key}`, {most}, {TRACKED_KEYS})").alias("top"), F.count("*").alias("n"))
    items = found.select(F.explode("top").alias("item"), "n")
    return materialize(items.where(F.col("item.count") >= F.lit(share) * F.col("n"))
                       .select(F.col("item.item").alias(key)), "hot-keys")


def split_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner", buckets: int = 16,
               hot: DataFrame | None = None, max_hot_rows: int = HOT_DIMENSION_ROWS) -> DataFrame:
    """Join in which the fact rows of hot keys don't meet in one task; results equal a plain join.

    A hot key's dimension rows, if there are no more than ``max_hot_rows``
    (counted), are broadcast, and its fact rows stay in the tasks they are
    in. Beyond that its fact rows are stored with a number each and spread
    by it over ``buckets`` tasks, to which its dimension rows are copied:
    the number tells alike rows apart, and being stored it is the same for a
    task that runs again. All other rows meet in a shuffle join.
    """
    hot = hot_keys(fact, key) if hot is None else hot
    keys = F.broadcast(hot.select(key))                      # at most 1 / share rows
    hot_dim = materialize(dim.join(keys, key, "left_semi"), "hot-dimension")
    hot_fact = fact.join(keys, key, "left_semi")
    rest = fact.join(keys, key, "left_anti").join(dim, key, how)
    if hot_dim.count() <= max_hot_rows:
        met = hot_fact.join(F.broadcast(hot_dim), key, how)
    else:
        stored = materialize(hot_fact.withColumn("_row", F.monotonically_increasing_id()), "hot-rows")
        salted = stored.withColumn("_salt", F.pmod(F.col("_row"), F.lit(buckets)).cast("int")).drop("_row")
        copies = hot_dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
        met = salted.join(copies, [key, "_salt"], how).drop("_salt")
    return rest.unionByName(met)


def keep_members(df: DataFrame, members: DataFrame, on, bounded: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is in ``members`` (a semi join: no row multiplies).

    ``bounded=True`` states that ``members`` has a known small size (a top-N
    list), so it is broadcast without a check.
    """
    return df.join(F.broadcast(members) if bounded else members, on, "left_semi")


def drop_members(df: DataFrame, members: DataFrame, on, bounded: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is not in ``members`` (an anti join; unlike
    ``NOT IN`` a NULL member does not empty the result)."""
    return df.join(F.broadcast(members) if bounded else members, on, "left_anti")
