"""Two-level buckets: rows of a hot key go to many buckets, without giving up
joins in place.

Tables to be joined on a key are bucketed on ``(key, _slot)``.  Ordinary keys
have the one slot 0.  A key that holds more than its share of the big table's
rows has several: its rows are dealt over them, and the other tables (which
hold few rows of a key) repeat theirs once in each.  Every pair of matching
rows then meets exactly once, in the slot of the big table's row, and the hot
key's rows are read by as many tasks as it has slots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.plans.joins import join_small

SLOT = "_slot"
_SLOTS = "_slots"


def hot_keys(df: DataFrame, key: str, n_buckets: int, factor: float = 2.0) -> DataFrame:
    """``key`` and ``_slots`` of every key with more than ``factor`` times the rows
    of an even bucket: fewer than ``n_buckets / factor`` keys.  One aggregate,
    combined map-side."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    even = max(1.0, total / n_buckets)
    return counts.where(F.col("_n") > factor * even).select(key, F.ceil(F.col("_n") / F.lit(even)).cast("int").alias(_SLOTS))


def spread(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """``df`` with the slot of every row: hot keys' rows dealt out in turn."""
    slots = join_small(df, hot, key, "left")
    turn = F.pmod(F.monotonically_increasing_id(), F.col(_SLOTS).cast("bigint")).cast("int")
    return slots.withColumn(SLOT, F.coalesce(turn, F.lit(0))).drop(_SLOTS)


def repeat(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """``df`` with every row once in each slot of its key."""
    slots = join_small(df, hot, key, "left")
    return slots.withColumn(SLOT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SLOTS), F.lit(1)) - 1))).drop(_SLOTS)
