"""Surrogate ids: dense numbers for natural keys that never change again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.keys import require_keys
from tallyfold.plans.joins import join_small
from tallyfold.session import cut_lineage


def dense_ids(df: DataFrame, order: Sequence[str], start: int = 1, id_col: str = "id", n_partitions: int | None = None) -> DataFrame:
    """``df`` with ids ``start, start + 1, ...`` in the order of ``order`` (a total
    order makes them the same on every run).  Two passes: rows are dealt out by
    ranges and counted per partition, and every row's id is its partition's
    offset plus its place there.  No global sort in one task."""
    n = n_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # Pinned: both passes must see the same partitions.
    placed = cut_lineage(ranged.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")))
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    # One row a partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", "_first", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + F.lit(start)).alias("_offset"))
    ids = join_small(placed, offsets, "_part")
    return ids.select(*df.columns, (F.col("_offset") + F.col("_at") - F.col("_first")).alias(id_col))


def assign_ids(rows: DataFrame, known: DataFrame | None, keys: Sequence[str], id_col: str = "id", n_partitions: int | None = None) -> DataFrame:
    """The id table (``keys``, ``id_col``) after ``rows``: keys in ``known`` keep
    their id, new ones get the next ids in key order, without a gap.  Rerunning
    with the same rows changes nothing; repeated rows count once; a NULL key is
    refused.  Join the result to ``rows`` to number them."""
    keys = list(keys)
    new = require_keys(rows, keys, "rows to number").select(*keys).distinct()
    if known is None:
        return dense_ids(new, keys, 1, id_col, n_partitions)
    known = known.select(*keys, id_col)
    last = known.agg(F.max(id_col)).first()[0] or 0
    fresh = new.join(known, keys, "left_anti")
    return known.unionByName(dense_ids(fresh, keys, last + 1, id_col, n_partitions))
