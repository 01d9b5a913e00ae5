"""Connected components of an edge table by alternating large-star and
small-star rounds, each written to the shared folder (no lineage grows, a lost
executor re-reads files).  A node's component is the smallest node it reaches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges (u, v), v the smaller node."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    met = both.join(low, F.col("u") == F.col("k"))
    if large:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select(F.col("k").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) of every node with an edge."""
    now = materialize(
        edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v").distinct(), "edges"
    )
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = mark(now)
    while before[0]:
        now = materialize(_star(_star(now, True), False), "edges")
        after = mark(now)
        if after == before:
            break
        before = after
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
