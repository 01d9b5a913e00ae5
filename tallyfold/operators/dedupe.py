"""O6 ``dedupe`` and O7 ``dedupe_counted``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OrderSpec = Sequence[str | Column]


def _order_columns(df: DataFrame, keys: Sequence[str], order: OrderSpec | None) -> list[Column]:
    if order is None:
        # No order given: all non-key columns, ascending, make the winner
        # deterministic (rows equal on every column are interchangeable).
        return [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    return [F.col(c) if isinstance(c, str) else c for c in order]


def dedupe(df: DataFrame, keys: Sequence[str], order: OrderSpec | None = None) -> DataFrame:
    """First row per key by a total ``order`` (columns or sort expressions).

    Planned as ``row_number() = 1``: Spark inserts a partial
    ``WindowGroupLimit`` before the shuffle, so each map task forwards at
    most one row per key, and a hot key costs no more than a cold one.
    NULL keys form one group.
    """
    rn = "_dedupe_rn"
    w = Window.partitionBy(*keys).orderBy(*_order_columns(df, keys, order))
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


def dedupe_counted(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    count_col: str = "row_num",
) -> DataFrame:
    """One row per key (smallest by ``order``, ascending) plus the number of
    input rows it stood for.

    A single hash aggregate: ``min(struct(order..., rest...))`` and
    ``count(*)`` are both combined map-side before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    order = list(order) if order is not None else rest
    carried = [c for c in rest if c not in order]
    # Order columns first (they decide the minimum), then the rest.
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)] + [F.col(c) for c in carried]
    agg = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_w"), F.count(F.lit(1)).alias(count_col))

    def out(c: str) -> Column:
        if c in keys:
            return F.col(c)
        return F.col(f"_w._o{order.index(c)}" if c in order else f"_w.{c}").alias(c)

    return agg.select(*[out(c) for c in df.columns], count_col)
