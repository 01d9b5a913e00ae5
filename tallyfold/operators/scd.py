"""Slowly changing dimension, type 2 (O4 backfill, O5 increment)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.keys import require_keys


def _same(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Null-safe equality of attribute lists (two NULLs are equal)."""
    return reduce(lambda x, y: x & y, [x.eqNullSafe(y) for x, y in zip(a, b)])


def scd2_backfill(
    snapshots: DataFrame,
    keys: Sequence[str],
    period: str,
    attrs: Sequence[str],
    as_of: int | None = None,
    carry: Sequence[str] = (),
    start_col: str = "start_period",
    end_col: str = "end_period",
    as_of_col: str | None = "current_period",
    break_on_gap: bool = False,
) -> DataFrame:
    """Gaps-and-islands over periodic snapshots.

    A row starts a streak when it is the key's first row or any tracked
    attribute differs (null-safe) from the previous row; the running count of
    starts numbers the streaks; each streak becomes one row with its first
    and last period.  ``carry`` columns take the streak's earliest value;
    ``as_of_col`` (if given) is the latest period of the whole table.
    Missing periods do not split a streak unless ``break_on_gap`` is set
    (integer periods: a jump of more than one starts a new streak).

    Snapshot tables hold one row per key and period, so a key's window is
    bounded by the number of periods.  One exchange on the key serves the
    lag, the running sum and the final aggregation.  A NULL key is refused
    (the increment could not match it).
    """
    keys, attrs = list(keys), list(attrs)
    if as_of is None and as_of_col is not None:
        as_of = snapshots.agg(F.max(period)).first()[0]
    snapshots = require_keys(snapshots, keys, "snapshots")
    w = Window.partitionBy(*keys).orderBy(period)
    prev = [F.lag(a).over(w) for a in attrs]
    prev_period = F.lag(period).over(w)
    starts = prev_period.isNull() | ~_same([F.col(a) for a in attrs], prev)
    if break_on_gap:
        starts = starts | (F.col(period) - prev_period > 1)
    flagged = snapshots.select(*keys, period, *attrs, *carry, F.when(starts, 1).otherwise(0).alias("_start"))
    streaks = flagged.withColumn("_streak", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = streaks.groupBy(*keys, "_streak", *attrs).agg(
        *[F.min_by(c, period).alias(c) for c in carry],
        F.min(period).alias(start_col),
        F.max(period).alias(end_col),
    )
    cols = [*keys, *carry, *attrs, start_col, end_col]
    if as_of_col is not None:
        out = out.withColumn(as_of_col, F.lit(as_of).cast(snapshots.schema[period].dataType))
        cols.append(as_of_col)
    return out.select(*cols)


def scd2_incremental(
    scd_prev: DataFrame,
    snapshot: DataFrame,
    period_value: int,
    keys: Sequence[str],
    period: str,
    attrs: Sequence[str],
    carry: Sequence[str] = (),
    start_col: str = "start_period",
    end_col: str = "end_period",
    as_of_col: str = "current_period",
) -> DataFrame:
    """Merge last period's SCD with this period's snapshot.

    A row whose end is NULL is a current row and counts as ending at the last
    period.  Rows that end at ``period_value`` or later mean that the period
    has been merged already: the job fails (merge into the table as it was
    before the period instead).  Rows closed before the last period pass through.  Open rows (ending at
    the last period) meet the snapshot in one full outer join on the key:
    equal attributes extend the row, changed attributes close it and open a
    new one, keys absent from the snapshot keep their row, new keys open a
    row.  A NULL key is refused on either side.  Law: ``scd2_incremental(scd2_backfill(<= p-1), snap p)`` equals
    ``scd2_backfill(<= p)`` on dense snapshots.
    """
    keys, attrs, carry = list(keys), list(attrs), list(carry)
    last = period_value - 1
    scd_prev = require_keys(scd_prev, keys, "the history")
    ends = F.coalesce(F.col(end_col), F.lit(last).cast(scd_prev.schema[end_col].dataType))
    message = F.concat(F.lit(f"{end_col} is not before {period_value}: "), ends.cast("string"))
    scd_prev = scd_prev.withColumn(end_col, F.when(ends < F.lit(period_value), ends).otherwise(F.raise_error(message)))
    closed = scd_prev.where(F.col(end_col) < F.lit(last))
    open_rows = scd_prev.where(F.col(end_col) == F.lit(last)).alias("o")
    snap = require_keys(snapshot.where(F.col(period) == F.lit(period_value)), keys, "the snapshot").select(*keys, *attrs, *carry).alias("s")
    cond = reduce(lambda x, y: x & y, [F.col(f"o.{k}") == F.col(f"s.{k}") for k in keys])
    j = open_rows.join(snap, cond, "full_outer")

    o_present = F.col(f"o.{start_col}").isNotNull()  # every SCD row has a start
    s_present = reduce(lambda x, y: x | y, [F.col(f"s.{k}").isNotNull() for k in keys])
    same = _same([F.col(f"o.{a}") for a in attrs], [F.col(f"s.{a}") for a in attrs])
    pv = F.lit(period_value).cast(scd_prev.schema[start_col].dataType)

    def rec(side: str, start: Column, end: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in carry],
            *[F.col(f"{side}.{a}").alias(a) for a in attrs],
            start.alias(start_col),
            end.alias(end_col),
        )

    old = F.when(
        o_present,
        rec("o", F.col(f"o.{start_col}"), F.when(s_present & same, pv).otherwise(F.col(f"o.{end_col}"))),
    )
    new = F.when(s_present & (~o_present | ~same), rec("s", pv, pv))
    merged = j.select(
        *[F.coalesce(f"o.{k}", f"s.{k}").alias(k) for k in keys],
        F.inline(F.array_compact(F.array(old, new))),
    )
    cols = [*keys, *carry, *attrs, start_col, end_col]
    out = closed.select(*cols).unionByName(merged.select(*cols))
    return out.withColumn(as_of_col, pv)
