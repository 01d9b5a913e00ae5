"""O28 ``upsert``: insert-or-replace by key, as a new snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.keys import require_keys


class DuplicateKeyError(ValueError):
    pass


class NullKeyError(ValueError):
    pass


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when two rows share a key or a key holds a NULL.  Runs one
    aggregation job; only one offending key is brought to the driver."""
    some_null = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in keys])
    bad = df.groupBy(*keys).count().where((F.col("count") > 1) | some_null).limit(1).collect()
    if bad and any(bad[0][k] is None for k in keys):
        raise NullKeyError(f"NULL key in upsert batch: {bad[0].asDict()}")
    if bad:
        raise DuplicateKeyError(f"duplicate key in upsert batch: {bad[0].asDict()}")


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    check_unique: bool = True,
) -> DataFrame:
    """New version of ``target`` with ``updates`` applied.

    Matched keys take ``update_cols`` from the update (other columns keep the
    target's values); unmatched updates are inserted; other target rows are
    kept.  One full outer join on the keys.  Updates must be unique on the
    keys (as an ON CONFLICT upsert requires) or :class:`DuplicateKeyError` is
    raised.  A NULL key is refused on both sides, as a primary key refuses it
    (:class:`NullKeyError`, or a failing job where ``check_unique`` is off or the
    target holds it).  Write the result to a new partition or path, never over the
    table being read.
    """
    keys = list(keys)
    cols = target.columns
    update_cols = [c for c in (update_cols or updates.columns) if c not in keys]
    if check_unique:
        assert_unique(updates, keys)
    t, u = require_keys(target, keys, "upsert target").alias("t"), require_keys(updates, keys, "upsert batch").alias("u")
    cond = reduce(lambda x, y: x & y, [F.col(f"t.{k}") == F.col(f"u.{k}") for k in keys])
    j = t.join(u, cond, "full_outer")
    matched = reduce(lambda x, y: x | y, [F.col(f"u.{k}").isNotNull() for k in keys])
    out = []
    for c in cols:
        if c in keys:
            out.append(F.coalesce(f"u.{c}", f"t.{c}").alias(c))
        elif c in update_cols:
            out.append(F.when(matched, F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return j.select(*out)
