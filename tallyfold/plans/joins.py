"""Broadcast only behind a measured size.

``join_small`` writes the small side once to the shared folder, sums its
bytes there (one partial sum a task, no rows move) and broadcasts it only
within the bound; beyond it the join is a shuffled one, which AQE may still
turn into a broadcast from real sizes.  Either way the side is computed once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.session import materialize

#: Bytes of rows a side may have to be broadcast.
BROADCAST_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row in memory: 8 a value, and text as long as it
    is."""
    size = F.lit(16)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + 8 + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + 8 + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            size = size + 8
    return size


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return (df.agg(F.sum(row_bytes(df).cast("long"))).first()[0] or 0) <= max_bytes


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: str | Sequence[str] | Column,
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``big`` with ``small``, broadcasting ``small`` only if its rows
    take at most ``max_bytes``.  ``small`` must be the right (build) side."""
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti", "semi", "anti"):
        raise ValueError(f"cannot broadcast the right side of a {how} join")
    small = materialize(small, "small-side")
    right = F.broadcast(small) if fits_broadcast(small, max_bytes) else small
    return big.join(right, on, how)
