"""Array helpers that keep PostgreSQL's "NULL array is empty" semantics.

Spark's ``concat(arr, NULL)`` is NULL, so every concatenation coalesces
both sides to a typed empty array first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType


def empty_array(element_type: DataType) -> Column:
    return F.array().cast(ArrayType(element_type))


def concat_arrays(left: Column, right: Column, element_type: DataType) -> Column:
    e = empty_array(element_type)
    return F.concat(F.coalesce(left, e), F.coalesce(right, e))


def append_if(arr: Column, cond: Column, value: Column, element_type: DataType) -> Column:
    """``coalesce(arr, []) || (cond ? [value] : [])``."""
    e = empty_array(element_type)
    return F.concat(F.coalesce(arr, e), F.when(cond, F.array(value)).otherwise(e))


def pad_and_append(arr: Column, length_before: Column, value: Column) -> Column:
    """Zero-pad ``arr`` to ``length_before`` elements, then append ``value``.

    Used for positional day arrays: index i holds day i+1 of the month.
    """
    base = F.coalesce(arr, F.array().cast("array<bigint>"))
    pad = F.array_repeat(F.lit(0).cast("bigint"), F.greatest(length_before - F.size(base), F.lit(0)))
    return F.concat(base, pad, F.array(value.cast("bigint")))


def safe_get(arr: Column, index: int) -> Column:
    """0-based element access that yields NULL out of range (never raises)."""
    return F.get(arr, F.lit(index))
