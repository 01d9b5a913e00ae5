"""Keys that may not be NULL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_keys(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``df``, whose job fails on a row with a NULL in ``keys``, as a primary
    key would refuse it.  A filter that leaves the key columns as they are, so
    a bucketed table is still joined in place and no job of its own runs."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    refused = F.raise_error(F.lit(f"{what}: NULL in key ({', '.join(keys)})")).cast("boolean")
    return df.where(present | refused)
