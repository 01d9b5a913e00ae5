"""O3 ``band``: ordered threshold classification with strict ``>``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's classes.
# Actor quality by average rating: > 8 star, > 7 good, > 6 average, else bad.
QUALITY_BANDS: tuple[tuple[float, str], ...] = ((8, "star"), (7, "good"), (6, "average"))
QUALITY_DEFAULT = "bad"
# Player scoring class by points: > 20 star, > 15 good, > 10 average, else bad.
SCORING_BANDS: tuple[tuple[float, str], ...] = ((20, "star"), (15, "good"), (10, "average"))
SCORING_DEFAULT = "bad"


def band(value: Column | str, bands: Sequence[tuple[float, str]], default: str) -> Column:
    """First label whose threshold ``value`` strictly exceeds; else ``default``.

    Bands are tried in the given order.  A NULL value falls through to the
    default, as a searched CASE does.
    """
    v = F.col(value) if isinstance(value, str) else value
    expr = None
    for threshold, label in bands:
        cond = v > F.lit(threshold)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))
