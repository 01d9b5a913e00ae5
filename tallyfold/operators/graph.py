"""O19 graph vertices with a string property map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.dedupe import dedupe

# Fixed property names of a team vertex, in the reference's order, with the
# source column each is read from.
TEAM_PROPERTIES = (
    ("abbreviation", "abbreviation"),
    ("nickname", "nickname"),
    ("city", "city"),
    ("arena", "arena"),
    ("year_founded", "yearfounded"),
)


def vertices(
    df: DataFrame,
    id_col: str,
    vertex_type: str,
    properties: Sequence[tuple[str, str]],
    order=None,
) -> DataFrame:
    """First row per id (by ``order``), as (identifier, type, properties)
    with every property value cast to string."""
    first = dedupe(df, [id_col], order=order)
    pairs = [x for name, col in properties for x in (F.lit(name), F.col(col).cast("string"))]
    return first.select(
        F.col(id_col).alias("identifier"), F.lit(vertex_type).alias("type"), F.create_map(*pairs).alias("properties")
    )


def team_vertex(teams: DataFrame, order=None) -> DataFrame:
    return vertices(teams, "team_id", "team", TEAM_PROPERTIES, order=order)
