"""Job entry points with the shape of the reference's Spark jobs.

Each ``*_transformation(spark, dataframe[, ds])`` takes the source frame and
returns the result frame; ``run`` reads a catalog table, transforms it and
overwrites the target table (columns matched by name, then written in the
target's order, so a positional insert cannot swap columns).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyfold.operators.activity import positional_sums
from tallyfold.operators.dedupe import dedupe_counted
from tallyfold.operators.graph import team_vertex
from tallyfold.operators.scd import scd2_backfill
from tallyfold.session import scoped_conf


def player_scd_transformation(spark: SparkSession, dataframe: DataFrame) -> DataFrame:
    """players(player_name, current_season, scoring_class) ->
    players_scd(player_name, scoring_class, start_date, end_date)."""
    return scd2_backfill(
        dataframe,
        ["player_name"],
        "current_season",
        ["scoring_class"],
        start_col="start_date",
        end_col="end_date",
        as_of_col=None,
    )


def monthly_user_site_hits_transformation(spark: SparkSession, dataframe: DataFrame, ds: str) -> DataFrame:
    """monthly_user_site_hits(month_start, hit_array, date_partition) ->
    per month the hits of days 1, 2 and 3 for partition ``ds``."""
    return positional_sums(dataframe, ds)


def team_vertex_transformation(spark: SparkSession, dataframe: DataFrame, order) -> DataFrame:
    """teams -> team_vertex(identifier, type, properties).  ``order`` (columns
    or sort expressions) says which of a team's rows is the first: the rows of
    a table come in no order of their own."""
    return team_vertex(dataframe, order=order)


def team_deduped_transformation(spark: SparkSession, dataframe: DataFrame) -> DataFrame:
    """teams -> one row per team_id with the number of copies in row_num."""
    return dedupe_counted(dataframe, ["team_id"])


TRANSFORMS: dict[str, Callable[..., DataFrame]] = {
    "players_scd": player_scd_transformation,
    "monthly_user_site_hits": monthly_user_site_hits_transformation,
    "team_vertex": team_vertex_transformation,
    "team_deduped": team_deduped_transformation,
}


def run(spark: SparkSession, job: str, source_table: str, target_table: str, **params) -> None:
    """Read ``source_table``, apply the job's transformation, overwrite
    ``target_table`` (which must exist, e.g. created from
    :func:`tallyfold.schemas.ddl`)."""
    out = TRANSFORMS[job](spark, spark.table(source_table), **params)
    target_cols = spark.table(target_table).columns
    # Replace only the partitions written, whatever the table's own options.
    with scoped_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        out.select(*target_cols).write.insertInto(target_table, overwrite=True)
