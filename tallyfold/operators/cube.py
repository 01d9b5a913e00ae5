"""Grouping sets (O15) and top questions (O16) kept up to date by season.

A partial cube holds one row per season, player, team and home result, with
the points and rows of its games; it is stored partitioned by season.  Every
grouping set adds partial rows up, so a season whose games change is loaded
again by itself: its partition is replaced, which takes its old contribution
back, and no other season is read.  A game belongs to one season, so distinct
games per team add up over seasons too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.operators.patterns import level_sets, team_games
from tallyfold.sources.tables import overwrite_into

POINTS, WINS = "points", "wins"


def season_cube(game_details: DataFrame, games: DataFrame) -> DataFrame:
    """Partial rows of the grouping sets; games without a season are kept under
    a NULL season."""
    pre = game_details.groupBy("game_id", "player_id", "team_id").agg(F.sum("pts").alias("pts"), F.count(F.lit(1)).alias("n_rows"))
    j = pre.join(games.select("game_id", "season", F.col("home_team_wins").alias("game_won")), "game_id")
    return j.groupBy("season", "player_id", "team_id", "game_won").agg(F.sum("pts").alias("pts"), F.sum("n_rows").alias("n_rows"))


def season_wins(game_details: DataFrame, games: DataFrame) -> DataFrame:
    """Games won per season and team."""
    won = team_games(game_details, games).where(F.col("won") == 1).join(games.select("game_id", "season"), "game_id")
    return won.groupBy("season", "team_id").agg(F.countDistinct("game_id").alias("games_won"))


def load_seasons(path: str, game_details: DataFrame, games: DataFrame) -> None:
    """Write (or replace) the partial rows of the seasons of ``games``, given
    with all their games and details."""
    for name, part in ((POINTS, season_cube(game_details, games)), (WINS, season_wins(game_details, games))):
        overwrite_into(part.repartition("season", "team_id"), f"{path}/{name}", partition_by=["season"])


def grouping_sets_of(spark: SparkSession, path: str) -> DataFrame:
    """O15 from the stored partial rows."""
    return level_sets(spark.read.parquet(f"{path}/{POINTS}"))


def team_most_wins_of(spark: SparkSession, path: str) -> DataFrame:
    """O16's most wins from the stored partial rows."""
    wins = spark.read.parquet(f"{path}/{WINS}").groupBy("team_id").agg(F.sum("games_won").alias("games_won"))
    return wins.orderBy(F.desc("games_won"), "team_id").limit(1)
