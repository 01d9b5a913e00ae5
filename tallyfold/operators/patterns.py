"""Analytical patterns on game facts: grouping sets (O15), top questions
(O16), rolling 90-game wins (O17) and longest scoring streak (O18)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.operators.dedupe import dedupe
from tallyfold.plans.sequence import DEFAULT_KEY_ROWS, fits_window, positions, sequence_positions
from tallyfold.session import cut_lineage

# Fixed level names for grouping_id() over (player_id, team_id, season, game_won).
LEVELS = {3: "player_team", 5: "player_season", 10: "team_home_wins"}


def points_grouping_sets(game_details: DataFrame, games: DataFrame) -> DataFrame:
    """Points and home-win rows by (player, team), (player, season) and
    (team, home win) in one scan (Expand + one hash aggregate).  Rolled-up
    keys stay NULL; ``agg_level`` names the set.

    Detail rows are first summed per (game, player, team), a map-side
    combinable aggregate, so a game with a huge number of rows reaches the
    join with games as one row per player and team.
    """
    pre = game_details.groupBy("game_id", "player_id", "team_id").agg(
        F.sum("pts").alias("pts"), F.count(F.lit(1)).alias("n_rows")
    )
    g = games.select("game_id", "season", F.col("home_team_wins").alias("game_won"))
    return level_sets(pre.join(g, "game_id"))


def level_sets(rows: DataFrame) -> DataFrame:
    """The three levels of rows ``(player_id, team_id, season, game_won, pts,
    n_rows)``, which may be partial sums."""
    agg = rows.groupingSets(
        [["player_id", "team_id"], ["player_id", "season"], ["team_id", "game_won"]],
        "player_id",
        "team_id",
        "season",
        "game_won",
    ).agg(
        F.sum("pts").alias("sum_points"),
        F.sum(F.when(F.col("game_won") == 1, F.col("n_rows")).otherwise(F.lit(0))).cast("bigint").alias("home_team_wins"),
        F.grouping_id().alias("_gid"),
    )
    level = F.element_at(F.create_map(*[x for k, v in LEVELS.items() for x in (F.lit(k), F.lit(v))]), F.col("_gid"))
    return agg.select(
        level.alias("agg_level"), "player_id", "team_id", "season", "game_won", "sum_points", "home_team_wins"
    )


def season_rolled_up(gs: DataFrame) -> DataFrame:
    """The reference's final selection: every level without a season, most
    points first (ties in a fixed order).  The filter on the level reaches
    the Expand, so the dropped level is never aggregated."""
    return gs.where(F.col("agg_level") != F.lit("player_season")).orderBy(
        F.desc("sum_points"), "agg_level", "player_id", "team_id", "game_won"
    )


def top_scorer_for_team(gs: DataFrame) -> DataFrame:
    return (
        gs.where(F.col("agg_level") == "player_team")
        .orderBy(F.desc("sum_points"), "player_id", "team_id")
        .select("player_id", "team_id", "sum_points")
        .limit(1)
    )


def top_scorer_in_season(gs: DataFrame) -> DataFrame:
    return (
        gs.where(F.col("agg_level") == "player_season")
        .orderBy(F.desc("sum_points"), "player_id", "season")
        .select("player_id", "season", "sum_points")
        .limit(1)
    )


def team_games(game_details: DataFrame, games: DataFrame) -> DataFrame:
    """One row per (team, game): the home team is the smallest team id of
    the game; a team won when it is home and the home team won, or away and
    the home team lost."""
    tg = game_details.select("game_id", "team_id").distinct()
    # Combined map-side: a game with very many rows is one row per task.
    homes = game_details.groupBy("game_id").agg(F.min("team_id").alias("home_team"))
    j = tg.join(games.select("game_id", "game_date", "home_team_wins").join(homes, "game_id"), "game_id")
    won = F.when(F.col("team_id") == F.col("home_team"), F.col("home_team_wins") == 1).otherwise(
        F.col("home_team_wins") == 0
    )
    return j.select("team_id", "game_id", "game_date", F.coalesce(won, F.lit(False)).cast("int").alias("won"))


def team_most_wins(tg: DataFrame) -> DataFrame:
    """The team that won the most distinct games."""
    wins = tg.where(F.col("won") == 1).groupBy("team_id").agg(F.countDistinct("game_id").alias("games_won"))
    return wins.orderBy(F.desc("games_won"), "team_id").limit(1)


def rolling_wins(tg: DataFrame, stretch: int = 90, max_key_rows: int | None = DEFAULT_KEY_ROWS) -> DataFrame:
    """Per team, the most games won in any ``stretch`` consecutive games
    (ordered by date, then game id).

    When the largest team is checked to hold at most ``max_key_rows`` games,
    a per-team window with a ``stretch``-row frame does it in one shuffle.
    Otherwise it is computed as running-sum differences
    ``wins(i) - wins(i - stretch)`` from skew-safe positions, so a team with
    a huge schedule is split over many tasks (``max_key_rows=None`` forces
    this path)."""
    out = f"max_wins_{stretch}"
    if max_key_rows is not None:
        tg = cut_lineage(tg)  # read by the key check and by the plan: write once
    if fits_window(tg, ["team_id"], max_key_rows):
        w = Window.partitionBy("team_id").orderBy("game_date", "game_id").rowsBetween(-(stretch - 1), 0)
        per_row = tg.select("team_id", F.sum("won").over(w).alias("_w"))
        return per_row.groupBy("team_id").agg(F.max("_w").cast("bigint").alias(out))
    # Positions are read twice (current row and row - stretch): write once.
    seq = cut_lineage(sequence_positions(tg, ["team_id"], ["game_date", "game_id"], sums=["won"]).select("team_id", "_pos", "won_cum"))
    cur = seq
    lagged = seq.select("team_id", (F.col("_pos") + stretch).alias("_pos"), F.col("won_cum").alias("_won_before"))
    j = cur.join(lagged, ["team_id", "_pos"], "left")
    window_wins = F.col("won_cum") - F.coalesce("_won_before", F.lit(0))
    return j.groupBy("team_id").agg(F.max(window_wins).cast("bigint").alias(out))


def player_game_points(game_details: DataFrame, games: DataFrame) -> DataFrame:
    """Points of a player in a game: duplicates of (player, team, game) are
    removed first, then summed over the player's rows of the game."""
    gd = dedupe(game_details, ["player_id", "team_id", "game_id"], order=None)
    pg = gd.groupBy("player_id", "game_id").agg(F.sum("pts").alias("pts"))
    return pg.join(games.select("game_id", "game_date"), "game_id")


def longest_streak(
    player_games: DataFrame, min_points: float = 10, player_id=None, max_key_rows: int | None = DEFAULT_KEY_ROWS
) -> DataFrame:
    """Per player, the longest run of consecutive games with more than
    ``min_points`` points (NULL points break a run).  A run is an island of
    rows where ``position - qualifying rows so far`` stays constant.
    Positions come from a per-player window when the largest player is
    checked to be small, else from the skew-safe range-partitioned plan."""
    pg = player_games if player_id is None else player_games.where(F.col("player_id") == F.lit(player_id))
    q = pg.withColumn("q", F.coalesce((F.col("pts") > F.lit(min_points)).cast("int"), F.lit(0)))
    seq = positions(q, ["player_id"], ["game_date", "game_id"], sums=["q"], max_key_rows=max_key_rows, materialize_input=True)
    island = F.when(F.col("q") == 1, F.col("_pos") - F.col("q_cum"))
    runs = seq.groupBy("player_id", island.alias("_island")).agg(F.sum("q").alias("_len"))
    return runs.groupBy("player_id").agg(F.max("_len").cast("bigint").alias("longest_streak"))
