"""Registered queries over tables that are kept up to date in place: what
arrives later changes only the part of a table that it touches, and the result
is that of a full load.  Each query makes the table as an earlier load left
it, applies the later one through the library's operator, and returns the
whole table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold import reports
from tallyfold.functions.bits import wide_bits_count, wide_bits_text
from tallyfold.operators import activity, cube, cumulate, late, matches, scd, summaries, surrogate
from tallyfold.plans.sequence import largest_group
from tallyfold.session import cut_lineage, materialize, scratch_path, scratch_table
from tallyfold.sources import proxy
from tallyfold.sources.keyed import KeyedTable
from tallyfold.sources.tables import BUCKET_ROWS, buckets_for, read_csv_checked, read_table, write_bucketed

# ------------------------------------------------------- O28 in a stored table

# Buckets of the keyed tables of these queries.
BUCKETS = 16


def upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O28 on a keyed table: customers, with the accounts of all who ordered on
    the last day set to their largest order of that day, and the suppliers
    inserted (under negative keys)."""
    cols = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    table = KeyedTable.create(read_table(spark, sf_dir, "customer").select(*cols), scratch_path(spark, "customers/keyed"), ["c_custkey"], BUCKETS)
    last = reports._latest(spark, sf_dir, "orders", "o_orderdate").date()
    o = read_table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= F.lit(f"{last} 00:00:00").cast("timestamp_ntz"))
    table.upsert(o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal")))
    s = read_table(spark, sf_dir, "supplier")
    table.upsert(s.select((-F.col("s_suppkey") - 1).alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal")))
    return table.rows().select(*cols)


# ----------------------------------------------------------- late facts, O1 O5


def _films(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(all films, those that came in time, the late ones, last year): late are
    the films of each year's last week."""
    films = proxy.actor_films(spark, sf_dir)
    day = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("filmid"), F.col("o_orderdate").alias("_day"))
    dated = materialize(films.join(day, "filmid"), "films/dated")
    last_week = (F.month("_day") == 12) & (F.dayofmonth("_day") >= 25)
    cols = films.columns
    return dated.select(*cols), dated.where(~last_week).select(*cols), dated.where(last_week).select(*cols), reports._max_year(spark, sf_dir)


def late_actor_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O4/O5 with films of past years taken in late: the history loaded without
    each year's last week, then spliced."""
    films, in_time, late_films, y = _films(spark, sf_dir)
    history = scd.scd2_backfill(
        cumulate.actors_backfill(in_time, y),
        ["actorid"],
        "current_year",
        ["quality_class", "is_active"],
        as_of=y,
        carry=["actor"],
        start_col="start_year",
        end_col="end_year",
        as_of_col="current_year",
    )
    stored = materialize(history, "scd/before-late")
    return late.splice_actor_history(stored, films, late_films, y)


def late_actor_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 with the same late films: the snapshots of the actors they name are
    replaced in a keyed table."""
    films, in_time, late_films, y = _films(spark, sf_dir)
    table = KeyedTable.create(cumulate.actors_backfill(in_time, y), scratch_path(spark, "actors/keyed"), ["actorid"], BUCKETS)
    late.reload_actors(table, films, late_films, y)
    return table.rows().select(
        "actorid",
        "actor",
        "current_year",
        F.size("films").alias("n_films"),
        reports._ids("films", "filmid").alias("film_ids"),
        "quality_class",
        "is_active",
    )


# ---------------------------------------------------------- O21 O22, hot match


def bucketed_join_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O22 over two-level buckets."""
    frames = [proxy.match_details(spark, sf_dir), proxy.matches(spark, sf_dir), proxy.medal_matches_players(spark, sf_dir)]
    n = buckets_for(*frames)
    out = []
    for name, df in zip(("details", "matches", "kinds"), matches.spread_match_tables(*frames, n)):
        table = scratch_table(spark, f"spread_{name}")
        out.append(write_bucketed(df, table, ["match_id", matches.SLOT], n, path=scratch_path(spark, f"bucketed/{table}", unique=False)))
    return matches.spread_join(*out)


# -------------------------------------------------------- O17 O18 by summaries


def _before_last_year(games: DataFrame) -> tuple[DataFrame, DataFrame]:
    games = cut_lineage(games)
    new_year = F.lit(dt.date(games.agg(F.max("game_date")).first()[0].year, 1, 1))
    return games.where(F.col("game_date") < new_year), games.where(F.col("game_date") >= new_year)


def rolling_wins_90_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O17 from the stored summaries of all years but the last, with the last
    one's games merged in."""
    before, last = _before_last_year(reports._team_games(spark, sf_dir))
    stored = materialize(summaries.stretch_state(before, 90), "wins/state")
    return summaries.most_wins(summaries.stretch_state(last, 90, stored), 90)


def longest_streak_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O18, likewise."""
    before, last = _before_last_year(reports._player_points(spark, sf_dir))
    stored = materialize(summaries.streak_state(before, 10), "streaks/state")
    return summaries.longest_streaks(summaries.streak_state(last, 10, stored))


# --------------------------------------------------- O9 of any length, O11 sketches

WINDOW_DAYS = 400


def datelist_bits_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O9 over 400 days: the windows of the day before the last, made from the
    date lists, advanced by one day from the users active on the last."""
    events, devices, d = reports._events_tables(spark, sf_dir)
    lists = cumulate.user_devices_backfill(events, devices, d - dt.timedelta(days=1))
    stored = materialize(activity.wide_activity(lists, ["user_id"], "device_activity_datelist", d - dt.timedelta(days=1), WINDOW_DAYS), "windows")
    today = cumulate.user_browser_days(events, devices, cumulate._day_bounds(d))
    words = activity.advance_activity(stored, today.select("user_id"), ["user_id"], d, WINDOW_DAYS)
    return words.select(
        "user_id",
        wide_bits_text(F.col("words"), WINDOW_DAYS).alias("datelist_bits"),
        wide_bits_count(F.col("words")).cast("bigint").alias("active_days"),
        (wide_bits_count(F.col("words"), 1) > 0).alias("last_day_active"),
        wide_bits_count(F.col("words"), 28).cast("bigint").alias("active_days_28"),
    )


# Largest error of a visitor estimate that is accepted: five standard errors.
SKETCH_ERROR = 0.08


def host_visitors_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O11's month with visitor sketches: distinct visitors per host of the last
    14 days, exactly from the events and whether the estimate from the reduced
    table is within 8 %."""
    events, _, d = reports._events_tables(spark, sf_dir)
    back = materialize(activity.reduce_monthly_sketches_backfill(events, d - dt.timedelta(days=1)), "sketches/before")
    month = F.col("month_start") == F.lit(d.replace(day=1))
    now = materialize(back.where(~month).unionByName(activity.reduce_monthly_sketches(back, events, d)), "sketches/now")
    first = d - dt.timedelta(days=13)
    about = activity.visitors_between(now, first, d)
    days = events.where(cumulate._up_to(d) & ~cumulate._up_to(first - dt.timedelta(days=1)) & F.col("host").isNotNull())
    exact = days.groupBy("host").agg(F.countDistinct("user_id").alias("n_visitors"))
    within = F.abs(F.coalesce("visitors", F.lit(0)) - F.col("n_visitors")) <= F.greatest(F.lit(1.0), SKETCH_ERROR * F.col("n_visitors"))
    return exact.join(about, "host", "left").select("host", "n_visitors", within.alias("estimate_within"))


# ------------------------------------------------------------- O15 O16 by season


def _cube(spark: SparkSession, sf_dir: str) -> str:
    """A cube loaded first with one season's details incomplete (as they were
    before its last returns came in), then with that season loaded again."""
    files = ("orders", "lineitem")
    return reports._shared(spark, sf_dir, "cube", files, lambda: _load_cube(spark, sf_dir))


def _by_game(details: DataFrame, games: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Details and games bucketed on the game, once: both loads of the cube then
    join and group by game in place.  With a game of more than two buckets'
    rows they stay as they are, for shuffled joins that split it."""
    if largest_group(details, ["game_id"]) > 2 * BUCKET_ROWS:
        return details, games
    n, out = buckets_for(details, games), []
    for name, df in (("game_details", details), ("games", games)):
        table = scratch_table(spark := df.sparkSession, name)
        out.append(write_bucketed(df, table, "game_id", n, path=scratch_path(spark, f"bucketed/{table}", unique=False)))
    return out[0], out[1]


def _before_returns(details: DataFrame, games: DataFrame, season: int) -> DataFrame:
    """The details as they were before the returns of ``season``: those of
    earlier games, and of the others the lines with another flag than R."""
    early = games.where(F.col("season") < season).select("game_id").distinct().withColumn("_early", F.lit(True))
    # One pass with marks, no union of parts or join by line: a bucketed table
    # stays in place.
    kept = F.max(F.col("l_returnflag") != "R").over(Window.partitionBy("game_id", "line_number"))
    line = F.col("game_id").isNotNull() & F.col("line_number").isNotNull()
    marked = details.withColumn("_kept", line & F.coalesce(kept, F.lit(False))).join(early, "game_id", "left")
    return marked.where(F.col("_early").isNotNull() | F.col("_kept")).select(*[c for c in details.columns if c != "l_returnflag"])


def _load_cube(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "cube")
    flagged, games = _by_game(proxy.game_details(spark, sf_dir, "l_returnflag"), proxy.games(spark, sf_dir))
    season = games.agg(F.max("season")).first()[0]
    details = flagged.drop("l_returnflag")
    cube.load_seasons(path, _before_returns(flagged, games, season), games)
    cube.load_seasons(path, details, games.where(F.col("season") == season))
    return path


def points_grouping_sets_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O15 from the cube, all levels."""
    return cube.grouping_sets_of(spark, _cube(spark, sf_dir))


def team_most_wins_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O16 from the cube."""
    return cube.team_most_wins_of(spark, _cube(spark, sf_dir))


# ------------------------------------------------------------ O27, two columns


def interleaved_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O27 for (playlist, customer) at once: per column the rows, how many values
    it has, and whether a filter on one value reads at most half of the files
    on average, by the files' smallest and largest values."""
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("match_id"), F.col("o_custkey").alias("player"), F.col("o_orderdate").alias("played"))
    path = scratch_path(spark, "layouts/interleaved")
    matches.interleave_within(o, ["player", "played"], 16, spread=["match_id"]).write.parquet(path)
    n = F.lit(spark.read.parquet(path).count())
    out = None
    for name in ("player", "played"):
        files = matches.files_with(spark, path, name)
        one = files.agg(
            F.lit(name).alias("layout"),
            F.max(n).alias("n_rows"),
            F.count(F.lit(1)).alias("n_values"),
            (F.avg(F.col("n_read") / F.col("n_files")) <= 0.5).alias("skips_half"),
        )
        out = one if out is None else out.unionByName(one)
    return out


# ------------------------------------------------------------- surrogate ids, O31


def scd_surrogate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the history's rows: numbered as of last year, then the rows that
    this year opened numbered after them."""
    history = reports.scd2_incremental(spark, sf_dir)
    y = reports._max_year(spark, sf_dir)
    keys = ["actorid", "start_year"]
    first = materialize(surrogate.assign_ids(history.where(F.col("start_year") < y), None, keys), "ids/before")
    return history.join(surrogate.assign_ids(history, first, keys), keys).select("id", "actorid", "start_year", "end_year", "quality_class")


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O31 on orders of which those of status P have text for a price and those
    of priority 5 lack the last two fields: good rows, and rejected lines per
    reason."""
    o = read_table(spark, sf_dir, "orders")
    urgent = F.col("o_orderpriority").startswith("5")
    price = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    head = F.concat_ws(",", F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"), price)
    rest = F.concat_ws(",", F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority"))
    path = scratch_path(spark, "orders_bad_csv")
    o.select(F.when(urgent, head).otherwise(F.concat_ws(",", head, rest)).alias("value")).write.text(path)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"
    good, bad = read_csv_checked(spark, path, schema, header=False, reject_path=scratch_path(spark, "orders_rejects"))
    kept = good.agg(F.lit("good").alias("reason"), F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("key_sum"))
    key = F.split("line", ",")[0].cast("bigint")
    return kept.unionByName(bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(key).alias("key_sum")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        upsert_buckets,
        late_actor_history,
        late_actor_snapshots,
        bucketed_join_spread,
        rolling_wins_90_merged,
        longest_streak_merged,
        datelist_bits_wide,
        host_visitors_between,
        points_grouping_sets_reload,
        team_most_wins_reload,
        interleaved_layout,
        scd_surrogate_ids,
        csv_rejects,
    )
}
