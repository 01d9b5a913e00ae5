"""Operator inputs derived from the driver's test tables.

Each function reads only the columns it needs (pruned at the parquet scan)
and is pure DataFrame code, so the inputs grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.operators.dedupe import dedupe
from tallyfold.plans.joins import join_small
from tallyfold.sources.tables import read_table

# Fixed values of the proxy mapping: browser names for device_id % 4.
BROWSERS = ("Chrome", "Firefox", "Safari", "Edge")


def _years(df: DataFrame, col: str, first: int | None, last: int | None) -> DataFrame:
    """Restrict to years ``first..last`` with a range on the raw timestamp, a
    predicate the parquet scan can use (``year(ts) = y`` is not pushed)."""
    if first is not None:
        df = df.where(F.col(col) >= F.lit(f"{first:04d}-01-01 00:00:00").cast("timestamp_ntz"))
    if last is not None:
        df = df.where(F.col(col) < F.lit(f"{last + 1:04d}-01-01 00:00:00").cast("timestamp_ntz"))
    return df


def actor_films(spark: SparkSession, sf_dir: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """actor_films(actor, actorid, film, year, votes, rating, filmid) from orders."""
    o = _years(read_table(spark, sf_dir, "orders"), "o_orderdate", first, last)
    return o.select(
        F.concat(F.lit("Actor#"), F.col("o_custkey").cast("string")).alias("actor"),
        F.col("o_custkey").cast("string").alias("actorid"),
        F.concat(F.lit("Order#"), F.col("o_orderkey").cast("string")).alias("film"),
        F.year("o_orderdate").alias("year"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("votes"),
        (F.col("o_totalprice") / F.lit(50000.0)).alias("rating"),
        F.col("o_orderkey").cast("string").alias("filmid"),
    )


def player_seasons(spark: SparkSession, sf_dir: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """player_seasons: one row per (customer, order year)."""
    o = _years(read_table(spark, sf_dir, "orders"), "o_orderdate", first, last)
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    per_year = o.groupBy("o_custkey", F.year("o_orderdate").alias("season")).agg(
        (F.avg("o_totalprice") / F.lit(20000.0)).alias("pts"),
        F.count("*").cast("double").alias("ast"),
        (F.min("o_totalprice") / F.lit(10000.0)).alias("reb"),
        F.count("*").cast("int").alias("weight"),
    )
    cust = join_small(c, n, "c_nationkey", how="left")
    joined = per_year.join(cust, per_year.o_custkey == cust.c_custkey, "inner")
    null_s = F.lit(None).cast("string")
    return joined.select(
        F.col("c_name").alias("player_name"),
        F.col("c_mktsegment").alias("height"),
        null_s.alias("college"),
        F.col("n_name").alias("country"),
        null_s.alias("draft_year"),
        null_s.alias("draft_round"),
        null_s.alias("draft_number"),
        "season",
        "pts",
        "ast",
        "reb",
        "weight",
    )


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events(event_id, user_id, device_id, host, event_time)."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("device_id"),
        F.col("event_type").alias("host"),
        F.col("ts").alias("event_time"),
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """devices(device_id, browser_type): one browser per device id."""
    ev = web_events(spark, sf_dir).select("device_id").where(F.col("device_id").isNotNull()).distinct()
    names = F.array(*[F.lit(b) for b in BROWSERS])
    return ev.select("device_id", F.element_at(names, F.pmod("device_id", F.lit(len(BROWSERS))).cast("int") + 1).alias("browser_type"))


def game_details(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """game_details(game_id, player_id, team_id, pts, line_number) from lineitem,
    and ``more`` of its columns as they are."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("game_id"),
        F.col("l_partkey").alias("player_id"),
        F.col("l_suppkey").alias("team_id"),
        F.col("l_quantity").alias("pts"),
        F.col("l_linenumber").alias("line_number"),
        *more,
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """games(game_id, season, game_date, home_team_wins) from orders."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("game_id"),
        F.year("o_orderdate").alias("season"),
        F.to_date("o_orderdate").alias("game_date"),
        (F.col("o_orderstatus") == F.lit("F")).cast("int").alias("home_team_wins"),
    )


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """teams(team_id, abbreviation, nickname, city, arena, yearfounded).

    Several suppliers share a nation key, so team ids repeat and the vertex
    job has real duplicates to remove.
    """
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    j = join_small(s, n, "s_nationkey", how="left")
    return j.select(
        F.col("s_nationkey").cast("bigint").alias("team_id"),
        F.col("s_name").alias("abbreviation"),
        F.col("n_name").alias("nickname"),
        F.concat(F.lit("City#"), F.col("s_nationkey").cast("string")).alias("city"),
        F.concat(F.lit("Arena#"), F.col("s_suppkey").cast("string")).alias("arena"),
        F.col("s_acctbal").cast("bigint").alias("yearfounded"),
    )


def match_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("match_id"),
        F.col("l_suppkey").alias("player_gamertag"),
        F.col("l_quantity").alias("player_total_kills"),
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("match_id"),
        F.col("o_orderpriority").alias("mapid"),
        F.col("o_orderstatus").alias("playlist_id"),
    )


def medal_matches_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("match_id"), F.col("l_returnflag").alias("medal_id"))


def medals(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_nationkey").alias("name"),
        F.col("c_custkey").alias("medal_id"),
        F.col("c_name").alias("medal_name"),
    )


def maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("name"), F.col("n_name").alias("map_name"), F.col("n_regionkey").alias("region"))


def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web events deduplicated on (user_id, event_time), NULL users dropped."""
    ev = web_events(spark, sf_dir).where(F.col("user_id").isNotNull())
    return dedupe(ev, ["user_id", "event_time"], order=["event_id"])
