"""Cumulative snapshot tables.

Each table has an incremental step ``next = step(prev, facts, period)``
(previous snapshot FULL OUTER JOIN this period's aggregate) and a closed
form that computes the same snapshots in one pass over the facts (the
backfill).  Tests check the law: folding the step period by period equals
the closed form.  Both refuse facts and snapshots with a NULL in the entity
key, as the primary keys of these tables do (a join would split or lose them).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tallyfold.functions.arrays import append_if, concat_arrays
from tallyfold.functions.classify import (
    QUALITY_BANDS,
    QUALITY_DEFAULT,
    SCORING_BANDS,
    SCORING_DEFAULT,
    band,
)
from tallyfold.functions.keys import require_keys
from tallyfold.plans.joins import join_small
from tallyfold.schemas import FILM, SEASON_STATS

# --------------------------------------------------------------------------
# O1 actors: yearly film history
# --------------------------------------------------------------------------


def _sorted_films() -> Column:
    """Films of one period sorted by film id (the reference leaves the
    order open; a fixed order makes snapshots reproducible)."""
    keyed = F.sort_array(
        F.collect_list(F.struct(F.col("filmid").alias("k"), F.struct("film", "votes", "rating", "filmid").alias("v")))
    )
    return F.transform(keyed, lambda e: e["v"]).cast(f"array<{FILM.simpleString()}>")


def _actor_year_aggregate(actor_films: DataFrame, keys: list[str]) -> DataFrame:
    return actor_films.groupBy(*keys).agg(
        F.min("actor").alias("actor"),
        _sorted_films().alias("films"),
        F.avg("rating").alias("avg_rating"),
    )


def cumulate_actors(prev: DataFrame | None, actor_films: DataFrame, year: int) -> DataFrame:
    """O1 step: snapshot of ``year`` from the snapshot of ``year - 1``.

    Names are previous-first, the history is ``prev || this year``, the
    class is recomputed only for actors with films this year, and
    ``is_active`` says whether they had any.
    """
    films = require_keys(actor_films.where(F.col("year") == F.lit(year)), ["actorid"], "actor_films")
    cur = _actor_year_aggregate(films, ["actorid"]).withColumn(
        "quality_class", band("avg_rating", QUALITY_BANDS, QUALITY_DEFAULT)
    )
    if prev is None:
        prev = cur.sparkSession.createDataFrame([], "actorid string, actor string, films array<" + FILM.simpleString() + ">, quality_class string, current_year int")
    p = require_keys(prev.where(F.col("current_year") == F.lit(year - 1)), ["actorid"], "actors").alias("p")
    c = cur.alias("c")
    j = p.join(c, F.col("p.actorid") == F.col("c.actorid"), "full_outer")
    present = F.col("c.actorid").isNotNull()
    return j.select(
        F.coalesce("p.actorid", "c.actorid").alias("actorid"),
        F.coalesce("p.actor", "c.actor").alias("actor"),
        F.lit(year).cast("int").alias("current_year"),
        concat_arrays(F.col("p.films"), F.col("c.films"), FILM).alias("films"),
        F.when(present, F.col("c.quality_class")).otherwise(F.col("p.quality_class")).alias("quality_class"),
        present.alias("is_active"),
    )


def _expand_to_next(df: DataFrame, period_col: str, key: list[str], as_of: int, out: str) -> DataFrame:
    """Each row of an active period stands for its own period and the
    inactive ones after it: up to (next active period - 1) or ``as_of``."""
    w = Window.partitionBy(*key).orderBy(period_col)
    upto = F.coalesce(F.lead(period_col).over(w) - 1, F.lit(as_of))
    return df.withColumn("_upto", upto).withColumn(out, F.explode(F.sequence(F.col(period_col), F.col("_upto")))).drop("_upto")


def actors_backfill(actor_films: DataFrame, as_of: int) -> DataFrame:
    """O1 closed form: every yearly snapshot up to ``as_of`` in one pass.

    One shuffle on the actor id serves both the per-year aggregate and the
    history window.  Each active year expands to itself and the inactive
    years that follow it; the class of an inactive year is that of the
    active year it came from.
    """
    facts = require_keys(actor_films.where(F.col("year") <= F.lit(as_of)), ["actorid"], "actor_films").repartition("actorid")
    yearly = _actor_year_aggregate(facts, ["actorid", "year"])
    rows = _expand_to_next(yearly, "year", ["actorid"], as_of, "current_year")
    running = Window.partitionBy("actorid").orderBy("current_year").rowsBetween(Window.unboundedPreceding, 0)
    active = F.col("current_year") == F.col("year")
    return rows.select(
        "actorid",
        F.first("actor", ignorenulls=True).over(running).alias("actor"),
        F.col("current_year").cast("int").alias("current_year"),
        F.flatten(F.collect_list(F.when(active, F.col("films"))).over(running)).alias("films"),
        band("avg_rating", QUALITY_BANDS, QUALITY_DEFAULT).alias("quality_class"),
        active.alias("is_active"),
    )


def actors_backfill_chunked(
    actor_films: DataFrame, as_of: int, chunk_size: int = 1000, max_key_rows: int | None = 5_000_000
) -> DataFrame:
    """O1 closed form with the film history split over rows of at most
    ``chunk_size`` films: one row per (actor, year, chunk).  Concatenating
    an actor-year's chunks in chunk order gives exactly the ``films`` array
    of :func:`actors_backfill`; no film is dropped.

    No group is unbounded: films are numbered per actor with positions that
    are skew-safe unless the largest actor is checked to hold at most
    ``max_key_rows`` films (an actor with a third of all films is split over
    many tasks), a chunk collects at most ``chunk_size`` films, and the per
    actor-year attributes come from a list-free aggregate.  The join that
    attaches the attributes has one attribute row per actor-year, so AQE's
    skew-join split handles an actor with very many chunks.
    """
    from tallyfold.plans.sequence import positions

    facts = require_keys(actor_films.where(F.col("year") <= F.lit(as_of)), ["actorid"], "actor_films")
    yearly = facts.groupBy("actorid", "year").agg(F.min("actor").alias("actor"), F.avg("rating").alias("avg_rating"))
    rows = _expand_to_next(yearly, "year", ["actorid"], as_of, "current_year")
    running = Window.partitionBy("actorid").orderBy("current_year").rowsBetween(Window.unboundedPreceding, 0)
    attrs = rows.select(
        "actorid",
        F.first("actor", ignorenulls=True).over(running).alias("actor"),
        F.col("current_year").cast("int").alias("current_year"),
        band("avg_rating", QUALITY_BANDS, QUALITY_DEFAULT).alias("quality_class"),
        (F.col("current_year") == F.col("year")).alias("is_active"),
    )

    numbered = positions(
        facts.select("actorid", "year", "film", "votes", "rating", "filmid"), ["actorid"], ["year", "filmid"], max_key_rows=max_key_rows
    )
    film = F.struct("film", "votes", "rating", "filmid").cast(FILM)
    chunks = numbered.groupBy("actorid", F.floor(F.col("_pos") / F.lit(chunk_size)).alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("_pos", "year", film.alias("f")))).alias("_items"),
        F.min("year").alias("_y0"),
    )
    # A chunk is part of every snapshot from its first film's year on and
    # holds, in a snapshot, the films up to that year.
    per_year = chunks.withColumn("current_year", F.explode(F.sequence("_y0", F.lit(as_of)))).select(
        "actorid",
        "chunk",
        F.col("current_year").cast("int").alias("current_year"),
        F.transform(F.filter("_items", lambda i: i["year"] <= F.col("current_year")), lambda i: i["f"]).alias("films"),
    )
    out = per_year.join(attrs, ["actorid", "current_year"])
    return out.select("actorid", "actor", "current_year", "chunk", "films", "quality_class", "is_active")


def cumulate_actors_chunked(
    prev: DataFrame | None,
    actor_films: DataFrame,
    year: int,
    chunk_size: int = 1000,
    max_key_rows: int | None = 5_000_000,
) -> DataFrame:
    """O1 step in the chunked layout: rows (actor, ``year``, chunk) from the
    rows of ``year - 1``.  The year's films are numbered after the actor's
    earlier films (skew-safe positions plus a per-actor count of earlier
    films), so they fill the last partial chunk and then new ones; other
    chunks are carried unchanged.  Attributes follow :func:`cumulate_actors`.
    Law: folding this step equals :func:`actors_backfill_chunked`."""
    from tallyfold.plans.sequence import positions

    cur_facts = require_keys(actor_films.where(F.col("year") == F.lit(year)), ["actorid"], "actor_films")
    if prev is None:
        prev = cur_facts.sparkSession.createDataFrame(
            [],
            "actorid string, actor string, current_year int, chunk bigint, films array<"
            + FILM.simpleString()
            + ">, quality_class string, is_active boolean",
        )
    p = require_keys(prev.where(F.col("current_year") == F.lit(year - 1)), ["actorid"], "actors")

    cur = cur_facts.groupBy("actorid").agg(F.min("actor").alias("actor"), F.avg("rating").alias("avg_rating")).alias("c")
    pa = p.where(F.col("chunk") == 0).select("actorid", "actor", "quality_class").alias("p")
    present = F.col("c.actorid").isNotNull()
    attrs = pa.join(cur, F.col("p.actorid") == F.col("c.actorid"), "full_outer").select(
        F.coalesce("p.actorid", "c.actorid").alias("actorid"),
        F.coalesce("p.actor", "c.actor").alias("actor"),
        F.when(present, band(F.col("c.avg_rating"), QUALITY_BANDS, QUALITY_DEFAULT))
        .otherwise(F.col("p.quality_class"))
        .alias("quality_class"),
        present.alias("is_active"),
    )

    before = p.groupBy("actorid").agg(F.sum(F.size("films")).alias("_n_before"))
    seq = positions(
        cur_facts.select("actorid", "film", "votes", "rating", "filmid"), ["actorid"], ["filmid"], max_key_rows=max_key_rows
    )
    pos = F.coalesce(F.col("_n_before"), F.lit(0)) + F.col("_pos")
    film = F.struct("film", "votes", "rating", "filmid").cast(FILM)
    new_chunks = (
        seq.join(before, "actorid", "left")
        .groupBy("actorid", F.floor(pos / F.lit(chunk_size)).alias("chunk"))
        .agg(F.sort_array(F.collect_list(F.struct(pos.alias("_p"), film.alias("f")))).alias("_items"))
        .select("actorid", "chunk", F.transform("_items", lambda i: i["f"]).alias("films"))
        .alias("n")
    )
    old = p.select("actorid", "chunk", "films").alias("o")
    merged = old.join(
        new_chunks, (F.col("o.actorid") == F.col("n.actorid")) & (F.col("o.chunk") == F.col("n.chunk")), "full_outer"
    ).select(
        F.coalesce("o.actorid", "n.actorid").alias("actorid"),
        F.coalesce("o.chunk", "n.chunk").alias("chunk"),
        concat_arrays(F.col("o.films"), F.col("n.films"), FILM).alias("films"),
    )
    out = merged.join(attrs, "actorid")
    return out.select(
        "actorid",
        "actor",
        F.lit(year).cast("int").alias("current_year"),
        "chunk",
        "films",
        "quality_class",
        "is_active",
    )


# --------------------------------------------------------------------------
# O2 players: seasonal stats history
# --------------------------------------------------------------------------

PLAYER_ATTRS = ("height", "college", "country", "draft_year", "draft_round", "draft_number")


def _season_struct() -> Column:
    return F.struct(
        F.col("season").cast("int").alias("season"),
        F.col("pts").cast("double").alias("pts"),
        F.col("ast").cast("double").alias("ast"),
        F.col("reb").cast("double").alias("reb"),
        F.col("weight").cast("int").alias("weight"),
    )


def _one_per_season(player_seasons: DataFrame) -> DataFrame:
    """One row per (player, season): of repeated rows the one of most points
    (then by the other columns), chosen by an aggregate that combines
    map-side."""
    player_seasons = require_keys(player_seasons, ["player_name"], "player_seasons")
    rest = ["pts", "ast", "reb", "weight", *PLAYER_ATTRS]
    best = player_seasons.groupBy("player_name", "season").agg(F.max(F.struct(*rest)).alias("_best"))
    return best.select("player_name", "season", "_best.*")


def cumulate_players(prev: DataFrame | None, player_seasons: DataFrame, season: int) -> DataFrame:
    """O2 step: attributes previous-first, stats appended when the player
    played this season, scoring class from this season's points.  Repeated
    rows of a player and season count once (:func:`_one_per_season`)."""
    player_seasons = _one_per_season(player_seasons.where(F.col("season") == F.lit(season)))
    t = player_seasons.where(F.col("season") == F.lit(season)).select(
        "player_name", *PLAYER_ATTRS, "season", _season_struct().alias("stats"), "pts"
    )
    if prev is None:
        prev = t.sparkSession.createDataFrame(
            [],
            "player_name string, "
            + ", ".join(f"{a} string" for a in PLAYER_ATTRS)
            + f", seasons array<{SEASON_STATS.simpleString()}>, scoring_class string, current_season int",
        )
    ls = require_keys(prev.where(F.col("current_season") == F.lit(season - 1)), ["player_name"], "players").alias("ls")
    ts = t.alias("ts")
    j = ls.join(ts, F.col("ls.player_name") == F.col("ts.player_name"), "full_outer")
    present = F.col("ts.season").isNotNull()
    return j.select(
        F.coalesce("ls.player_name", "ts.player_name").alias("player_name"),
        *[F.coalesce(f"ls.{a}", f"ts.{a}").alias(a) for a in PLAYER_ATTRS],
        append_if(F.col("ls.seasons"), present, F.col("ts.stats"), SEASON_STATS).alias("seasons"),
        F.when(present, band(F.col("ts.pts"), SCORING_BANDS, SCORING_DEFAULT))
        .otherwise(F.col("ls.scoring_class"))
        .alias("scoring_class"),
        present.alias("is_active"),
        F.lit(season).cast("int").alias("current_season"),
    )


def players_backfill(player_seasons: DataFrame, as_of: int) -> DataFrame:
    """O2 closed form: every seasonal snapshot up to ``as_of``; repeated rows
    of a player and season count once."""
    facts = _one_per_season(player_seasons.where(F.col("season") <= F.lit(as_of))).repartition("player_name")
    rows = _expand_to_next(facts.withColumn("stats", _season_struct()), "season", ["player_name"], as_of, "current_season")
    running = Window.partitionBy("player_name").orderBy("current_season").rowsBetween(Window.unboundedPreceding, 0)
    active = F.col("current_season") == F.col("season")
    return rows.select(
        "player_name",
        *[F.first(a, ignorenulls=True).over(running).alias(a) for a in PLAYER_ATTRS],
        F.collect_list(F.when(active, F.col("stats"))).over(running).alias("seasons"),
        band("pts", SCORING_BANDS, SCORING_DEFAULT).alias("scoring_class"),
        active.alias("is_active"),
        F.col("current_season").cast("int").alias("current_season"),
    )


def first_by_history(players: DataFrame) -> DataFrame:
    """The earliest season of each distinct history of a player.

    The history grows exactly in the seasons the player was active, so the
    earliest snapshot of each distinct history is the active snapshot: a
    filter instead of a shuffle that hashes whole history arrays.
    """
    return players.where(F.col("is_active")).select("player_name", "seasons", "current_season")


def first_by_history_grouped(players: DataFrame) -> DataFrame:
    """O14 as literally specified (group by name and history array)."""
    return players.groupBy("player_name", "seasons").agg(F.min("current_season").alias("current_season"))


# --------------------------------------------------------------------------
# O8 user x browser date lists, O10 host date lists
# --------------------------------------------------------------------------


def _midnight(day: dt.date) -> Column:
    # From text, so no session or process time zone can shift the bound.
    return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")


def _day_bounds(day: dt.date) -> Column:
    """Rows whose ``event_time`` falls on ``day``: a range on the raw column,
    so the predicate reaches the parquet scan."""
    return (F.col("event_time") >= _midnight(day)) & (F.col("event_time") < _midnight(day + dt.timedelta(days=1)))


def _up_to(day: dt.date) -> Column:
    return F.col("event_time") < _midnight(day + dt.timedelta(days=1))


def _user_browser_rows(events: DataFrame, devices: DataFrame, day_filter: Column) -> DataFrame:
    ev = events.where(day_filter).select("user_id", "device_id", F.to_date("event_time").alias("day"))
    dev = devices.select("device_id", "browser_type").distinct()
    rows = join_small(ev, dev, "device_id").select("user_id", "browser_type", "day")
    return require_keys(rows, ["user_id", "browser_type"], "events of devices")


def user_browser_days(events: DataFrame, devices: DataFrame, day_filter: Column) -> DataFrame:
    """Distinct (user_id, browser_type, day) of deduplicated events."""
    return _user_browser_rows(events, devices, day_filter).distinct()


def cumulate_user_devices(prev: DataFrame | None, events: DataFrame, devices: DataFrame, day: dt.date) -> DataFrame:
    """O8 step for ``day``.  Joined on both keys (user, browser); every output
    row carries ``date = day``; the day is appended only when active."""
    today = user_browser_days(events, devices, _day_bounds(day)).alias("t")
    if prev is None:
        prev = today.sparkSession.createDataFrame(
            [], "user_id bigint, browser_type string, device_activity_datelist array<date>, date date"
        )
    y = prev.where(F.col("date") == F.lit(day - dt.timedelta(days=1)))
    y = require_keys(y, ["user_id", "browser_type"], "user_devices_cumulated").alias("y")
    j = y.join(
        today,
        (F.col("y.user_id") == F.col("t.user_id")) & (F.col("y.browser_type") == F.col("t.browser_type")),
        "full_outer",
    )
    seen = F.col("t.day").isNotNull()
    return j.select(
        F.coalesce("t.user_id", "y.user_id").alias("user_id"),
        F.coalesce("t.browser_type", "y.browser_type").alias("browser_type"),
        append_if(F.col("y.device_activity_datelist"), seen, F.col("t.day"), DateType()).alias(
            "device_activity_datelist"
        ),
        F.lit(day).alias("date"),
    )


def user_devices_backfill(events: DataFrame, devices: DataFrame, as_of: dt.date) -> DataFrame:
    """O8 closed form: snapshot as of ``as_of`` in one aggregation.  The
    day set is built map-side (partial ``collect_set``), so one shuffle of at
    most one row per key, day and task."""
    days = _user_browser_rows(events, devices, _up_to(as_of))
    return days.groupBy("user_id", "browser_type").agg(
        F.array_sort(F.collect_set("day")).alias("device_activity_datelist"),
        F.lit(as_of).alias("date"),
    )


def host_days(events: DataFrame, day_filter: Column) -> DataFrame:
    return events.where(day_filter & F.col("host").isNotNull()).select(
        "host", F.to_date("event_time").alias("day")
    ).distinct()


def cumulate_hosts(prev: DataFrame | None, events: DataFrame, day: dt.date) -> DataFrame:
    """O10 step: hosts active on ``day`` get the day appended; silent hosts
    keep their list; ``date = day`` on every row."""
    today = host_days(events, _day_bounds(day)).alias("t")
    if prev is None:
        prev = today.sparkSession.createDataFrame([], "host_name string, host_activity_datelist array<date>, date date")
    y = require_keys(prev.where(F.col("date") == F.lit(day - dt.timedelta(days=1))), ["host_name"], "hosts_cumulated").alias("y")
    j = y.join(today, F.col("y.host_name") == F.col("t.host"), "full_outer")
    seen = F.col("t.day").isNotNull()
    return j.select(
        F.coalesce("t.host", "y.host_name").alias("host_name"),
        append_if(F.col("y.host_activity_datelist"), seen, F.col("t.day"), DateType()).alias("host_activity_datelist"),
        F.lit(day).alias("date"),
    )


def hosts_backfill(events: DataFrame, as_of: dt.date) -> DataFrame:
    days = events.where(_up_to(as_of) & F.col("host").isNotNull()).select("host", F.to_date("event_time").alias("day"))
    return days.groupBy(F.col("host").alias("host_name")).agg(
        F.array_sort(F.collect_set("day")).alias("host_activity_datelist"),
        F.lit(as_of).alias("date"),
    )


def user_devices_as_map(snapshot: DataFrame) -> DataFrame:
    """The other layout the date-list spec allows: one row per user with a
    ``map<browser_type, array<date>>``.  A user's row holds one entry per
    browser, so it is bounded by the number of browsers."""
    return snapshot.groupBy("user_id", "date").agg(
        F.map_from_entries(F.collect_list(F.struct("browser_type", "device_activity_datelist"))).alias(
            "device_activity_datelist"
        )
    )
