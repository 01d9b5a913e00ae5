"""Steps and closed forms refuse the same NULL keys; nothing is lost or split
silently."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from support import rows

from tallyfold.operators import activity, cumulate, merge, scd
from tallyfold.streaming import fold_periods

FILMS = "actor string, actorid string, film string, year int, votes int, rating double, filmid string"
SEASONS = "player_name string, height string, college string, country string, draft_year string, draft_round string, draft_number string, season int, pts double, ast double, reb double, weight int"
EVENTS = "event_id bigint, user_id bigint, device_id bigint, host string, event_time timestamp_ntz"


def _films(spark, data):
    return spark.createDataFrame([(a, i, f"f{k}", y, 1, r, f"id{k}") for k, (a, i, y, r) in enumerate(data)], FILMS)


def _season(name, season, pts):
    return (name, "6", "c", "US", "1", "1", "1", season, pts, 1.0, 1.0, 80)


def _refused(make):
    with pytest.raises(Exception, match="NULL in key"):
        make().collect()


def test_actors(spark):
    films = _films(spark, [("A", "1", 2000, 9.0), ("?", None, 2000, 7.0), ("?", None, 2001, 6.5)])
    _refused(lambda: cumulate.cumulate_actors(None, films, 2000))
    _refused(lambda: cumulate.actors_backfill(films, 2001))
    _refused(lambda: cumulate.cumulate_actors_chunked(None, films, 2000))
    _refused(lambda: cumulate.actors_backfill_chunked(films, 2001))
    good = films.where("actorid is not null")
    fold = fold_periods(lambda p, y: cumulate.cumulate_actors(p, good, y), [2000, 2001])
    assert rows(fold) == rows(cumulate.actors_backfill(good, 2001).where("current_year = 2001").select(*fold.columns))
    prev = cumulate.actors_backfill(good, 2000).withColumn("actorid", F.lit(None).cast("string"))
    _refused(lambda: cumulate.cumulate_actors(prev, good, 2001))


def test_players(spark):
    facts = spark.createDataFrame([_season("p", 2000, 9.0), _season(None, 2000, 9.0)], SEASONS)
    _refused(lambda: cumulate.cumulate_players(None, facts, 2000))
    _refused(lambda: cumulate.players_backfill(facts, 2000))


def test_user_devices(spark):
    ev = spark.createDataFrame([(1, 7, 10, "h", dt.datetime(2024, 1, 1, 1)), (2, 7, 11, "h", dt.datetime(2024, 1, 1, 2))], EVENTS)
    dev = spark.createDataFrame([(10, "Chrome"), (11, None)], "device_id bigint, browser_type string")
    _refused(lambda: cumulate.cumulate_user_devices(None, ev, dev, dt.date(2024, 1, 1)))
    _refused(lambda: cumulate.user_devices_backfill(ev, dev, dt.date(2024, 1, 1)))
    known = dev.where("browser_type is not null")
    step = cumulate.cumulate_user_devices(None, ev, known, dt.date(2024, 1, 1))
    assert rows(step) == rows(cumulate.user_devices_backfill(ev, known, dt.date(2024, 1, 1)).select(*step.columns))


def test_lifecycle_states(spark):
    actives = spark.createDataFrame([("p", 2000), (None, 2000), (None, 2001)], "player_name string, current_season int")
    _refused(lambda: activity.track_states(None, actives, 2000))
    _refused(lambda: activity.states_backfill(actives, 2001))


def test_history(spark):
    snaps = spark.createDataFrame([("a", 1, "x"), (None, 1, "x"), ("a", 2, "x"), (None, 2, "y")], "k string, p int, c string")
    _refused(lambda: scd.scd2_backfill(snaps, ["k"], "p", ["c"]))
    prev = scd.scd2_backfill(snaps.where("k is not null and p = 1"), ["k"], "p", ["c"])
    _refused(lambda: scd.scd2_incremental(prev, snaps, 2, ["k"], "p", ["c"]))
    hole = prev.withColumn("k", F.lit(None).cast("string"))
    _refused(lambda: scd.scd2_incremental(hole, snaps.where("k is not null"), 2, ["k"], "p", ["c"]))


def test_upsert(spark):
    target = spark.createDataFrame([(1, 2), (3, 4)], "k int, v int")
    batch = spark.createDataFrame([(None, 5), (3, 6)], "k int, v int")
    with pytest.raises(merge.NullKeyError):
        merge.upsert(target, batch, ["k"])
    _refused(lambda: merge.upsert(target, batch, ["k"], check_unique=False))
    _refused(lambda: merge.upsert(batch, target, ["k"]))
    # A NULL value of an update replaces a value; it is no missing update.
    some = spark.createDataFrame([(3, None), (9, None)], "k int, v int")
    assert rows(merge.upsert(target, some, ["k"])) == rows(spark.createDataFrame([(1, 2), (3, None), (9, None)], "k int, v int"))
