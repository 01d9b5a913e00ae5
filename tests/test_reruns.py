"""Reruns, repeated rows and failed loads lose nothing and invent nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from support import rows
from tallyfold import reports
from tallyfold.operators import activity, cumulate, scd

EVENTS = "user_id bigint, host string, event_time timestamp_ntz"


def _events(spark):
    at = lambda d, h: dt.datetime(2024, 3, d, h)
    data = [(u, f"h{(u * d) % 3}", at(d, u)) for d in (1, 2, 4, 5, 7) for u in range(1, 6)]
    return spark.createDataFrame(data, EVENTS)


def _month(df):
    return sorted((r.host, tuple(r.hit_array), tuple(r.unique_visitors)) for r in df.collect())


def test_rerun_of_any_day_keeps_the_month(spark):
    ev = _events(spark)
    month = activity.reduce_monthly_backfill(ev, dt.date(2024, 3, 7)).cache()
    for day in range(1, 8):
        assert _month(activity.reduce_monthly(month, ev, dt.date(2024, 3, day))) == _month(month), day


def test_rerun_with_a_new_key_pads_the_later_days(spark):
    ev = _events(spark)
    month = activity.reduce_monthly_backfill(ev, dt.date(2024, 3, 7)).cache()
    late = ev.unionByName(spark.createDataFrame([(9, "new", dt.datetime(2024, 3, 3, 1))], EVENTS))
    again = activity.reduce_monthly(month, late, dt.date(2024, 3, 3))
    assert _month(again) == _month(activity.reduce_monthly_backfill(late, dt.date(2024, 3, 7)))


def _scd(spark, data):
    return spark.createDataFrame(data, "k string, c string, start_period int, end_period int, current_period int")


def test_scd_increment_keeps_current_rows_marked_by_null(spark):
    snap = spark.createDataFrame([("a", 3, "x"), ("b", 3, "z"), ("n", 3, "x")], "k string, p int, c string")
    plain = _scd(spark, [("a", "x", 1, 2, 2), ("b", "y", 1, 2, 2), ("gone", "q", 1, 2, 2), ("b", "o", 0, 0, 2)])
    marked = _scd(spark, [("a", "x", 1, None, 2), ("b", "y", 1, None, 2), ("gone", "q", 1, None, 2), ("b", "o", 0, 0, 2)])
    want = [("a", "x", 1, 3, 3), ("b", "o", 0, 0, 3), ("b", "y", 1, 2, 3), ("b", "z", 3, 3, 3), ("gone", "q", 1, 2, 3), ("n", "x", 3, 3, 3)]
    for prev in (plain, marked):
        assert rows(scd.scd2_incremental(prev, snap, 3, ["k"], "p", ["c"])) == want


def test_scd_increment_refuses_a_merged_period(spark):
    snap = spark.createDataFrame([("a", 3, "x")], "k string, p int, c string")
    done = _scd(spark, [("a", "x", 1, 3, 3)])
    with pytest.raises(Exception, match="end_period is not before 3"):
        scd.scd2_incremental(done, snap, 3, ["k"], "p", ["c"]).collect()


def test_repeated_player_season_counts_once(spark):
    cols = "player_name string, height string, college string, country string, draft_year string, draft_round string, draft_number string, season int, pts double, ast double, reb double, weight int"
    row = lambda season, pts: ("p", "6", "c", "US", "1", "1", "1", season, pts, 1.0, 1.0, 80)
    facts = spark.createDataFrame([row(2000, 10.0), row(2000, 25.0), row(2002, 5.0)], cols)
    back = cumulate.players_backfill(facts, 2002).cache()
    assert sorted(r.current_season for r in back.collect()) == [2000, 2001, 2002]
    assert [len(r.seasons) for r in back.orderBy("current_season").collect()] == [1, 1, 2]
    first = cumulate.cumulate_players(None, facts, 2000).collect()
    assert len(first) == 1 and first[0].seasons[0].pts == 25.0


def test_month_survives_a_load_that_fails_before_its_commit(spark, monkeypatch):
    ev = _events(spark)
    table = {}

    def broken(df, name):
        table["name"] = name
        raise RuntimeError("lost before the commit")

    monkeypatch.setattr(reports, "insert_periods", broken)
    back = activity.reduce_monthly_backfill(ev, dt.date(2024, 3, 5))
    with pytest.raises(RuntimeError, match="lost"):
        reports._load(spark, "t_month", back, "month_start", ["host"], lambda p: activity.reduce_monthly(p, ev, dt.date(2024, 3, 6)), replaces=True)
    assert _month(spark.table(table["name"])) == _month(back)


def test_shared_tables_follow_the_files(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t.parquet")
    made = []
    build = lambda: made.append(1) or len(made)
    assert reports._shared(spark, str(tmp_path), "x", ("t",), build) == 1
    assert reports._shared(spark, str(tmp_path), "x", ("t",), build) == 1
    spark.range(2).write.mode("append").parquet(f"{tmp_path}/t.parquet")
    assert reports._shared(spark, str(tmp_path), "x", ("t",), build) == 2


def test_broadcast_size_check_moves_no_rows(spark):
    from tallyfold.plans.explain import plan_text
    from tallyfold.plans.joins import row_bytes

    side = spark.range(1000).select("id", F.lit("x" * 50).alias("s"))
    text = plan_text(side.agg(F.sum(row_bytes(side).cast("long"))), "simple")
    assert "partial_sum" in text and "Limit" not in text
