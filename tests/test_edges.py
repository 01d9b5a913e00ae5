"""Edge rows (FIXTURES.md): NULL attributes, absent keys, two browsers on
one day, silent days, month boundaries, duplicate upsert keys, NULL keys."""

import datetime as dt

import pytest
from support import rows
from pyspark.sql import functions as F

from tallyfold.operators import activity, cumulate, merge, patterns, scd
from tallyfold.operators.dedupe import dedupe, dedupe_counted
from tallyfold.streaming import fold_periods

D = dt.date


def test_null_attribute_two_periods_is_one_streak(spark):
    snaps = spark.createDataFrame(
        [("a", 1, "good"), ("a", 2, None), ("a", 3, None), ("a", 4, "good")], "k string, p int, c string"
    )
    out = scd.scd2_backfill(snaps, ["k"], "p", ["c"], as_of_col=None)
    assert rows(out) == rows(
        spark.createDataFrame([("a", "good", 1, 1), ("a", None, 2, 3), ("a", "good", 4, 4)], "k string, c string, s int, e int")
    )


def test_scd_increment_absent_key_keeps_row_and_new_key_opens(spark):
    prev = spark.createDataFrame(
        [("a", "good", 1, 2, 2), ("b", "bad", 1, 2, 2), ("c", "bad", 1, 1, 2)],
        "k string, c string, start_period int, end_period int, current_period int",
    )
    snap = spark.createDataFrame([("a", "good", 3), ("d", "star", 3)], "k string, c string, p int")
    out = scd.scd2_incremental(prev, snap, 3, ["k"], "p", ["c"])
    assert rows(out) == sorted(
        [("a", "good", 1, 3, 3), ("b", "bad", 1, 2, 3), ("c", "bad", 1, 1, 3), ("d", "star", 3, 3, 3)]
    )


def test_scd_increment_changed_row_closes_and_opens(spark):
    prev = spark.createDataFrame([("a", "good", 1, 2, 2)], "k string, c string, start_period int, end_period int, current_period int")
    snap = spark.createDataFrame([("a", "bad", 3)], "k string, c string, p int")
    out = scd.scd2_incremental(prev, snap, 3, ["k"], "p", ["c"])
    assert rows(out) == sorted([("a", "good", 1, 2, 3), ("a", "bad", 3, 3, 3)])


def _events(spark, data):
    return spark.createDataFrame(
        [(i, u, dev, host, ts) for i, (u, dev, host, ts) in enumerate(data)],
        "event_id bigint, user_id bigint, device_id bigint, host string, event_time timestamp_ntz",
    )


def test_two_browsers_one_day_and_bits_or(spark):
    t = dt.datetime
    ev = _events(spark, [(1, 10, "h", t(2024, 1, 9, 1)), (1, 11, "h", t(2024, 1, 9, 2)), (1, 10, "h", t(2024, 1, 10, 3))])
    dev = spark.createDataFrame([(10, "Chrome"), (11, "Safari")], "device_id bigint, browser_type string")
    last = fold_periods(lambda p, d: cumulate.cumulate_user_devices(p, ev, dev, d), [D(2024, 1, 9), D(2024, 1, 10)])
    got = {(r.user_id, r.browser_type): r.device_activity_datelist for r in last.collect()}
    assert got == {(1, "Chrome"): [D(2024, 1, 9), D(2024, 1, 10)], (1, "Safari"): [D(2024, 1, 9)]}
    assert {r.date for r in last.collect()} == {D(2024, 1, 10)}
    bits = activity.datelist_to_bits(last, ["user_id"], "device_activity_datelist", D(2024, 1, 10)).collect()
    # same day from two browsers ORs into one bit (SUM would carry)
    assert bits[0].datelist_int == 0b1100000000


def test_null_user_dropped_and_duplicates_removed(spark):
    t = dt.datetime(2024, 1, 1, 5)
    ev = _events(spark, [(None, 1, "h", t), (2, 1, "h", t), (2, 1, "h", t)])
    clean = dedupe(ev.where(F.col("user_id").isNotNull()), ["user_id", "event_time"], order=["event_id"])
    assert clean.count() == 1


def test_host_silent_day_and_month_boundary(spark):
    t = dt.datetime
    ev = _events(
        spark,
        [
            (1, 1, "a", t(2024, 1, 30, 1)),
            (2, 1, "a", t(2024, 1, 30, 2)),
            (1, 1, "b", t(2024, 1, 31, 1)),  # a silent on the 31st, b first seen on the last day
            (1, 1, "a", t(2024, 2, 1, 1)),  # new month starts fresh
        ],
    )
    days = [D(2024, 1, 30), D(2024, 1, 31), D(2024, 2, 1)]
    sink = None
    state = None
    snaps = {}
    for d in days:
        state = activity.reduce_monthly(state, ev, d, "host")
        snaps[d] = {(r.host, r.month_start): (r.hit_array, r.unique_visitors) for r in state.collect()}
        state = spark.createDataFrame(state.collect(), state.schema)
    jan = snaps[D(2024, 1, 31)]
    assert jan[("a", D(2024, 1, 1))] == ([0] * 29 + [2, 0], [0] * 29 + [2, 0])
    assert jan[("b", D(2024, 1, 1))] == ([0] * 30 + [1], [0] * 30 + [1])
    feb = snaps[D(2024, 2, 1)]
    assert feb == {("a", D(2024, 2, 1)): ([1], [1])}
    closed = activity.reduce_monthly_backfill(ev, D(2024, 1, 31), "host")
    assert {(r.host, r.month_start): (r.hit_array, r.unique_visitors) for r in closed.collect()} == jan
    assert sink is None


def test_upsert_duplicate_key_raises(spark):
    target = spark.createDataFrame([(1, "a", 1.0)], "k bigint, name string, v double")
    updates = spark.createDataFrame([(1, 2.0), (1, 3.0)], "k bigint, v double")
    with pytest.raises(merge.DuplicateKeyError):
        merge.upsert(target, updates, ["k"], ["v"])


def test_upsert_replaces_inserts_keeps(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k bigint, name string, v double")
    updates = spark.createDataFrame([(2, 20.0), (3, 30.0)], "k bigint, v double")
    out = merge.upsert(target, updates, ["k"], ["v"])
    assert rows(out) == [(1, "a", 1.0), (2, "b", 20.0), (3, None, 30.0)]


def test_grouping_sets_keep_real_zero_and_null_keys(spark):
    gd = spark.createDataFrame(
        [(1, 0, 0, 5.0, 1), (1, None, 0, 7.0, 2)], "game_id bigint, player_id bigint, team_id bigint, pts double, line_number int"
    )
    g = spark.createDataFrame([(1, 2020, D(2020, 1, 1), 1)], "game_id bigint, season int, game_date date, home_team_wins int")
    gs = patterns.points_grouping_sets(gd, g)
    pt = {(r.player_id, r.team_id): r.sum_points for r in gs.where(F.col("agg_level") == "player_team").collect()}
    # a genuine player 0 and a genuine NULL player stay apart from rolled-up rows
    assert pt == {(0, 0): 5.0, (None, 0): 7.0}
    assert gs.where(F.col("agg_level") == "team_home_wins").collect()[0].home_team_wins == 2


def test_dedupe_counted_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, "x"), (None, "y"), (1, "z")], "k bigint, v string")
    out = dedupe_counted(df, ["k"])
    assert rows(out) == sorted([(None, "x", 2), (1, "z", 1)], key=lambda t: (t[0] is None, str(t)))


def test_states_return_from_retirement(spark):
    act = spark.createDataFrame([("p", 1), ("p", 4)], "player_name string, current_season int")
    out = activity.states_backfill(act, 5)
    got = [(r.season, r.activity_state) for r in out.orderBy("season").collect()]
    assert got == [(1, "New"), (2, "Retired"), (3, "Stayed Retired"), (4, "Returned from Retirement"), (5, "Retired")]
    folded = fold_periods(lambda prev, s: activity.track_states(prev, act, s), range(1, 6))
    assert [(r.season, r.activity_state) for r in folded.collect()] == [(5, "Retired")]


def test_enum_check_rejects_unknown_label(spark):
    from tallyfold.schemas import check_enums

    ok = spark.createDataFrame([("star",), (None,)], "quality_class string")
    assert check_enums(ok, "actors").count() == 2
    bad = spark.createDataFrame([("superb",)], "quality_class string")
    with pytest.raises(Exception, match="label not in"):
        check_enums(bad, "actors").collect()


def test_ddl_has_partitions_and_comments():
    from tallyfold.schemas import ddl

    text = ddl("actors")
    assert "PARTITIONED BY (current_year)" in text
    assert "COMMENT 'class of the average film rating" in text
    assert text.index("`current_year`") > text.index("`is_active`")  # partition column last


def test_read_csv_explicit_and_inferred(spark, tmp_path):
    from tallyfold.sources.tables import read_csv, write_csv

    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", None)], "id bigint, s string, x double")
    path = str(tmp_path / "t")
    write_csv(df, path)
    assert rows(read_csv(spark, path, schema="id bigint, s string, x double")) == rows(df)
    inferred = read_csv(spark, path, infer=True)
    assert [f.dataType.simpleString() for f in inferred.schema.fields] == ["int", "string", "double"]
    assert [f.dataType.simpleString() for f in read_csv(spark, path).schema.fields] == ["string"] * 3


def test_sort_within_clusters_by_column(spark):
    from tallyfold.operators.matches import sort_within
    from tallyfold.plans.explain import plan_text

    df = spark.createDataFrame([(i, f"m{i % 3}") for i in range(30)], "match_id bigint, mapid string")
    out = sort_within(df, "mapid", 4)
    text = plan_text(out, "simple")
    assert "rangepartitioning(mapid" in text and "Sort [mapid" in text
    for part in out.rdd.glom().collect():
        keys = [r.mapid for r in part]
        assert keys == sorted(keys)


def test_scd_gap_kept_by_default_split_on_request(spark):
    snaps = spark.createDataFrame([("a", 1, "good"), ("a", 2, "good"), ("a", 5, "good")], "k string, p int, c string")
    joined = scd.scd2_backfill(snaps, ["k"], "p", ["c"], as_of_col=None)
    assert rows(joined) == [("a", "good", 1, 5)]
    split = scd.scd2_backfill(snaps, ["k"], "p", ["c"], as_of_col=None, break_on_gap=True)
    assert rows(split) == [("a", "good", 1, 2), ("a", "good", 5, 5)]


def test_user_devices_map_layout(spark):
    snap = spark.createDataFrame(
        [(1, "Chrome", [D(2024, 1, 9)], D(2024, 1, 10)), (1, "Safari", [D(2024, 1, 10)], D(2024, 1, 10))],
        "user_id bigint, browser_type string, device_activity_datelist array<date>, date date",
    )
    out = cumulate.user_devices_as_map(snap).collect()
    assert len(out) == 1
    assert out[0].device_activity_datelist == {"Chrome": [D(2024, 1, 9)], "Safari": [D(2024, 1, 10)]}
