"""Plan checks: the physical plans have the shape the design relies on."""

import datetime as dt

from support import SF_SMALL, rows

from tallyfold import reports
from tallyfold.operators import cumulate, patterns, scd
from tallyfold.operators.dedupe import dedupe
from tallyfold.plans.explain import count_nodes, plan_text
from tallyfold.plans.joins import join_small
from tallyfold.sources import proxy


def test_bucketed_join_has_no_exchange(spark):
    df = reports.bucketed_join(spark, SF_SMALL)
    text = plan_text(df, "simple")
    assert "SortMergeJoin" in text
    assert "Exchange" not in text
    assert "Bucketed: true" in text


def test_match_questions_join_without_exchange(spark):
    for q in (reports.avg_kills, reports.top_map, reports.top_medal_map):
        text = plan_text(q(spark, SF_SMALL), "simple")
        # Only the grouping (and final ordering) shuffles; joins stay local.
        assert "BroadcastExchange" not in text
        assert "Exchange hashpartitioning(match_id" not in text


def test_broadcast_join_is_broadcast(spark):
    text = plan_text(reports.broadcast_join(spark, SF_SMALL), "simple")
    assert "BroadcastHashJoin" in text


def test_join_small_falls_back_when_too_big(spark):
    big = spark.range(100).withColumnRenamed("id", "k")
    small = spark.range(50).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_text(join_small(big, small, "k", max_bytes=2000), "simple")
        assert "BroadcastHashJoin" not in plan_text(join_small(big, small, "k", max_bytes=100), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scd_backfill_one_exchange(spark):
    af = proxy.actor_films(spark, SF_SMALL)
    snaps = spark.createDataFrame(
        [("a", 1, "good", True), ("a", 2, "bad", True)], "actorid string, current_year int, quality_class string, is_active boolean"
    )
    out = scd.scd2_backfill(snaps, ["actorid"], "current_year", ["quality_class", "is_active"], as_of=2)
    # lag, running sum and the streak aggregation share one shuffle on the key
    assert count_nodes(out, "Exchange") == 1
    assert af is not None


def test_dedupe_uses_partial_window_group_limit(spark):
    gd = proxy.game_details(spark, SF_SMALL)
    text = plan_text(dedupe(gd, ["player_id", "team_id", "game_id"], order=["line_number"]), "simple")
    assert "WindowGroupLimit" in text and "Partial" in text


def test_grouping_sets_single_expand(spark):
    gs = patterns.points_grouping_sets(proxy.game_details(spark, SF_SMALL), proxy.games(spark, SF_SMALL))
    text = plan_text(gs, "simple")
    assert text.count("Expand") == 1
    # detail rows are pre-aggregated before the join with games
    assert "partial_count(1)" in text


def test_day_filter_reaches_parquet_scan(spark):
    ev = proxy.clean_events(spark, SF_SMALL)
    dev = proxy.devices(spark, SF_SMALL)
    day = dt.date(2024, 1, 15)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        text = plan_text(cumulate.user_browser_days(ev, dev, cumulate._day_bounds(day)), "simple")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in text
    assert "LessThan(ts,2024-01-16T00:00)" in text


def test_scan_reads_only_needed_columns(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        text = plan_text(reports.top_scorer_for_team(spark, SF_SMALL), "simple")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_quantity:double>" in text


def test_scd_over_bucketed_snapshot_table_needs_no_exchange(spark):
    text = plan_text(reports.scd2_backfill_two(spark, SF_SMALL), "simple")
    # the snapshot table is bucketed by actor id: the LAG / running-sum
    # windows and the streak aggregation run in place
    assert "Bucketed: true" in text
    assert "Exchange" not in text
    assert text.count("Window [") == 2


def test_match_questions_use_per_match_counts(spark):
    text = plan_text(reports.playlist_joined_rows(spark, SF_SMALL), "simple")
    assert "Exchange hashpartitioning(match_id" not in text
    assert "(_n_det#" in text or "_n_det" in text


def test_positions_window_only_behind_key_check(spark):
    from tallyfold.plans.sequence import positions

    df = spark.createDataFrame([(0 if i < 200 else i, i) for i in range(260)], "k int, t int")
    small = plan_text(positions(df, ["k"], ["t"], max_key_rows=1000), "simple")
    assert "row_number()" in small  # largest key (200 rows) is under the bound: per-key window
    big = plan_text(positions(df, ["k"], ["t"], max_key_rows=100), "simple")
    assert "row_number()" not in big  # over the bound: range-partitioned positions
    assert rows(positions(df, ["k"], ["t"], max_key_rows=1000)) == rows(positions(df, ["k"], ["t"], max_key_rows=100))
