"""Algebraic laws: folding increments equals the one-pass form, SCD
increment equals backfill, skew-safe sequences equal plain windows."""

import datetime as dt
import random

import pytest
from support import SF_SMALL, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyfold.operators import activity, cumulate, patterns, scd
from tallyfold.operators.dedupe import dedupe
from tallyfold.plans.sequence import sequence_positions
from tallyfold.session import scratch_path
from tallyfold.sources import proxy
from tallyfold.streaming import fold_periods


def _years(df, col):
    return [r[0] for r in df.select(col).distinct().orderBy(col).collect()]


def _days(spark):
    ev = proxy.clean_events(spark, SF_SMALL)
    lo, hi = ev.agg(F.min(F.to_date("event_time")), F.max(F.to_date("event_time"))).first()
    return ev, [lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)]


def test_actors_fold_equals_backfill(spark):
    af = proxy.actor_films(spark, SF_SMALL)
    years = _years(af, "year")
    sink = scratch_path(spark, "law/actors")
    folded = fold_periods(
        lambda prev, y: cumulate.cumulate_actors(prev, af, y),
        years,
        sink_path=sink,
        partition_col="current_year",
        keep_all=True,
    )
    closed = cumulate.actors_backfill(af, years[-1])
    cols = ["actorid", "actor", "current_year", "films", "quality_class", "is_active"]
    assert rows(folded, cols) == rows(closed, cols)


def test_players_fold_equals_backfill(spark):
    ps = proxy.player_seasons(spark, SF_SMALL)
    seasons = _years(ps, "season")
    last = fold_periods(lambda prev, s: cumulate.cumulate_players(prev, ps, s), seasons)
    closed = cumulate.players_backfill(ps, seasons[-1]).where(F.col("current_season") == seasons[-1])
    assert rows(last) == rows(closed.select(*last.columns))


def test_first_by_history_matches_grouped_form(spark):
    ps = proxy.player_seasons(spark, SF_SMALL)
    snaps = cumulate.players_backfill(ps, _years(ps, "season")[-1])
    a = cumulate.first_by_history(snaps)
    b = cumulate.first_by_history_grouped(snaps).select(*a.columns)
    assert rows(a) == rows(b)


def test_user_devices_fold_equals_backfill(spark):
    ev, days = _days(spark)
    dev = proxy.devices(spark, SF_SMALL)
    last = fold_periods(lambda prev, d: cumulate.cumulate_user_devices(prev, ev, dev, d), days)
    closed = cumulate.user_devices_backfill(ev, dev, days[-1]).select(*last.columns)
    assert rows(last) == rows(closed)


def test_hosts_fold_equals_backfill(spark):
    ev, days = _days(spark)
    last = fold_periods(lambda prev, d: cumulate.cumulate_hosts(prev, ev, d), days)
    closed = cumulate.hosts_backfill(ev, days[-1]).select(*last.columns)
    assert rows(last) == rows(closed)


def test_reduce_monthly_fold_equals_backfill(spark):
    ev, days = _days(spark)
    last = fold_periods(lambda prev, d: activity.reduce_monthly(prev, ev, d, "host"), days)
    closed = activity.reduce_monthly_backfill(ev, days[-1], "host").select(*last.columns)
    assert rows(last) == rows(closed)


def test_reduce_monthly_rerun_is_idempotent(spark):
    ev, days = _days(spark)
    d = days[-1]
    prev = activity.reduce_monthly_backfill(ev, d - dt.timedelta(days=1), "host")
    once = activity.reduce_monthly(prev, ev, d, "host")
    twice = activity.reduce_monthly(once, ev, d, "host")
    assert rows(once) == rows(twice)


def test_states_fold_equals_backfill(spark):
    ps = proxy.player_seasons(spark, SF_SMALL)
    seasons = _years(ps, "season")
    actives = cumulate.first_by_history(cumulate.players_backfill(ps, seasons[-1]))
    sink = scratch_path(spark, "law/growth")
    folded = fold_periods(
        lambda prev, s: activity.track_states(prev, actives, s),
        seasons,
        sink_path=sink,
        partition_col="season",
        keep_all=True,
    )
    closed = activity.states_backfill(actives, seasons[-1]).select(*folded.columns)
    assert rows(folded) == rows(closed)


@pytest.mark.parametrize("attrs", [["quality_class", "is_active"], ["quality_class"]])
def test_scd_increment_equals_backfill(spark, attrs):
    af = proxy.actor_films(spark, SF_SMALL)
    years = _years(af, "year")
    snaps = cumulate.actors_backfill(af, years[-1])
    kw = dict(carry=["actor"], start_col="start_year", end_col="end_year")
    for y in years[1:]:
        prev = scd.scd2_backfill(
            snaps.where(F.col("current_year") < y), ["actorid"], "current_year", attrs, as_of=y - 1, as_of_col="current_year", **kw
        )
        inc = scd.scd2_incremental(prev, snaps, y, ["actorid"], "current_year", attrs, as_of_col="current_year", **kw)
        full = scd.scd2_backfill(
            snaps.where(F.col("current_year") <= y), ["actorid"], "current_year", attrs, as_of=y, as_of_col="current_year", **kw
        )
        assert rows(inc) == rows(full.select(*inc.columns)), y


def test_scd_intervals_disjoint_and_cover(spark):
    af = proxy.actor_films(spark, SF_SMALL)
    snaps = cumulate.actors_backfill(af, _years(af, "year")[-1])
    out = scd.scd2_backfill(snaps, ["actorid"], "current_year", ["quality_class", "is_active"])
    per_key = {}
    for r in out.collect():
        per_key.setdefault(r.actorid, []).append((r.start_period, r.end_period))
    seen = {}
    for r in snaps.select("actorid", "current_year").collect():
        seen.setdefault(r.actorid, set()).add(r.current_year)
    for k, ivs in per_key.items():
        ivs.sort()
        covered = set()
        for (s, e), nxt in zip(ivs, ivs[1:] + [None]):
            assert s <= e
            if nxt:
                assert e + 1 == nxt[0]  # dense snapshots: gapless and disjoint
            covered |= set(range(s, e + 1))
        assert covered == seen[k]


def test_dedupe_idempotent(spark):
    gd = proxy.game_details(spark, SF_SMALL)
    once = dedupe(gd, ["player_id", "team_id", "game_id"], order=["line_number", "pts"])
    twice = dedupe(once, ["player_id", "team_id", "game_id"], order=["line_number", "pts"])
    assert rows(once) == rows(twice)
    assert once.count() == gd.select("player_id", "team_id", "game_id").distinct().count()


def test_bits_equal_brute_force(spark):
    random.seed(7)
    end = dt.date(2024, 1, 30)
    data = []
    for u in range(60):
        days = sorted({end - dt.timedelta(days=random.randint(0, 20)) for _ in range(random.randint(0, 8))})
        data.append((u % 40, days, end))
    df = spark.createDataFrame(data, "user_id bigint, device_activity_datelist array<date>, date date")
    out = {r.user_id: r for r in activity.datelist_to_bits(df, ["user_id"], "device_activity_datelist", end).collect()}
    expect = {}
    for u, days, _ in data:
        v = expect.get(u, 0)
        for d in days:
            k = (end - d).days
            if 0 <= k < 10:
                v |= 1 << (9 - k)
        expect[u] = v
    assert {u: r.datelist_int for u, r in out.items()} == expect
    for u, r in out.items():
        assert r.datelist_bits == format(expect[u], "010b")
        assert r.last_day_active == bool(expect[u] & 512)
        assert r.last_week_active == bool(expect[u] & 0b1111111000)


def test_grouping_sets_equal_separate_groupbys(spark):
    gd, g = proxy.game_details(spark, SF_SMALL), proxy.games(spark, SF_SMALL)
    gs = patterns.points_grouping_sets(gd, g)
    j = gd.join(g, "game_id")
    for level, keys in [("player_team", ["player_id", "team_id"]), ("player_season", ["player_id", "season"]), ("team_home_wins", ["team_id", "home_team_wins"])]:
        sep = j.groupBy(*keys).agg(F.sum("pts").alias("sum_points"))
        got_keys = [k if k != "home_team_wins" else "game_won" for k in keys]
        got = gs.where(F.col("agg_level") == level).select(*got_keys, "sum_points")
        assert rows(got) == rows(sep)


def _skewed(spark):
    random.seed(3)
    data = []
    for k in range(6):
        n = 3000 if k == 0 else random.randint(1, 150)  # key 0 holds most rows
        for i in range(n):
            data.append((k if k != 5 else None, dt.date(2020, 1, 1) + dt.timedelta(days=i // 3), i, random.randint(0, 1), float(random.randint(0, 20))))
    return spark.createDataFrame(data, "k int, d date, g bigint, won int, pts double")


def test_sequence_positions_equal_window(spark):
    df = _skewed(spark)
    seq = sequence_positions(df, ["k"], ["d", "g"], sums=["won"], n_partitions=16)
    w = Window.partitionBy("k").orderBy("d", "g")
    ref = df.select(
        "k", "d", "g", (F.row_number().over(w) - 1).alias("_pos"), F.sum("won").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("won_cum")
    )
    assert rows(seq, ["k", "d", "g", "_pos", "won_cum"]) == rows(ref)


def test_rolling_wins_equal_window(spark):
    df = _skewed(spark).select(F.col("k").alias("team_id"), F.col("g").alias("game_id"), F.col("d").alias("game_date"), "won")
    got = patterns.rolling_wins(df, 90, max_key_rows=None)  # force the split plan
    assert rows(got) == rows(patterns.rolling_wins(df, 90))  # checked-small: window plan
    w = Window.partitionBy("team_id").orderBy("game_date", "game_id").rowsBetween(-89, 0)
    ref = df.select("team_id", F.sum("won").over(w).alias("x")).groupBy("team_id").agg(F.max("x").cast("bigint").alias("max_wins_90"))
    assert rows(got) == rows(ref)


def test_longest_streak_brute_force(spark):
    df = _skewed(spark).select(F.col("k").alias("player_id"), F.col("g").alias("game_id"), F.col("d").alias("game_date"), "pts")
    got = {r.player_id: r.longest_streak for r in patterns.longest_streak(df, 10, max_key_rows=None).collect()}
    assert got == {r.player_id: r.longest_streak for r in patterns.longest_streak(df, 10).collect()}
    best = {}
    for k, grp in sorted_groups(df.collect()):
        run = b = 0
        for r in grp:
            run = run + 1 if (r.pts is not None and r.pts > 10) else 0
            b = max(b, run)
        best[k] = b
    assert got == best


def sorted_groups(rs):
    groups = {}
    for r in rs:
        groups.setdefault(r.player_id, []).append(r)
    for k, g in groups.items():
        yield k, sorted(g, key=lambda r: (r.game_date, r.game_id))


def test_fold_with_sink_rerun_is_idempotent(spark):
    ev, days = _days(spark)
    sink = scratch_path(spark, "law/hosts_sink")
    step = lambda prev, d: cumulate.cumulate_hosts(prev, ev, d)
    fold_periods(step, days, sink_path=sink, partition_col="date")
    first = spark.read.parquet(sink)
    n = first.count()
    last_rows = rows(first.where(F.col("date") == days[-1]))
    # rerun the last two days (late data): partitions are replaced, not appended
    prev = spark.read.parquet(sink)
    fold_periods(step, days[-2:], initial=prev, sink_path=sink, partition_col="date")
    again = spark.read.parquet(sink)
    assert again.count() == n
    assert rows(again.where(F.col("date") == days[-1])) == last_rows


def test_fold_into_bucketed_snapshot_table(spark):
    import uuid

    from tallyfold.plans.explain import plan_text

    af = proxy.actor_films(spark, SF_SMALL)
    years = _years(af, "year")
    table = f"actors_snap_{uuid.uuid4().hex[:8]}"
    step = lambda prev, y: cumulate.cumulate_actors(prev, af, y)
    folded = fold_periods(step, years, spark=spark, table=table, partition_col="current_year", bucket_by=["actorid"], keep_all=True)
    closed = cumulate.actors_backfill(af, years[-1])
    cols = ["actorid", "actor", "current_year", "films", "quality_class", "is_active"]
    assert rows(folded, cols) == rows(closed, cols)
    # the next step reads last year's snapshot in place: only the facts shuffle
    nxt = cumulate.cumulate_actors(spark.table(table), af, years[-1] + 1)
    text = plan_text(nxt, "simple")
    assert "Bucketed: true" in text
    assert "Exchange hashpartitioning(actorid" in text  # the new facts
    assert text.count("Exchange hashpartitioning") == 1
    # rerunning a period replaces it
    fold_periods(step, years[-1:], initial=spark.table(table), spark=spark, table=table, partition_col="current_year", bucket_by=["actorid"])
    assert spark.table(table).count() == closed.count()


def test_chunked_history_concatenates_to_full_history(spark):
    af = proxy.actor_films(spark, SF_SMALL)
    last = _years(af, "year")[-1]
    full = {(r.actorid, r.current_year): (r.films, r.quality_class, r.is_active, r.actor) for r in cumulate.actors_backfill(af, last).collect()}
    parts = {}
    for r in cumulate.actors_backfill_chunked(af, last, chunk_size=2, max_key_rows=None).collect():
        assert len(r.films) <= 2
        parts.setdefault((r.actorid, r.current_year), []).append((r.chunk, r.films, r.quality_class, r.is_active, r.actor))
    assert set(parts) == set(full)
    for k, chunks in parts.items():
        chunks.sort(key=lambda c: c[0])
        films = [f for c in chunks for f in c[1]]
        assert (films, chunks[0][2], chunks[0][3], chunks[0][4]) == full[k]


def test_chunked_fold_equals_chunked_backfill(spark):
    af = proxy.actor_films(spark, SF_SMALL)
    years = _years(af, "year")
    sink = scratch_path(spark, "law/actors_chunked")
    folded = fold_periods(
        lambda prev, y: cumulate.cumulate_actors_chunked(prev, af, y, chunk_size=2, max_key_rows=None),
        years,
        sink_path=sink,
        partition_col="current_year",
        keep_all=True,
    )
    closed = cumulate.actors_backfill_chunked(af, years[-1], chunk_size=2)
    cols = ["actorid", "actor", "current_year", "chunk", "films", "quality_class", "is_active"]
    assert rows(folded, cols) == rows(closed, cols)


def test_factorized_join_expands_to_fanout_join(spark):
    from tallyfold.operators import matches

    d, m, med = proxy.match_details(spark, SF_SMALL), proxy.matches(spark, SF_SMALL), proxy.medal_matches_players(spark, SF_SMALL)
    fan = matches.bucketed_join(d, m, med)
    fac = matches.bucketed_join_factorized(d, m, med)
    expanded = fac.withColumn("_r", F.explode(F.array_repeat(F.lit(1), F.col("medal_rows").cast("int")))).drop("_r", "medal_rows")
    assert rows(expanded, fan.columns) == rows(fan)
