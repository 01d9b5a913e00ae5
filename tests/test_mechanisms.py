"""Two-level buckets, mergeable summaries, wide bit windows, visitor sketches,
cubes by season, interleaved layouts, surrogate ids and rejected CSV lines."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from support import rows

from tallyfold import maintained, reports
from tallyfold.functions.bits import advance_bits, wide_bits, wide_bits_count, wide_bits_text
from tallyfold.operators import activity, cube, matches, patterns, summaries, surrogate
from tallyfold.plans.explain import count_nodes, plan_text
from tallyfold.session import scoped_conf, scratch_path, scratch_table
from tallyfold.sources.tables import buckets_for, partitions_for, read_csv_checked, table_files, write_bucketed

D = dt.date


# --------------------------------------------------------- two-level buckets


def _match_tables(spark):
    rng = random.Random(1)
    hot = [(7, 1000 + i, i % 30) for i in range(3000)]
    cold = [(rng.randrange(100, 700), 5000 + i, i % 30) for i in range(6000)] + [(None, 1, 1)]
    d = spark.createDataFrame(hot + cold, "match_id bigint, player_gamertag bigint, player_total_kills int")
    m = spark.createDataFrame([(i, f"map{i % 3}", f"p{i % 2}") for i in [7, *range(100, 690)]], "match_id bigint, mapid string, playlist_id string")
    med = spark.createDataFrame([(rng.choice([7, *range(100, 700)]), rng.choice("ABC")) for _ in range(4000)] + [(7, "A")] * 500, "match_id bigint, medal_id string")
    return d, m, med


def test_hot_match_is_joined_by_many_tasks(spark):
    d, m, med = _match_tables(spark)
    n = 16
    out = []
    for name, df in zip("dmk", matches.spread_match_tables(d, m, med, n)):
        out.append(write_bucketed(df, scratch_table(spark, f"spread_{name}"), ["match_id", "_slot"], n, path=scratch_path(spark, f"spread_{name}")))
    j = matches.spread_join(*out)
    assert count_nodes(j, "Exchange") == 0 and count_nodes(j, "SortMergeJoin") == 2
    assert rows(j) == rows(matches.bucketed_join_factorized(d, m, med).select(*j.columns))
    per_task = [r[0] for r in j.groupBy(F.spark_partition_id().alias("_p")).count().select("count").collect()]
    assert max(per_task) < 4 * sum(per_task) / n
    details = out[0].groupBy(F.col("_metadata.file_path")).count().select("count").collect()
    largest, total = max(r[0] for r in details), d.count()
    assert largest < 4 * total / n  # one match holds a third: 5.3 / 16 of all by itself
    hot = out[0].where("match_id = 7").select("_slot").distinct().count()
    assert hot >= 5 and out[1].where("match_id = 7").count() == hot
    assert out[0].where("match_id <> 7").select("_slot").distinct().collect()[0][0] == 0


# ------------------------------------------------------------------ summaries


def _games(spark, seed, n=900):
    rng = random.Random(seed)
    start, out = D(2020, 1, 1), []
    for g in range(n):
        team = 1 if rng.random() < 0.5 else rng.randrange(2, 9)
        out.append((team, g, start + dt.timedelta(days=rng.randrange(300)), int(rng.random() < 0.6), rng.choice([5.0, 12.0, 20.0, None])))
    return spark.createDataFrame(out, "team_id int, game_id int, game_date date, won int, pts double").withColumn("player_id", F.col("team_id"))


@pytest.mark.parametrize("stretch,parts", [(90, 7), (5, 3), (2, 1)])
def test_summaries_equal_windows_and_grow_by_days(spark, stretch, parts):
    g = _games(spark, stretch)
    wins, streaks = patterns.rolling_wins(g, stretch), patterns.longest_streak(g, 10)
    whole = summaries.stretch_state(g, stretch, n_partitions=parts)
    assert rows(summaries.most_wins(whole, stretch)) == rows(wins)
    assert rows(summaries.longest_streaks(summaries.streak_state(g, 10, n_partitions=parts))) == rows(streaks)
    state = kept = None
    for lo, hi in ((D(2020, 1, 1), D(2020, 6, 1)), (D(2020, 6, 1), D(2020, 6, 2)), (D(2020, 6, 2), D(2021, 1, 1))):
        part = g.where((F.col("game_date") >= F.lit(lo)) & (F.col("game_date") < F.lit(hi)))
        state = summaries.stretch_state(part, stretch, state, parts).cache()
        kept = summaries.streak_state(part, 10, kept, parts).cache()
    assert rows(state) == rows(whole)
    assert rows(summaries.longest_streaks(kept)) == rows(streaks)


def test_summaries_refuse_late_games_and_null_keys(spark):
    g = _games(spark, 3, 60)
    state = summaries.streak_state(g, 10).cache()
    late = spark.createDataFrame([(1, 999, D(2020, 1, 2), 1, 20.0, 1)], g.schema)
    with pytest.raises(Exception, match="the state holds all games up to"):
        summaries.streak_state(late, 10, state).collect()
    new_team = late.withColumn("player_id", F.lit(77))  # its first game: nothing to be late for
    assert rows(summaries.longest_streaks(summaries.streak_state(new_team, 10, state)).where("player_id = 77")) == [(77, 1)]
    with pytest.raises(Exception, match="NULL in key"):
        summaries.stretch_state(g.withColumn("team_id", F.lit(None).cast("int"))).collect()
    assert summaries.stretch_state(g.limit(0)).collect() == []


def test_summaries_shuffle_games_once(spark):
    state = summaries.stretch_state(_games(spark, 4, 50))
    assert count_nodes(state, "Exchange rangepartitioning") == 1 and count_nodes(state, "Exchange hashpartitioning") == 1


# ----------------------------------------------------------------- wide bits


@pytest.mark.parametrize("n_days", [1, 10, 63, 64, 65, 128, 400])
def test_wide_bits_and_daily_advance_equal_brute_force(spark, n_days):
    rng = random.Random(n_days)
    end = D(2024, 3, 1)
    lists = [[end - dt.timedelta(days=rng.randrange(-2, n_days + 5)) for _ in range(rng.randrange(0, 60))] for _ in range(12)] + [[], [None, end, end]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, days array<date>")
    text = lambda x, at: "".join("1" if at - dt.timedelta(days=k) in x else "0" for k in range(n_days))
    words = df.select("i", "days", wide_bits(F.col("days"), F.lit(end), n_days).alias("w"))
    some = min(n_days, 70)
    got = words.select("i", wide_bits_text(F.col("w"), n_days), wide_bits_count(F.col("w")), wide_bits_count(F.col("w"), some))
    assert [tuple(r) for r in got.orderBy("i").collect()] == [(i, t, t.count("1"), t[:some].count("1")) for i, t in enumerate(text(x, end) for x in lists)]
    for day in range(1, 4):
        on = F.col("i") % (day + 1) == 0
        words = words.select("i", "days", advance_bits(F.col("w"), on, n_days).alias("w"))
        at = end + dt.timedelta(days=day)
        lists = [[d for d in x if d is None or d < at] + ([at] if i % (day + 1) == 0 else []) for i, x in enumerate(lists)]
        got = words.select("i", wide_bits_text(F.col("w"), n_days).alias("t")).orderBy("i").collect()
        assert [r.t for r in got] == [text(x, at) for x in lists]


def test_wide_activity_advances_without_the_lists(spark):
    day = D(2024, 1, 10)
    snap = spark.createDataFrame(
        [(1, "Chrome", [D(2024, 1, 9), D(2023, 10, 5)], day), (1, "Edge", [D(2024, 1, 9), D(2024, 1, 1)], day), (2, "Edge", [], day), (3, "Edge", [day], D(2024, 1, 9))],
        "user_id bigint, browser_type string, days array<date>, date date",
    )
    state = activity.wide_activity(snap, ["user_id"], "days", day, 100)
    active = spark.createDataFrame([(2,), (4,), (4,)], "user_id bigint")
    after = activity.advance_activity(state, active, ["user_id"], D(2024, 1, 11), 100)
    got = {r.user_id: r.t for r in after.select("user_id", wide_bits_text(F.col("words"), 100).alias("t")).collect()}
    ones = lambda *k: "".join("1" if i in k else "0" for i in range(100))
    assert got == {1: ones(2, 10, 98), 2: ones(0), 4: ones(0)}
    with pytest.raises(Exception, match="NULL in key"):
        activity.advance_activity(state, spark.createDataFrame([(None,)], "user_id bigint"), ["user_id"], D(2024, 1, 11), 100).collect()


# ------------------------------------------------------------------- sketches


def test_sketches_of_day_ranges(spark):
    rng = random.Random(8)
    data = [(rng.randrange(3000), f"h{rng.randrange(2)}", dt.datetime(2024, rng.choice([1, 2]), rng.randrange(1, 29), 5)) for _ in range(9000)]
    ev = spark.createDataFrame(data, "user_id bigint, host string, event_time timestamp_ntz")
    back = activity.reduce_monthly_sketches_backfill(ev, D(2024, 2, 28))
    for first, last in ((D(2024, 1, 3), D(2024, 1, 3)), (D(2024, 1, 20), D(2024, 2, 9)), (D(2024, 1, 1), D(2024, 2, 28))):
        got = {r.host: r.visitors for r in activity.visitors_between(back, first, last).collect()}
        for h in ("h0", "h1"):
            exact = len({u for u, x, t in data if x == h and first <= t.date() <= last})
            assert abs(got[h] - exact) <= 0.08 * exact
    # The fold of the days, and a day loaded again, give the same estimates.
    month = None
    for d in [*range(1, 29), 5]:
        month = activity.reduce_monthly_sketches(month, ev, D(2024, 2, d))
        month = spark.createDataFrame(month.collect(), month.schema)
    one = lambda m, a, b: rows(activity.visitors_between(m, D(2024, 2, a), D(2024, 2, b)))
    feb = back.where(F.col("month_start") == F.lit(D(2024, 2, 1)))
    assert one(month, 4, 17) == one(feb, 4, 17) and one(month, 1, 28) == one(feb, 1, 28)


# ----------------------------------------------------------------------- cube


def test_a_reloaded_season_replaces_its_part(spark):
    rng = random.Random(2)
    details = spark.createDataFrame([(rng.randrange(60), rng.randrange(9), rng.randrange(4), float(rng.randrange(30))) for _ in range(800)], "game_id int, player_id int, team_id int, pts double")
    games = spark.createDataFrame([(i, 2000 + i % 4, D(2000 + i % 4, 1, 1), i % 2) for i in range(60)], "game_id int, season int, game_date date, home_team_wins int")
    path = scratch_path(spark, "cube-test")
    cube.load_seasons(path, details.where("pts < 20"), games)
    before = table_files(spark, f"{path}/points/season=2001")
    for season in (2000, 2002, 2003):
        one = games.where(F.col("season") == season)
        cube.load_seasons(path, details, one)
    assert table_files(spark, f"{path}/points/season=2001") == before
    cube.load_seasons(path, details, games.where("season = 2001"))
    assert rows(cube.grouping_sets_of(spark, path)) == rows(patterns.points_grouping_sets(details, games))
    want = patterns.team_most_wins(patterns.team_games(details, games))
    assert rows(cube.team_most_wins_of(spark, path)) == rows(want)


# ---------------------------------------------------------- interleaved layout


def test_interleaved_files_serve_filters_on_either_column(spark):
    rng = random.Random(6)
    data = [(i, f"m{rng.randrange(200):03d}", rng.randrange(150) if rng.random() < 0.98 else None) for i in range(20000)]
    df = spark.createDataFrame(data, "match_id int, mapid string, playlist_id int")
    path, one = scratch_path(spark, "interleaved"), scratch_path(spark, "one-column")
    matches.interleave_within(df, ["mapid", "playlist_id"], 64, spread=["match_id"]).write.parquet(path)
    matches.sort_within(df, "mapid", 64, spread=["match_id"]).write.parquet(one)
    assert rows(spark.read.parquet(path)) == rows(df)
    read = lambda p, c: matches.files_with(spark, p, c).agg(F.avg(F.col("n_read") / F.col("n_files"))).first()[0]
    assert read(path, "mapid") < 0.3 and read(path, "playlist_id") < 0.3
    assert read(one, "playlist_id") > 0.9


# ------------------------------------------------------------- surrogate ids


def test_ids_are_dense_and_never_change(spark):
    rng = random.Random(4)
    first = spark.createDataFrame([(f"a{rng.randrange(300)}", rng.randrange(5)) for _ in range(900)], "k string, y int")
    ids = surrogate.assign_ids(first, None, ["k", "y"], n_partitions=5)
    want = {k: i for i, k in enumerate(sorted({(r.k, r.y) for r in first.collect()}), 1)}
    assert {(r.k, r.y): r.id for r in ids.collect()} == want
    more = spark.createDataFrame([("a1", 9), ("a0", 9), ("zz", 1), ("a1", 9)], "k string, y int").unionByName(first.limit(50))
    after = surrogate.assign_ids(more, ids, ["k", "y"], n_partitions=3)
    n = len(want)
    assert {(r.k, r.y): r.id for r in after.collect()} == want | {("a0", 9): n + 1, ("a1", 9): n + 2, ("zz", 1): n + 3}
    assert rows(surrogate.assign_ids(more, after, ["k", "y"])) == rows(after)
    assert surrogate.assign_ids(first.limit(0), None, ["k", "y"]).collect() == []
    with pytest.raises(Exception, match="NULL in key"):
        surrogate.assign_ids(spark.createDataFrame([(None, 1)], "k string, y int"), ids, ["k", "y"]).collect()


# -------------------------------------------------------------- rejected lines


def test_bad_csv_lines_are_kept_with_a_reason(spark, tmp_path):
    lines = ["k,name,v,d", '1,a,1.5,2024-01-01', '2,"b, c",2.5,2024-01-02', "x,d,3.5,2024-01-03", "4,e", '5,"f, g",oops,2024-01-05', "6,h,,", "7,i,7.5,2024-01-07,more", "8,j,8.5,not a day"]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    (tmp_path / "b.csv").write_text("k,name,v,d\n9,z,9.5,2024-01-09\n")
    good, bad = read_csv_checked(spark, str(tmp_path), "k int, name string, v double, d date", reject_path=scratch_path(spark, "rejects"))
    assert [r.k for r in good.orderBy("k").collect()] == [1, 2, 6, 9]
    assert good.where("k = 2").first().name == "b, c" and good.where("k = 6").first().v is None
    assert {r.line: r.reason for r in bad.collect()} == {
        "x,d,3.5,2024-01-03": "k is not a int",
        "4,e": "2 fields instead of 4",
        '5,"f, g",oops,2024-01-05': "v is not a double",
        "7,i,7.5,2024-01-07,more": "5 fields instead of 4",
        "8,j,8.5,not a day": "d is not a date",
    }
    assert {r.file.rsplit("/", 1)[1] for r in bad.collect()} == {"a.csv"}
    assert good.count() + bad.count() == len(lines) - 1 + 1


# ------------------------------------------------------------ size of a bucket


def test_a_bucket_keeps_its_size_as_tables_grow(spark):
    rows_of = lambda n: spark.range(n).selectExpr("id as match_id", "1 as mapid")
    small, large = rows_of(3_000), rows_of(60_000)
    assert buckets_for(small, rows=1_000) == 8
    assert buckets_for(small, large, rows=1_000) == 60  # beyond the 8 shuffle partitions
    assert buckets_for(rows_of(6_000_000)) == 12


# ------------------------------------------------------ the cube, game by game


def test_the_cube_is_made_in_place_from_details_before_returns(spark):
    rng = random.Random(9)
    none = lambda v: None if rng.random() < 0.05 else v
    data = [(none(rng.randrange(40)), rng.randrange(5), none(rng.randrange(3)), none(float(rng.randrange(30))), none(rng.randrange(4)), none(rng.choice("RAN"))) for _ in range(900)]
    flagged = spark.createDataFrame(data, "game_id int, player_id int, team_id int, pts double, line_number int, l_returnflag string")
    games = [(none(i), none(2000 + i % 3), D(2000, 1, 1), i % 2) for i in range(38)]
    games = spark.createDataFrame(games + games[:9], "game_id int, season int, game_date date, home_team_wins int")
    details = flagged.drop("l_returnflag")
    early = games.where("season < 2002").select("game_id")
    other = flagged.where("l_returnflag <> 'R'").select("game_id", "line_number")
    want = details.join(early, "game_id", "left_semi").unionByName(details.join(early, "game_id", "left_anti").join(other, ["game_id", "line_number"], "left_semi").select(*details.columns))
    assert rows(maintained._before_returns(flagged, games, 2002)) == rows(want)
    kept, games = maintained._by_game(flagged, games)
    first = maintained._before_returns(kept, games, 2002)
    assert rows(first) == rows(want)
    for part in (cube.season_cube(first, games), cube.season_wins(first, games)):
        assert "hashpartitioning(game_id" not in plan_text(part, "simple")


def test_snapshots_have_buckets_for_their_facts(spark):
    """The planned size of a backfill that joined two tables asks for the most."""
    years = spark.range(2000, 2003).selectExpr("cast(id as int) as y")
    keys = spark.range(200_000).withColumnRenamed("id", "k")
    backfill = keys.crossJoin(years)
    for name in "abcd":
        backfill = backfill.crossJoin(spark.range(1).withColumnRenamed("id", name)).drop(name)
    step = lambda prev: keys.withColumn("y", F.lit(2003))
    with scoped_conf(spark, {"spark.sql.shuffle.partitions": "40"}):
        snaps = reports._load(spark, "bucket-test", backfill, "y", ["k"], step, facts=keys)
        assert snaps.count() == 800_000
        assert partitions_for(backfill) > 8
        assert len({f.rsplit("_", 1)[1] for f in snaps.where("y = 2001").inputFiles()}) == 8
