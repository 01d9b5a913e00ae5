"""The job entry points, run end to end through catalog tables."""

import uuid

from support import rows

from tallyfold import jobs
from tallyfold.session import scratch_path


def test_players_scd_job_through_catalog(spark):
    tag = uuid.uuid4().hex[:8]
    src, dst = f"players_{tag}", f"players_scd_{tag}"
    spark.createDataFrame(
        [("Michael Jordan", 2001, "Good"), ("Michael Jordan", 2002, "Good"), ("Michael Jordan", 2003, "Bad"), ("Someone Else", 2003, "Bad")],
        "player_name string, current_season bigint, scoring_class string",
    ).write.saveAsTable(src, path=scratch_path(spark, f"jobs/{src}"))
    spark.sql(
        f"CREATE TABLE {dst} (player_name string, scoring_class string, start_date bigint, end_date bigint) "
        f"USING parquet LOCATION '{scratch_path(spark, f'jobs/{dst}')}'"
    )
    jobs.run(spark, "players_scd", src, dst)
    jobs.run(spark, "players_scd", src, dst)  # rerun replaces, does not append
    assert rows(spark.table(dst)) == sorted(
        [("Michael Jordan", "Good", 2001, 2002), ("Michael Jordan", "Bad", 2003, 2003), ("Someone Else", "Bad", 2003, 2003)]
    )


def test_monthly_hits_job(spark):
    df = spark.createDataFrame(
        [("2023-03-01", [0, 1, 3], "2023-03-01"), ("2023-03-01", [1, 2, 3], "2023-03-01")],
        "month_start string, hit_array array<bigint>, date_partition string",
    )
    out = jobs.monthly_user_site_hits_transformation(spark, df, "2023-03-01")
    assert rows(out) == [("2023-03-01", 1, 3, 6)]


def test_team_jobs(spark):
    teams = spark.createDataFrame(
        [(1, "GSW", "Warriors", "SF", "Chase", 1900), (1, "GSW", "Warriors", "SF", "Chase", 1900), (2, "LAL", "Lakers", "LA", "Crypto", 1947)],
        "team_id bigint, abbreviation string, nickname string, city string, arena string, yearfounded bigint",
    )
    assert {r.identifier for r in jobs.team_vertex_transformation(spark, teams, order=["nickname"]).collect()} == {1, 2}
    counts = {r.team_id: r.row_num for r in jobs.team_deduped_transformation(spark, teams).collect()}
    assert counts == {1: 2, 2: 1}


def test_defined_table_overwrites_only_written_partitions(spark):
    import datetime as dt

    from tallyfold.schemas import define_table

    tag = uuid.uuid4().hex[:8]
    name = define_table(
        spark, "hosts_cumulated", location=scratch_path(spark, f"jobs/hosts_{tag}"), table_name=f"hosts_cumulated_{tag}"
    )
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    cols = spark.table(name).columns
    day1 = spark.createDataFrame([("a", [d1], d1)], "host_name string, host_activity_datelist array<date>, date date")
    day2 = spark.createDataFrame([("a", [d1, d2], d2)], "host_name string, host_activity_datelist array<date>, date date")
    day1.select(*cols).write.insertInto(name, overwrite=True)
    day2.select(*cols).write.insertInto(name, overwrite=True)
    day2.select(*cols).write.insertInto(name, overwrite=True)  # rerun of day 2
    got = sorted((r.date, len(r.host_activity_datelist)) for r in spark.table(name).collect())
    assert got == [(d1, 1), (d2, 2)]
