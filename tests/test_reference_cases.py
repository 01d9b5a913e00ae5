"""The reference's four unit-test cases, re-typed (FIXTURES.md section 1),
compared without depending on row order."""

from support import rows

from tallyfold.operators.activity import positional_sums
from tallyfold.operators.dedupe import dedupe_counted
from tallyfold.operators.graph import team_vertex
from tallyfold.operators.scd import scd2_backfill


def test_player_scd(spark):
    players = spark.createDataFrame(
        [
            ("Michael Jordan", 2001, "Good"),
            ("Michael Jordan", 2002, "Good"),
            ("Michael Jordan", 2003, "Bad"),
            ("Someone Else", 2003, "Bad"),
        ],
        "player_name string, current_season bigint, scoring_class string",
    )
    out = scd2_backfill(
        players, ["player_name"], "current_season", ["scoring_class"], start_col="start_date", end_col="end_date", as_of_col=None
    )
    assert out.columns == ["player_name", "scoring_class", "start_date", "end_date"]
    assert rows(out) == sorted(
        [
            ("Michael Jordan", "Good", 2001, 2002),
            ("Michael Jordan", "Bad", 2003, 2003),
            ("Someone Else", "Bad", 2003, 2003),
        ]
    )


def test_monthly_site_hits(spark):
    ds = "2023-03-01"
    df = spark.createDataFrame(
        [(ds, [0, 1, 3], ds), (ds, [1, 2, 3], ds), ("2023-04-01", [], ds), ("2023-04-01", [], "")],
        "month_start string, hit_array array<bigint>, date_partition string",
    )
    out = positional_sums(df, ds)
    assert out.columns == ["month_start", "num_hits_first_day", "num_hits_second_day", "num_hits_third_day"]
    assert rows(out) == [("2023-03-01", 1, 3, 6), ("2023-04-01", 0, 0, 0)]


def test_team_vertex(spark):
    teams = spark.createDataFrame(
        [
            (1, "GSW", "Warriors", "San Francisco", "Chase Center", 1900),
            (1, "GSW", "Bad Warriors", "San Francisco", "Chase Center", 1900),
        ],
        "team_id bigint, abbreviation string, nickname string, city string, arena string, yearfounded bigint",
    )
    from pyspark.sql import functions as F

    out = team_vertex(teams, order=[F.col("nickname").desc()])
    got = out.collect()
    assert len(got) == 1
    r = got[0]
    assert (r.identifier, r.type) == (1, "team")
    assert r.properties == {
        "abbreviation": "GSW",
        "nickname": "Warriors",
        "city": "San Francisco",
        "arena": "Chase Center",
        "year_founded": "1900",
    }
    assert out.schema["properties"].dataType.simpleString() == "map<string,string>"


def test_team_dedup_with_count(spark):
    teams = spark.createDataFrame(
        [
            ("141578", "LA", "48", "52"),
            ("459826", "CA", "79", "21"),
            ("141578", "LA", "48", "52"),
            ("141578", "LA", "48", "52"),
            ("254781", "TA", "99", "1"),
        ],
        "team_id string, city string, team_wins string, team_losts string",
    )
    out = dedupe_counted(teams, ["team_id"])
    assert out.columns == ["team_id", "city", "team_wins", "team_losts", "row_num"]
    assert rows(out) == sorted(
        [("141578", "LA", "48", "52", 3), ("459826", "CA", "79", "21", 1), ("254781", "TA", "99", "1", 1)]
    )
