"""Late films: spliced histories and reloaded snapshots equal full backfills."""

import random

import pytest
from support import rows

from tallyfold.operators import cumulate, late, scd
from tallyfold.plans.explain import plan_text
from tallyfold.session import scratch_path
from tallyfold.sources.keyed import KeyedTable

FILMS = "actor string, actorid string, film string, year int, votes int, rating double, filmid string"
LAST = 2010


def _films(rng, n_actors, n, ident):
    out = []
    for k in range(n):
        a, y = rng.randrange(n_actors), rng.randrange(2000, LAST + 2)
        out.append((f"A{a}" if rng.random() < 0.9 else f"Z{a}", str(a), f"f{k}", y, 1, rng.choice([5.0, 6.5, 7.5, 9.0, None]), f"{ident}{k:04d}"))
    return out


def _history(films):
    snaps = cumulate.actors_backfill(films, LAST)
    return scd.scd2_backfill(
        snaps, ["actorid"], "current_year", ["quality_class", "is_active"], as_of=LAST, carry=["actor"], start_col="start_year", end_col="end_year", as_of_col="current_year"
    )


@pytest.mark.parametrize("seed", range(4))
def test_splice_and_reload_equal_the_backfill(spark, seed):
    rng = random.Random(seed)
    early, later = _films(rng, 12, 40, "e"), _films(rng, 14, (1, 4, 15, 60)[seed], "l")
    on_time, late_rows = spark.createDataFrame(early, FILMS), spark.createDataFrame(later, FILMS)
    both = spark.createDataFrame(early + later, FILMS)
    want = _history(both)
    got = late.splice_actor_history(_history(on_time), both, late_rows, LAST)
    assert rows(got.select(*want.columns)) == rows(want)
    table = KeyedTable.create(cumulate.actors_backfill(on_time, LAST), scratch_path(spark, "late-test"), ["actorid"], 8)
    touched = late.reload_actors(table, both, late_rows, LAST)
    assert set(touched) <= set(range(8))
    full = cumulate.actors_backfill(both, LAST)
    assert rows(table.rows().select(*full.columns)) == rows(full)


def test_splice_splits_and_merges(spark):
    history = spark.createDataFrame(
        [("a", "x", 1, 9), ("b", "x", 1, 3), ("b", "y", 4, 5), ("b", "x", 6, 9), ("c", None, 2, 4), ("d", "q", 1, 9)],
        "k string, c string, start_period int, end_period int",
    )
    patches = spark.createDataFrame(
        [("a", "y", 4, 5), ("b", "x", 4, 5), ("c", None, 5, 6), ("c", "z", 1, 1), ("a", "x", 9, 9), ("e", "n", 3, 3)],
        "k string, c string, start_period int, end_period int",
    )
    out = late.scd2_splice(history, patches, ["k"], ["c"])
    want = [("a", "x", 1, 3), ("a", "y", 4, 5), ("a", "x", 6, 9), ("b", "x", 1, 9), ("c", "z", 1, 1), ("c", None, 2, 6), ("d", "q", 1, 9), ("e", "n", 3, 3)]
    assert rows(out) == rows(spark.createDataFrame(want, history.schema))


def test_no_late_films_change_nothing(spark):
    rng = random.Random(3)
    films = spark.createDataFrame(_films(rng, 5, 20, "e"), FILMS)
    history = _history(films)
    assert rows(late.splice_actor_history(history, films, films.limit(0), LAST)) == rows(history)
    # Films after the history's last year are for the next load.
    assert rows(late.splice_actor_history(history, films, films.where(f"year > {LAST}"), LAST)) == rows(history)


def test_facts_are_read_through_the_late_pairs(spark):
    """The films that reach the aggregate are those of the late actor-years,
    by a broadcast semi-join below it: no exchange of all films."""
    films = spark.createDataFrame(_films(random.Random(5), 30, 500, "e"), FILMS)
    text = plan_text(late.late_actor_patches(_history(films), films, films.limit(3), LAST), "simple")
    assert "BroadcastHashJoin" in text and "LeftSemi" in text
