"""Late facts: films of past years that arrive after their year was loaded.

Only the actors they name are worked on.  Of the history (O4, O5) only the
intervals change whose value the late films change: :func:`late_actor_patches`
computes them from the films of those years and :func:`scd2_splice` puts them
in, splitting the rows they cut and merging rows that become equal.  Of the
snapshots (O1) the rows of those actors are made anew.

Laws: the spliced history equals the full backfill with the late films among
the facts, and so do the snapshots.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.classify import QUALITY_BANDS, QUALITY_DEFAULT, band
from tallyfold.functions.keys import require_keys
from tallyfold.operators.cumulate import actors_backfill
from tallyfold.plans.joins import join_small
from tallyfold.sources.keyed import KeyedTable


def scd2_splice(
    history: DataFrame,
    patches: DataFrame,
    keys: Sequence[str],
    attrs: Sequence[str],
    carry: Sequence[str] = (),
    start_col: str = "start_period",
    end_col: str = "end_period",
) -> DataFrame:
    """``history`` with the intervals of ``patches`` (of integer periods, both
    ends included, disjoint within a key) holding the patches' attributes.

    A row that a patch covers partly keeps the rest of its interval, on one or
    both sides; neighbouring intervals of equal attributes (NULLs equal) become
    one row.  Rows of keys without a patch pass through.  ``carry`` columns
    take the value at the key's earliest interval.  A key's patches and rows
    are at most one per period, so what is collected per key is small.  Other
    columns of ``history`` (as-of marks) are kept for keys without a patch and
    must be the same in all rows.
    """
    keys, attrs, carry = list(keys), list(attrs), list(carry)
    history, patches = require_keys(history, keys, "the history"), require_keys(patches, keys, "the patches")
    columns = [*keys, *carry, *attrs, start_col, end_col]
    cuts = patches.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(start_col).alias("s"), F.col(end_col).alias("e")))).alias("_cuts"))
    same = join_small(history, cuts.select(*keys), keys, "left_anti")
    cut = join_small(history.select(*columns), cuts, keys)
    # What is left of a row: the stretches before, between and after its key's
    # patches, as far as they lie inside the row.
    first, last = F.col(start_col), F.col(end_col)
    lows = F.concat(F.array(first), F.transform("_cuts", lambda c: c["e"] + 1))
    highs = F.concat(F.transform("_cuts", lambda c: c["s"] - 1), F.array(last))
    rest = F.transform(
        F.arrays_zip(lows.alias("lo"), highs.alias("hi")),
        lambda z: F.struct(F.greatest(z["lo"], first).alias("lo"), F.least(z["hi"], last).alias("hi")),
    )
    rest = F.filter(rest, lambda z: z["lo"] <= z["hi"])
    kept = cut.select(*keys, *carry, *attrs, F.inline(rest).alias(start_col, end_col))
    pieces = kept.unionByName(patches.select(*columns))

    w = Window.partitionBy(*keys).orderBy(start_col)
    equal = reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.lag(a).over(w)) for a in attrs])
    starts = F.lag(end_col).over(w).isNull() | ~equal | (F.col(start_col) > F.lag(end_col).over(w) + 1)
    run = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    earliest = [F.first(c).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(c) for c in carry]
    islands = pieces.withColumn("_new", starts.cast("int")).select(*keys, *earliest, *attrs, start_col, end_col, run.alias("_run"))
    spliced = islands.groupBy(*keys, "_run", *carry, *attrs).agg(F.min(start_col).alias(start_col), F.max(end_col).alias(end_col))
    rest_cols = [c for c in history.columns if c not in columns]
    marks = history.groupBy().agg(*[F.max(c).alias(c) for c in rest_cols]) if rest_cols else None
    for c in rest_cols:
        spliced = spliced.withColumn(c, marks.select(c).scalar())
    return same.unionByName(spliced.select(*history.columns))


def late_actor_patches(history: DataFrame, actor_films: DataFrame, late: DataFrame, as_of: int) -> DataFrame:
    """The intervals of ``actors_history_scd`` that ``late`` films (rows of
    ``actor_films``, which holds all films) change.

    A year with late films is an active year with the class of all its films;
    the inactive years that follow it, up to the actor's next active year, take
    that class.  Active years are read from the history itself, so only films
    of the late (actor, year) pairs are read.  Films after ``as_of`` are not
    late.
    """
    late = require_keys(late.where(F.col("year") <= F.lit(as_of)), ["actorid"], "late films")
    pairs = late.select("actorid", "year").distinct()
    films = join_small(actor_films.select("actorid", "year", "actor", "rating"), pairs, ["actorid", "year"], "left_semi")
    yearly = films.groupBy("actorid", "year").agg(
        F.min("actor").alias("actor"), band(F.avg("rating"), QUALITY_BANDS, QUALITY_DEFAULT).alias("quality_class")
    )
    years = yearly.groupBy("actorid").agg(F.collect_list(F.struct("year", "actor", "quality_class")).alias("_late"))
    # One row per late actor, at most one entry per year.
    active = join_small(history.where("is_active").select("actorid", "start_year", "end_year"), years.select("actorid"), "actorid", "left_semi")
    spans = active.groupBy("actorid").agg(F.collect_list(F.struct("start_year", "end_year")).alias("_spans"))
    known = years.join(spans, "actorid", "left").select("actorid", "_spans", "_late", F.explode("_late").alias("_y"))
    year = F.col("_y.year")
    later = F.concat(
        F.transform(F.filter("_spans", lambda s: s["end_year"] > year), lambda s: F.greatest(s["start_year"], year + 1)),
        F.transform(F.filter("_late", lambda y: y["year"] > year), lambda y: y["year"]),
    )
    later = F.when(F.col("_spans").isNull(), F.transform(F.filter("_late", lambda y: y["year"] > year), lambda y: y["year"])).otherwise(later)
    until = F.coalesce(F.array_min(later) - 1, F.lit(as_of))
    row = lambda active, lo, hi: F.struct(
        F.lit(active).alias("is_active"), lo.cast("int").alias("start_year"), hi.cast("int").alias("end_year")
    )
    both = F.filter(F.array(row(True, year, year), row(False, year + 1, until)), lambda r: r["start_year"] <= r["end_year"])
    return known.select("actorid", F.col("_y.actor").alias("actor"), F.col("_y.quality_class").alias("quality_class"), F.inline(both))


def splice_actor_history(history: DataFrame, actor_films: DataFrame, late: DataFrame, as_of: int) -> DataFrame:
    """``actors_history_scd`` as of ``as_of`` with late films taken in."""
    patches = late_actor_patches(history, actor_films, late, as_of)
    return scd2_splice(history, patches, ["actorid"], ["quality_class", "is_active"], ["actor"], "start_year", "end_year")


def reload_actors(snapshots: KeyedTable, actor_films: DataFrame, late: DataFrame, as_of: int) -> list[int]:
    """Make the snapshots of the actors with late films anew, in a snapshot table
    keyed by ``actorid``; returns the buckets that were rewritten.  All other
    buckets keep their files."""
    late = require_keys(late.where(F.col("year") <= F.lit(as_of)), ["actorid"], "late films")
    actors = late.select("actorid").distinct()
    films = join_small(actor_films, actors, "actorid", "left_semi")
    return snapshots.replace_keys(actors, actors_backfill(films, as_of))
