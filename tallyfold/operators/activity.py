"""Activity facts: bitmasks (O9), monthly reduced facts (O11), positional
sums (O12) and lifecycle states (O13)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tallyfold.functions.arrays import append_if, pad_and_append, safe_get
from tallyfold.functions.bits import advance_bits, bit_flag, bits_text, datelist_bits, n_words, wide_bits
from tallyfold.functions.keys import require_keys
from tallyfold.operators.cumulate import _day_bounds, _up_to

# --------------------------------------------------------------------------
# O9 date list -> bits
# --------------------------------------------------------------------------


def datelist_to_bits(
    snapshot: DataFrame,
    keys: Sequence[str],
    list_col: str,
    end_date: dt.date,
    n_days: int = 10,
    week_days: int = 7,
    snapshot_col: str | None = "date",
) -> DataFrame:
    """Bitmask of the last ``n_days`` days per key (rows of a key, e.g. one
    per browser, are OR-ed), plus last-day and last-week flags.  The newest
    day is the highest bit."""
    src = snapshot.where(F.col(snapshot_col) == F.lit(end_date)) if snapshot_col else snapshot
    bits = datelist_bits(F.col(list_col), F.lit(end_date), n_days)
    agg = src.groupBy(*keys).agg(F.bit_or(bits).alias("datelist_int"))
    last_day = 1 << (n_days - 1)
    last_week = ((1 << min(week_days, n_days)) - 1) << (n_days - min(week_days, n_days))
    return agg.select(
        *keys,
        "datelist_int",
        bits_text(F.col("datelist_int"), n_days).alias("datelist_bits"),
        bit_flag(F.col("datelist_int"), last_day).alias("last_day_active"),
        bit_flag(F.col("datelist_int"), last_week).alias("last_week_active"),
    )


def wide_activity(snapshot: DataFrame, keys: Sequence[str], list_col: str, end_date: dt.date, n_days: int, snapshot_col: str | None = "date") -> DataFrame:
    """O9 for windows of any length: per key the window's ``words`` (see
    :func:`tallyfold.functions.bits.wide_bits`; rows of a key are OR-ed) and
    ``date``, the day they end."""
    src = snapshot.where(F.col(snapshot_col) == F.lit(end_date)) if snapshot_col else snapshot
    words = require_keys(src, keys, "date lists").select(*keys, wide_bits(F.col(list_col), F.lit(end_date), n_days).alias("_w"))
    each = [F.bit_or(F.get("_w", F.lit(w))).alias(f"_w{w}") for w in range(n_words(n_days))]
    merged = words.groupBy(*keys).agg(*each)
    return merged.select(*keys, F.array(*[f"_w{w}" for w in range(n_words(n_days))]).alias("words"), F.lit(end_date).alias("date"))


def advance_activity(prev: DataFrame, active: DataFrame, keys: Sequence[str], day: dt.date, n_days: int) -> DataFrame:
    """The windows of ``day`` from those of the day before and the keys active
    on ``day``: one shift with carry, no date list is read.  Keys whose window
    becomes empty are kept; they had days before."""
    keys = list(keys)
    y = require_keys(prev.where(F.col("date") == F.lit(day - dt.timedelta(days=1))), keys, "windows")
    t = require_keys(active.select(*keys).distinct(), keys, "active keys").withColumn("_active", F.lit(True))
    j = y.join(t, keys, "full_outer")
    empty = F.array_repeat(F.lit(0).cast("bigint"), n_words(n_days))
    words = advance_bits(F.coalesce(F.col("words"), empty), F.col("_active"), n_days)
    return j.select(*keys, words.alias("words"), F.lit(day).alias("date"))


# --------------------------------------------------------------------------
# O11 monthly reduced facts
# --------------------------------------------------------------------------


def daily_activity(events: DataFrame, day_filter: Column, key: str = "host") -> DataFrame:
    """Per key and day: hits = COUNT(*), visitors = COUNT(DISTINCT user_id).
    Both combine map-side, so a hot key is pre-aggregated before the shuffle."""
    return (
        events.where(day_filter & F.col(key).isNotNull())
        .groupBy(key, F.to_date("event_time").alias("day"))
        .agg(F.count(F.lit(1)).alias("hits"), F.countDistinct("user_id").alias("visitors"))
    )


def reduce_monthly(prev: DataFrame | None, events: DataFrame, day: dt.date, key: str = "host") -> DataFrame:
    """O11 step for ``day``: one row per key and month whose arrays hold, at
    index i, the value of day i+1.  Silent days and keys first seen
    mid-month are zero-padded.  Rerunning any day replaces that day's slot and
    leaves every other day as it is, later days included (a key new in the
    rerun gets zeros for them, as its month's other keys have values there).
    """
    month = day.replace(day=1)
    dom = day.day
    today = daily_activity(events, _day_bounds(day), key).alias("t")
    if prev is None:
        prev = today.sparkSession.createDataFrame(
            [], f"{key} {events.schema[key].dataType.simpleString()}, hit_array array<bigint>, unique_visitors array<bigint>, month_start date"
        )
    loaded = require_keys(prev.where(F.col("month_start") == F.lit(month)), [key], "monthly facts")
    y = loaded.alias("y")
    j = y.join(today, F.col(f"y.{key}") == F.col(f"t.{key}"), "full_outer")
    # Days of the month loaded so far (rows of a month have equal lengths).
    through = F.coalesce(loaded.agg(F.max(F.size("hit_array"))).scalar(), F.lit(0))

    def upd(arr: str, val: str) -> Column:
        old = F.coalesce(F.col(f"y.{arr}"), F.array().cast("array<bigint>"))
        upto = pad_and_append(F.slice(old, 1, dom - 1), F.lit(dom - 1), F.coalesce(F.col(f"t.{val}"), F.lit(0)))
        rest = F.slice(old, dom + 1, F.greatest(F.size(old) - dom, F.lit(0)))
        none = F.array_repeat(F.lit(0).cast("bigint"), F.greatest(through - dom - F.size(rest), F.lit(0)))
        return F.concat(upto, rest, none)

    return j.select(
        F.coalesce(f"t.{key}", f"y.{key}").alias(key),
        upd("hit_array", "hits").alias("hit_array"),
        upd("unique_visitors", "visitors").alias("unique_visitors"),
        F.lit(month).alias("month_start"),
    )


def reduce_monthly_backfill(events: DataFrame, as_of: dt.date, key: str = "host") -> DataFrame:
    """O11 closed form: all monthly rows as of ``as_of`` in one pass.  A
    past month's arrays cover the whole month; the current month's cover
    days 1..as_of."""
    daily = daily_activity(events, _up_to(as_of), key)
    monthly = daily.groupBy(key, F.trunc("day", "month").alias("month_start")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.dayofmonth("day"), F.col("hits")))).alias("_h"),
        F.map_from_entries(F.collect_list(F.struct(F.dayofmonth("day"), F.col("visitors")))).alias("_v"),
    )
    cur_month = as_of.replace(day=1)
    length = F.when(F.col("month_start") == F.lit(cur_month), F.lit(as_of.day)).otherwise(
        F.dayofmonth(F.last_day("month_start"))
    )
    days = F.sequence(F.lit(1), length)
    return monthly.select(
        key,
        F.transform(days, lambda i: F.coalesce(F.col("_h")[i], F.lit(0).cast("bigint"))).alias("hit_array"),
        F.transform(days, lambda i: F.coalesce(F.col("_v")[i], F.lit(0).cast("bigint"))).alias("unique_visitors"),
        "month_start",
    )


# Accuracy of the day sketches: 2^12 registers, a standard error of about 1.6 %.
SKETCH_LG_K = 12


def _daily_sketches(events: DataFrame, day_filter: Column, key: str, lg_k: int) -> DataFrame:
    return (
        events.where(day_filter & F.col(key).isNotNull())
        .groupBy(key, F.to_date("event_time").alias("day"))
        .agg(F.hll_sketch_agg(F.col("user_id"), F.lit(lg_k)).alias("_sketch"))
    )


def reduce_monthly_sketches(prev: DataFrame | None, events: DataFrame, day: dt.date, key: str = "host", lg_k: int = SKETCH_LG_K) -> DataFrame:
    """O11's layout with a mergeable sketch of the visitors in each day's slot
    (NULL on a silent day), so that distinct visitors of any range of days come
    from the reduced table (:func:`visitors_between`): counts of single days
    cannot be added up.  Rerunning a day replaces its slot and no other."""
    month, dom = day.replace(day=1), day.day
    today = _daily_sketches(events, _day_bounds(day), key, lg_k).alias("t")
    if prev is None:
        prev = today.sparkSession.createDataFrame(
            [], f"{key} {events.schema[key].dataType.simpleString()}, sketch_array array<binary>, month_start date"
        )
    y = require_keys(prev.where(F.col("month_start") == F.lit(month)), [key], "monthly sketches").alias("y")
    j = y.join(today, F.col(f"y.{key}") == F.col(f"t.{key}"), "full_outer")
    old = F.coalesce(F.col("y.sketch_array"), F.array().cast("array<binary>"))
    length = F.greatest(F.size(old), F.lit(dom))
    slots = F.transform(F.sequence(F.lit(1), length), lambda i: F.when(i == dom, F.col("t._sketch")).otherwise(F.get(old, i - 1)))
    return j.select(F.coalesce(f"t.{key}", f"y.{key}").alias(key), slots.alias("sketch_array"), F.lit(month).alias("month_start"))


def reduce_monthly_sketches_backfill(events: DataFrame, as_of: dt.date, key: str = "host", lg_k: int = SKETCH_LG_K) -> DataFrame:
    """All monthly rows as of ``as_of``; a month's array ends at the key's last
    active day."""
    daily = _daily_sketches(events, _up_to(as_of), key, lg_k)
    monthly = daily.groupBy(key, F.trunc("day", "month").alias("month_start")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.dayofmonth("day"), F.col("_sketch")))).alias("_s"), F.max(F.dayofmonth("day")).alias("_n")
    )
    return monthly.select(key, F.transform(F.sequence(F.lit(1), F.col("_n")), lambda i: F.col("_s")[i]).alias("sketch_array"), "month_start")


def visitors_between(monthly: DataFrame, first: dt.date, last: dt.date, key: str = "host") -> DataFrame:
    """About how many distinct visitors each key had from ``first`` to ``last``,
    from the sketches of those days alone (months outside are pruned)."""
    months = monthly.where((F.col("month_start") >= F.lit(first.replace(day=1))) & (F.col("month_start") <= F.lit(last)))
    days = months.select(key, "month_start", F.posexplode("sketch_array").alias("_i", "_sketch")).where(F.col("_sketch").isNotNull())
    day = F.date_add("month_start", F.col("_i"))
    union = days.where(day.between(F.lit(first), F.lit(last))).groupBy(key).agg(F.hll_union_agg("_sketch").alias("_all"))
    return union.select(key, F.hll_sketch_estimate("_all").alias("visitors"))


# --------------------------------------------------------------------------
# O12 positional sums
# --------------------------------------------------------------------------

# Fixed output names of the reference job for positions 0, 1, 2.
POSITION_NAMES = ("num_hits_first_day", "num_hits_second_day", "num_hits_third_day")


def positional_sums(
    df: DataFrame,
    ds: str,
    array_col: str = "hit_array",
    positions: Sequence[int] = (0, 1, 2),
    names: Sequence[str] = POSITION_NAMES,
    group_col: str = "month_start",
    partition_col: str = "date_partition",
) -> DataFrame:
    """Rows of partition ``ds``: per group, the sum of array element i for
    each position; absent or NULL elements count as 0.  ``ds`` is bound as a
    literal, never spliced into SQL text."""
    return (
        df.where(F.col(partition_col) == F.lit(ds))
        .groupBy(group_col)
        .agg(
            *[
                F.sum(F.coalesce(safe_get(F.col(array_col), p), F.lit(0))).cast("bigint").alias(n)
                for p, n in zip(positions, names)
            ]
        )
    )


# --------------------------------------------------------------------------
# O13 lifecycle states
# --------------------------------------------------------------------------

# Fixed labels of the reference's state machine.
NEW = "New"
CONTINUED = "Continued Playing"
RETURNED = "Returned from Retirement"
RETIRED = "Retired"
STAYED_RETIRED = "Stayed Retired"


def track_states(prev: DataFrame | None, actives: DataFrame, season: int, key: str = "player_name") -> DataFrame:
    """O13 step: ``actives`` has one row per (key, current_season) in which
    the key was active; ``prev`` is last season's growth table.  A NULL key is
    refused, here and in the closed form."""
    t = actives.where(F.col("current_season") == F.lit(season)).select(key, "current_season").distinct()
    t = require_keys(t, [key], "active seasons").alias("t")
    if prev is None:
        prev = t.sparkSession.createDataFrame(
            [],
            f"{key} string, first_active_season int, last_active_season int, activity_state string, seasons_active array<int>, season int",
        )
    y = require_keys(prev.where(F.col("season") == F.lit(season - 1)), [key], "growth").alias("y")
    j = y.join(t, F.col(f"y.{key}") == F.col(f"t.{key}"), "full_outer")
    t_season = F.col("t.current_season")
    state = (
        F.when(F.col(f"y.{key}").isNull(), F.lit(NEW))
        .when(F.col("y.last_active_season") == t_season - 1, F.lit(CONTINUED))
        .when(F.col("y.last_active_season") < t_season - 1, F.lit(RETURNED))
        .when(F.col(f"t.{key}").isNull() & (F.col("y.last_active_season") == F.col("y.season")), F.lit(RETIRED))
        .otherwise(F.lit(STAYED_RETIRED))
    )
    return j.select(
        F.coalesce(f"t.{key}", f"y.{key}").alias(key),
        F.coalesce("y.first_active_season", "t.current_season").cast("int").alias("first_active_season"),
        F.coalesce("t.current_season", "y.last_active_season").cast("int").alias("last_active_season"),
        state.alias("activity_state"),
        append_if(F.col("y.seasons_active"), F.col(f"t.{key}").isNotNull(), t_season.cast("int"), IntegerType()).alias(
            "seasons_active"
        ),
        F.coalesce(t_season, F.col("y.season") + 1).cast("int").alias("season"),
    )


def states_backfill(actives: DataFrame, as_of: int, key: str = "player_name") -> DataFrame:
    """O13 closed form: the growth rows of every season up to ``as_of``.

    Each active season a expands to a, a+1, ..., (next active - 1): season a
    is New / Continued / Returned by the gap to the previous active season,
    a+1 is Retired, later ones Stayed Retired.
    """
    a = require_keys(actives.where(F.col("current_season") <= F.lit(as_of)), [key], "active seasons").select(
        key, F.col("current_season").cast("int").alias("a")
    ).distinct()
    w = Window.partitionBy(key).orderBy("a")
    upto = Window.partitionBy(key).orderBy("a").rowsBetween(Window.unboundedPreceding, 0)
    rows = a.select(
        key,
        "a",
        F.lag("a").over(w).alias("prev_a"),
        F.coalesce(F.lead("a").over(w) - 1, F.lit(as_of)).alias("last"),
        F.first("a").over(upto).alias("first_active_season"),
        F.collect_list("a").over(upto).alias("seasons_active"),
    )
    ex = rows.withColumn("season", F.explode(F.sequence("a", "last")))
    s = F.col("season")
    state = (
        F.when((s == F.col("a")) & F.col("prev_a").isNull(), F.lit(NEW))
        .when((s == F.col("a")) & (F.col("prev_a") == s - 1), F.lit(CONTINUED))
        .when(s == F.col("a"), F.lit(RETURNED))
        .when(s == F.col("a") + 1, F.lit(RETIRED))
        .otherwise(F.lit(STAYED_RETIRED))
    )
    return ex.select(
        key,
        F.col("first_active_season").cast("int"),
        F.col("a").alias("last_active_season"),
        state.alias("activity_state"),
        "seasons_active",
        s.cast("int").alias("season"),
    )
