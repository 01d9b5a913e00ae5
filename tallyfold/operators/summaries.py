"""Rolling wins (O17) and scoring streaks (O18) as mergeable summaries.

The games of a team or player, in order, are cut into ranges; each range is
summed up in a row of bounded size, and two neighbouring summaries merge into
that of both ranges.  One shuffle deals the games out by ranges of
``(key, date, game)``, so a key with very many games is many ranges in many
tasks; a second one moves only the summaries, at most one per key and range.
The merged summary is a state that can be stored: later games are summed up
by themselves and merged in, without reading the earlier ones.

A streak's summary is the number of games, of qualifying games at the start and
at the end, and the longest run.  That of a stretch is the number of games, the
first and last ``stretch - 1`` results, and the most wins in a stretch.

Both refuse games on or before the last day of the state (``through``): such a
game would belong inside a range that is summed up already.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.keys import require_keys

# A summary is (games, start, end, best, first day, last day).
Summary = tuple


def _streak_of(q: np.ndarray, days: tuple) -> Summary:
    breaks = np.flatnonzero(q == 0)
    if not len(breaks):
        return (len(q), len(q), len(q), len(q), *days)
    inner = np.diff(breaks).max(initial=1) - 1
    start, end = int(breaks[0]), len(q) - 1 - int(breaks[-1])
    return (len(q), start, end, max(start, end, int(inner)), *days)


def _merge_streaks(a: Summary, b: Summary) -> Summary:
    start = a[1] if a[1] < a[0] else a[0] + b[1]
    end = b[2] if b[2] < b[0] else b[0] + a[2]
    return (a[0] + b[0], start, end, max(a[3], b[3], a[2] + b[1]), a[4], b[5])


def _most(results: np.ndarray, stretch: int) -> int:
    total = np.concatenate([[0], np.cumsum(results)])
    n = min(stretch, len(results))
    return int((total[n:] - total[: len(total) - n]).max(initial=0))


def _stretch_of(stretch: int) -> Callable[[np.ndarray, tuple], Summary]:
    keep = stretch - 1

    def of(won: np.ndarray, days: tuple) -> Summary:
        return (len(won), won[:keep].tolist(), won[max(0, len(won) - keep) :].tolist(), _most(won, stretch), *days)

    return of


def _merge_stretches(stretch: int) -> Callable[[Summary, Summary], Summary]:
    keep = stretch - 1

    def merge(a: Summary, b: Summary) -> Summary:
        # A stretch over the border ends in a's last and begins b's first games.
        across = _most(np.array([*a[2], *b[1]], np.int64), stretch)
        first, last = [*a[1], *b[1]] if a[0] < keep else a[1], [*a[2], *b[2]] if b[0] < keep else b[2]
        return (a[0] + b[0], first[:keep], last[max(0, len(last) - keep) :], max(a[3], b[3], across), a[4], b[5])

    return merge


def _columns(kind: str) -> str:
    return f"games bigint, start {kind}, end {kind}, best bigint, since date, through date"


_FIELDS = ["games", "start", "end", "best", "since", "through"]


def _summaries(games: DataFrame, key: str, value: str, kind: str, of, merge, n_partitions: int | None) -> DataFrame:
    """One summary a key and range: (key, ``_range``, summary)."""
    n = n_partitions or int(games.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = require_keys(games, [key], "games").select(key, "game_date", "game_id", F.col(value).cast("bigint").alias("_v"))
    ranged = rows.repartitionByRange(n, key, "game_date", "game_id").sortWithinPartitions(key, "game_date", "game_id")
    ranged = ranged.select(key, "game_date", "_v", F.spark_partition_id().alias("_range"))
    schema = f"{key} {games.schema[key].dataType.simpleString()}, _range int, {_columns(kind)}"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, open_range, so_far, done, types = None, 0, None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            types = batch.schema.field(0).type
            keys = batch.column(0)
            codes = keys.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            values = batch.column(2).to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], np.flatnonzero(codes[1:] != codes[:-1]) + 1, [len(codes)]]).tolist()
            for a, b in zip(bounds, bounds[1:]):
                own = of(values[a:b], (batch.column(1)[a].as_py(), batch.column(1)[b - 1].as_py()))
                k = keys[a].as_py()
                if so_far is not None and k == open_key:
                    so_far = merge(so_far, own)
                else:
                    if so_far is not None:
                        done.append((open_key, open_range, *so_far))
                    open_key, open_range, so_far = k, batch.column(3)[a].as_py(), own
            if len(done) > 2000:
                yield _batch(done, key, types, kind)
                done = []
        if so_far is not None:
            yield _batch([*done, (open_key, open_range, *so_far)], key, types, kind)

    return ranged.mapInArrow(walk, schema)


def _batch(rows: list[tuple], key: str, key_type: pa.DataType, kind: str, ranged: bool = True) -> pa.RecordBatch:
    side = pa.list_(pa.int8()) if kind.startswith("array") else pa.int64()
    types = [key_type, *([pa.int32()] if ranged else []), pa.int64(), side, side, pa.int64(), pa.date32(), pa.date32()]
    names = [key, *(["_range"] if ranged else []), *_FIELDS]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


# The range of a stored state: before all others.
_STATE = -1


def _merged(summaries: DataFrame, key: str, kind: str, merge) -> DataFrame:
    """Summaries of a key merged in the order of their ranges."""
    dealt = summaries.repartition(key).sortWithinPartitions(key, "_range").select(key, "_range", *_FIELDS)
    schema = f"{key} {summaries.schema[key].dataType.simpleString()}, {_columns(kind)}"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, after_state, so_far, done, types = None, False, None, [], None
        for batch in batches:
            types = batch.schema.field(0).type
            for k, r, *own in zip(*(c.to_pylist() for c in batch.columns)):
                if so_far is not None and k == open_key:
                    if after_state and own[4] <= so_far[5]:
                        raise ValueError(f"game of {own[4]} of {k!r}: the state holds all games up to {so_far[5]}")
                    so_far, after_state = merge(so_far, tuple(own)), False
                else:
                    if so_far is not None:
                        done.append((open_key, *so_far))
                    open_key, after_state, so_far = k, r == _STATE, tuple(own)
            if len(done) > 2000:
                yield _batch(done, key, types, kind, False)
                done = []
        if so_far is not None:
            yield _batch([*done, (open_key, *so_far)], key, types, kind, False)

    return dealt.mapInArrow(walk, schema)


def _state(games: DataFrame, key: str, value: str, kind: str, of, merge, state: DataFrame | None, n_partitions: int | None) -> DataFrame:
    new = _summaries(games, key, value, kind, of, merge, n_partitions)
    if state is not None:
        new = state.select(key, F.lit(_STATE).alias("_range"), *_FIELDS).unionByName(new)
    return _merged(new, key, kind, merge)


def streak_state(player_games: DataFrame, min_points: float = 10, state: DataFrame | None = None, n_partitions: int | None = None) -> DataFrame:
    """One summary a player of the games (``player_id, game_id, game_date, pts``),
    merged onto an earlier ``state`` if there is one.  A game counts with more
    than ``min_points``; NULL points do not."""
    qualifies = F.coalesce((F.col("pts") > F.lit(min_points)).cast("int"), F.lit(0))
    games = player_games.withColumn("_q", qualifies)
    return _state(games, "player_id", "_q", "bigint", _streak_of, _merge_streaks, state, n_partitions)


def longest_streaks(state: DataFrame) -> DataFrame:
    """O18 from the state: no run counts as one of length zero."""
    return state.select("player_id", F.col("best").alias("longest_streak"))


def stretch_state(team_games: DataFrame, stretch: int = 90, state: DataFrame | None = None, n_partitions: int | None = None) -> DataFrame:
    """One summary a team of the games (``team_id, game_id, game_date, won``),
    merged onto an earlier ``state`` of the same ``stretch``."""
    if stretch < 2:
        raise ValueError("a stretch has at least two games")
    of, merge = _stretch_of(stretch), _merge_stretches(stretch)
    return _state(team_games, "team_id", "won", "array<tinyint>", of, merge, state, n_partitions)


def most_wins(state: DataFrame, stretch: int = 90) -> DataFrame:
    """O17 from the state."""
    return state.select("team_id", F.col("best").alias(f"max_wins_{stretch}"))
