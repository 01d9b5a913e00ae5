"""Period-at-a-time loads: the reference's day/year increments run as a
sequence of batch steps, each persisted so the next reads a cut lineage."""

from tallyfold.streaming.periods import fold_periods
from tallyfold.streaming.stream import stream_daily_loads

__all__ = ["fold_periods", "stream_daily_loads"]
