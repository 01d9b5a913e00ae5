"""Skew-safe positions and running sums within a key.

A window ``partitionBy(key).orderBy(t)`` puts every row of a key into one
task; a key holding a third of all rows then holds a third of the job.
Here the rows are range-partitioned on ``(key, order)`` instead, which
splits a hot key over many partitions.  Each partition reports per-key row
counts and sums (a small aggregate: one row per key and partition, at most
``n`` rows for any key), an exclusive prefix over partitions gives each
partition's offset, and the offsets are joined back on ``(partition, key)``,
a join whose rows of a hot key are again spread over partitions.

Result: ``_pos`` (0-based position of the row within its key in ``order``)
and ``<c>_cum`` (inclusive running sum of ``c`` within the key) for each
column in ``sums``.  Ties in ``order`` are broken arbitrarily; pass a total
order.

:func:`positions` is the entry point operators use: like a broadcast, the
plain per-key window (one shuffle) runs only behind a check, here that the
largest key holds at most ``max_key_rows`` rows; otherwise it falls back to
the range-partitioned plan above.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.session import cut_lineage
from tallyfold.sources.tables import partitions_for

_PID, _MID, _KEY = "_seq_pid", "_seq_mid", "_seq_key"


def sequence_positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Sequence[str] = (),
    n_partitions: int | None = None,
    materialize: bool = True,
) -> DataFrame:
    n = n_partitions or partitions_for(df)
    keys, order, sums = list(keys), list(order), list(sums)
    cols = df.columns

    ranged = (
        df.withColumn(_KEY, F.struct(*keys))
        .repartitionByRange(n, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_MID, F.monotonically_increasing_id())
    )
    if materialize:
        # The partition assignment must be the same in both branches below;
        # a reliable checkpoint pins it (and survives executor loss).
        ranged = cut_lineage(ranged)

    per_part = ranged.groupBy(_PID, _KEY).agg(
        F.count(F.lit(1)).alias("_seq_n"),
        F.min(_MID).alias("_seq_m0"),
        *[F.sum(c).alias(f"_seq_s_{i}") for i, c in enumerate(sums)],
    )
    before = Window.partitionBy(_KEY).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        _PID,
        _KEY,
        "_seq_m0",
        F.coalesce(F.sum("_seq_n").over(before), F.lit(0)).alias("_seq_off"),
        *[F.coalesce(F.sum(f"_seq_s_{i}").over(before), F.lit(0)).alias(f"_seq_o_{i}") for i in range(len(sums))],
    )

    # Each (partition, key) group is at most one range partition.  Hashing the
    # groups into more buckets than there are range partitions keeps two
    # large groups (pieces of one hot key) from landing in the same task.
    joined = ranged.repartition(4 * n, _PID, _KEY).join(offsets, [_PID, _KEY])
    local = Window.partitionBy(_PID, _KEY).orderBy(_MID).rowsBetween(Window.unboundedPreceding, 0)
    out = joined.select(
        *cols,
        (F.col("_seq_off") + F.col(_MID) - F.col("_seq_m0")).alias("_pos"),
        *[(F.col(f"_seq_o_{i}") + F.sum(c).over(local)).alias(f"{c}_cum") for i, c in enumerate(sums)],
    )
    return out


# A per-key window sorts a whole key in one task; up to this many rows per
# key that is cheap, and it costs one shuffle instead of three.
DEFAULT_KEY_ROWS = 5_000_000


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest key (one aggregation job, combined map-side)."""
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def fits_window(df: DataFrame, keys: Sequence[str], max_key_rows: int | None = DEFAULT_KEY_ROWS) -> bool:
    """True when a per-key window is safe: the largest key is checked to
    hold at most ``max_key_rows`` rows.  ``None`` always answers False."""
    return max_key_rows is not None and largest_group(df, keys) <= max_key_rows


def positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Sequence[str] = (),
    max_key_rows: int | None = DEFAULT_KEY_ROWS,
    materialize_input: bool = False,
) -> DataFrame:
    """``_pos`` and ``<c>_cum`` as :func:`sequence_positions` computes them;
    a plain per-key window when the largest key is checked to be small,
    the range-partitioned plan otherwise.  With ``materialize_input`` an
    expensive input is written once, since the key check and the plan both
    read it."""
    if max_key_rows is not None and materialize_input:
        df = cut_lineage(df)
    if not fits_window(df, keys, max_key_rows):
        return sequence_positions(df, keys, order, sums)
    w = Window.partitionBy(*keys).orderBy(*order)
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.select(
        *df.columns,
        (F.row_number().over(w) - 1).cast("long").alias("_pos"),
        *[F.sum(c).over(running).alias(f"{c}_cum") for c in sums],
    )
