"""Run an incremental step over consecutive periods.

``fold_periods(step, periods)`` calls ``step(prev, period)`` in order.  After
every step the new snapshot is cut from its lineage: it is inserted as
partition ``period`` of a catalog snapshot table bucketed by the entity key
(the next step joins it in place), or written as that partition of a plain
parquet table, both with dynamic partition overwrite so a rerun of one
period is idempotent, or else kept as a reliable checkpoint in
``spark.checkpoint.dir``.  Plans therefore stay one
step deep however many periods run, and a lost executor recomputes from the
last written snapshot, not from the first period.

Late data for a period is handled by re-running the folds from that period.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.session import cut_lineage, durable_path, materialize
from tallyfold.sources.tables import insert_periods, overwrite_into, partitions_for, write_snapshot_table

Step = Callable[[DataFrame | None, Any], DataFrame]


def fold_periods(
    step: Step,
    periods: Iterable[Any],
    initial: DataFrame | None = None,
    spark: SparkSession | None = None,
    sink_path: str | None = None,
    partition_col: str | None = None,
    keep_all: bool = False,
    table: str | None = None,
    bucket_by: Sequence[str] = (),
    n_buckets: int | None = None,
    partition_of: Callable[[Any], Any] | None = None,
) -> DataFrame | None:
    """Fold ``step`` over ``periods``; returns the last snapshot, or with
    ``keep_all`` and a sink every written period.

    With ``table`` and ``bucket_by`` the sink is a catalog snapshot table
    partitioned by ``partition_col`` and bucketed by the entity key: each
    step then joins the previous period in place and shuffles only the new
    period's facts.  The table is created on the first period unless it
    already exists; an existing table is also the default ``initial``, so a
    run resumes from it (and a rerun replaces the periods it covers).

    ``partition_of`` maps a period to the value of ``partition_col`` its
    step writes (identity by default; e.g. the month start for a daily step
    into a monthly table)."""
    part = partition_of or (lambda p: p)
    if table is not None and initial is None:
        session = spark or SparkSession.getActiveSession()
        if session is not None and session.catalog.tableExists(table):
            initial = session.table(table)
    prev = initial
    last = None
    for p in periods:
        cur = step(prev, p)
        if table is not None:
            if partition_col is None or not bucket_by:
                raise ValueError("a snapshot table needs the period column and the bucket key")
            session = spark or cur.sparkSession
            cols = cur.columns
            if session.catalog.tableExists(table):
                # The step may have read the partition it replaces (a month):
                # its result is whole on disk before the insert begins.
                insert_periods(materialize(cur, f"versions/{table}"), table)
            else:
                n = n_buckets or partitions_for(cur)
                write_snapshot_table(cur, table, partition_col, bucket_by, n, durable_path(session, f"tables/{table}"))
            cur = session.table(table).where(F.col(partition_col) == F.lit(part(p))).select(*cols)
        elif sink_path is not None:
            if partition_col is None:
                raise ValueError("a sink needs the period partition column")
            cols = cur.columns
            overwrite_into(cur, sink_path, partition_by=[partition_col])
            session = spark or cur.sparkSession
            cur = session.read.parquet(sink_path).where(F.col(partition_col) == F.lit(part(p))).select(*cols)
        else:
            cur = cut_lineage(cur)
        prev = last = cur
    if keep_all and table is not None and last is not None:
        return (spark or last.sparkSession).table(table).select(*last.columns)
    if keep_all and sink_path is not None and last is not None:
        return (spark or last.sparkSession).read.parquet(sink_path).select(*last.columns)
    return last
