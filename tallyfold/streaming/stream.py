"""Run a daily incremental step from a Structured Streaming source.

New fact rows arrive as micro-batches.  ``foreachBatch`` stores each batch
(idempotently: a retried batch overwrites its own folder), finds the days it
touches, and re-runs the step from the earliest touched day up to the
latest day seen, overwriting the partitions the steps write.  Late rows
therefore never get dropped: they re-open their day, and every later
snapshot that depended on it is rebuilt.  The snapshot table is partitioned
by its period (a day for date lists, a month for monthly facts) and
bucketed by the entity key, so each rerun step shuffles only the day's
facts.  A small progress table records the latest day loaded.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyfold.session import durable_path
from tallyfold.streaming.periods import fold_periods

DayStep = Callable[[DataFrame | None, DataFrame, dt.date], DataFrame]


def _days(first: dt.date, last: dt.date) -> list[dt.date]:
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def stream_daily_loads(
    spark: SparkSession,
    source: DataFrame,
    step: DayStep,
    table: str,
    partition_col: str,
    bucket_by: Sequence[str],
    name: str,
    time_col: str = "event_time",
    available_now: bool = True,
    partition_of: Callable[[dt.date], object] | None = None,
) -> StreamingQuery:
    """Start a query that keeps snapshot ``table`` up to date from the
    streaming ``source``.  ``step(prev, facts, day)`` is an incremental
    operator such as ``cumulate_hosts`` (wrapped to apply its own cleaning).
    With ``available_now`` the query processes what is there and stops.
    ``partition_of`` maps a day to the table partition its step writes (the
    day itself by default, the month start for monthly facts)."""
    facts_path = durable_path(spark, f"streams/{name}/facts")
    progress_path = durable_path(spark, f"streams/{name}/progress")
    checkpoint = durable_path(spark, f"streams/{name}/checkpoint")

    def loaded_through(session: SparkSession, batch_id: int) -> dt.date | None:
        """Latest day loaded by the earlier batches (none on the first)."""
        try:
            done = session.read.parquet(progress_path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None  # no batch has finished yet
        return done.where(F.col("batch_id") < F.lit(batch_id)).agg(F.max("loaded_through")).first()[0]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        rows = batch.withColumn("_day", F.to_date(time_col))
        (
            rows.write.mode("overwrite")
            .partitionBy("_day")
            .parquet(f"{facts_path}/_batch={batch_id}")
        )
        # From the partitions written: the source is read once.
        stored = session.read.parquet(facts_path).where(F.col("_batch") == F.lit(batch_id))
        touched = stored.agg(F.min("_day"), F.max("_day")).first()
        if touched[0] is None:
            return
        first, last = touched
        done = loaded_through(session, batch_id)
        if done is not None:
            last = max(last, done)
            if first > done + dt.timedelta(days=1):
                first = done + dt.timedelta(days=1)  # close any gap of silent days
        # Steps read only their own day's facts (the snapshot carries the
        # rest), so partitions outside the re-run range are pruned.
        facts = (
            session.read.parquet(facts_path)
            .where(F.col("_day").between(F.lit(first), F.lit(last)))
            .drop("_batch", "_day")
        )
        initial = session.table(table) if session.catalog.tableExists(table) else None
        fold_periods(
            lambda prev, d: step(prev, facts, d),
            _days(first, last),
            initial=initial,
            spark=session,
            table=table,
            partition_col=partition_col,
            bucket_by=bucket_by,
            partition_of=partition_of,
        )
        # Recorded last: a batch retried after a failure re-runs its days.
        (
            session.createDataFrame([(batch_id, last)], "batch_id bigint, loaded_through date")
            .write.mode("overwrite")
            .parquet(f"{progress_path}/batch={batch_id}")
        )

    writer = source.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
