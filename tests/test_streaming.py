"""Structured Streaming driver of the daily loads, with late rows."""

import datetime as dt
import time
import uuid

from support import SF_SMALL, rows
from pyspark.sql import functions as F

from tallyfold.operators import cumulate
from tallyfold.operators.dedupe import dedupe
from tallyfold.session import scratch_path
from tallyfold.sources import proxy
from tallyfold.streaming import stream_daily_loads


def _clean(facts):
    return dedupe(facts.where(F.col("user_id").isNotNull()), ["user_id", "event_time"], order=["event_id"])


def test_stream_with_late_rows_equals_backfill(spark):
    ev = proxy.web_events(spark, SF_SMALL)
    src = scratch_path(spark, "stream_src")
    day = F.dayofmonth("event_time")
    # One host's rows for days 3-6 arrive last: its date list must gain
    # those days when they come, and every later snapshot must include them.
    late = (F.col("host") == F.lit("purchase")) & day.between(3, 6)
    parts = [
        ev.where(~late & (day <= 10)),
        ev.where(~late & (day > 10) & (day <= 20)),
        ev.where(~late & (day > 20)),
        ev.where(late),
    ]
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{src}/part{i}")
        time.sleep(1.1)  # distinct modification times keep the arrival order
    stream = (
        spark.readStream.schema(ev.schema)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true")
        .parquet(src)
    )
    table = f"hosts_stream_{uuid.uuid4().hex[:8]}"
    q = stream_daily_loads(
        spark,
        stream,
        lambda prev, facts, d: cumulate.cumulate_hosts(prev, _clean(facts), d),
        table=table,
        partition_col="date",
        bucket_by=["host_name"],
        name=table,
    )
    q.awaitTermination(600)
    assert q.exception() is None
    assert max(p["batchId"] for p in q.recentProgress) == 3  # four micro-batches
    clean_all = _clean(ev)
    last = clean_all.agg(F.max("event_time")).first()[0].date()
    snap = spark.table(table)
    early = snap.where(F.col("date") == F.lit(dt.date(2024, 1, 12))).where(F.col("host_name") == "purchase").first()
    assert {dt.date(2024, 1, d) for d in range(3, 7)} <= set(early.host_activity_datelist)
    for d in (last, dt.date(2024, 1, 12)):
        got = snap.where(F.col("date") == F.lit(d)).select("host_name", "host_activity_datelist", "date")
        exp = cumulate.hosts_backfill(clean_all, d)
        assert rows(got) == rows(exp), d


def test_stream_monthly_facts_with_late_rows(spark):
    from tallyfold.operators import activity

    ev = proxy.web_events(spark, SF_SMALL)
    src = scratch_path(spark, "stream_src_monthly")
    day = F.dayofmonth("event_time")
    late = (F.col("host") == F.lit("click")) & day.between(2, 4)
    parts = [ev.where(~late & (day <= 15)), ev.where(~late & (day > 15)), ev.where(late)]
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{src}/part{i}")
        time.sleep(1.1)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
    table = f"monthly_stream_{uuid.uuid4().hex[:8]}"
    q = stream_daily_loads(
        spark,
        stream,
        lambda prev, facts, d: activity.reduce_monthly(prev, _clean(facts), d, "host"),
        table=table,
        partition_col="month_start",
        bucket_by=["host"],
        name=table,
        partition_of=lambda d: d.replace(day=1),
    )
    q.awaitTermination(600)
    assert q.exception() is None
    clean_all = _clean(ev)
    last = clean_all.agg(F.max("event_time")).first()[0].date()
    got = spark.table(table).select("host", "hit_array", "unique_visitors", "month_start")
    exp = activity.reduce_monthly_backfill(clean_all, last, "host")
    assert rows(got) == rows(exp.select(*got.columns))
