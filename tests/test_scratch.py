"""``drop_scratch`` drops what the session's queries made, and only that."""

import uuid

from support import SF_SMALL, rows

import __spark_entry__ as entry
from tallyfold import reports
from tallyfold.session import drop_scratch, durable_path, materialize, scratch_path, scratch_table
from tallyfold.sources.tables import table_files, write_bucketed


def test_only_its_own_tables_and_paths(spark):
    foreign = f"tallyfold_foreign_{uuid.uuid4().hex[:8]}"
    spark.range(3).write.saveAsTable(foreign)
    kept = durable_path(spark, f"kept-{uuid.uuid4().hex[:8]}")
    spark.range(4).write.parquet(kept)
    own = scratch_table(spark, "own")
    write_bucketed(spark.range(5), own, "id", 2, path=scratch_path(spark, "own"))
    loose = scratch_path(spark, "loose")
    spark.range(6).write.parquet(loose)
    before = rows(entry.queries()["first_by_history"](spark, SF_SMALL))
    assert reports._SHARED
    try:
        drop_scratch(spark)
        assert not reports._SHARED
        assert spark.catalog.tableExists(foreign) and not spark.catalog.tableExists(own)
        assert spark.read.parquet(kept).count() == 4
        left = [t.name for t in spark.catalog.listTables() if t.name.startswith("tallyfold_")]
        assert left == [foreign]
        # The next query makes its tables anew.
        assert rows(entry.queries()["first_by_history"](spark, SF_SMALL)) == before
        assert materialize(spark.range(7), "again").count() == 7
    finally:
        spark.sql(f"DROP TABLE {foreign}")


def test_a_live_stream_goes_on(spark, tmp_path):
    """A stream's facts, progress and table outlive the drop between batches."""
    import datetime as dt

    from tallyfold.operators import cumulate
    from tallyfold.streaming import stream_daily_loads

    schema = "event_id bigint, user_id bigint, host string, event_time timestamp_ntz"
    name = f"hosts_{uuid.uuid4().hex[:8]}"
    src = str(tmp_path / "src")

    def load(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(src)
        source = spark.readStream.schema(schema).parquet(src)
        q = stream_daily_loads(spark, source, cumulate.cumulate_hosts, name, "date", ["host_name"], name)
        q.awaitTermination()

    load([(1, 1, "a", dt.datetime(2024, 1, 1, 1))])
    drop_scratch(spark)
    load([(2, 1, "b", dt.datetime(2024, 1, 2, 1)), (3, 2, "a", dt.datetime(2024, 1, 1, 5))])
    got = {(r.host_name, r.date): r.host_activity_datelist for r in spark.table(name).collect()}
    d = dt.date
    assert got == {
        ("a", d(2024, 1, 1)): [d(2024, 1, 1)],
        ("a", d(2024, 1, 2)): [d(2024, 1, 1)],
        ("b", d(2024, 1, 2)): [d(2024, 1, 2)],
    }
    spark.sql(f"DROP TABLE {name}")
    assert table_files(spark, durable_path(spark, f"streams/{name}/facts"))
