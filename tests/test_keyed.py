"""Keyed tables: changes rewrite the touched buckets only."""

import random

import pytest
from pyspark.sql import functions as F
from support import rows

from tallyfold.operators import merge
from tallyfold.plans.explain import plan_text
from tallyfold.session import scratch_path
from tallyfold.sources.keyed import BUCKET, KeyedTable
from tallyfold.sources.tables import table_files

SCHEMA = "k bigint, name string, v double"


def _bucket_files(spark, table):
    """Bucket -> (name, bytes, modification time) of its files."""
    out = {}
    for f in table_files(spark, table.path):
        if f"/{BUCKET}=" in f[0] and not f[0].endswith(".crc"):
            out.setdefault(int(f[0].split(f"{BUCKET}=")[1].split("/")[0]), set()).add(f)
    return out


def _table(spark, n=400, buckets=16):
    df = spark.createDataFrame([(i, f"n{i}", float(i)) for i in range(n)], SCHEMA)
    return df, KeyedTable.create(df, scratch_path(spark, "keyed-test"), ["k"], buckets)


def test_upsert_equals_the_whole_table_upsert_and_touches_few_buckets(spark):
    df, table = _table(spark)
    before = _bucket_files(spark, table)
    batch = spark.createDataFrame([(3, "new3", -1.0), (5000, "new", -2.0)], SCHEMA)
    want = rows(merge.upsert(df, batch, ["k"], ["v"]))
    touched = table.upsert(batch, ["v"])
    assert 1 <= len(touched) <= 2
    assert rows(table.rows().select("k", "name", "v")) == want
    after = _bucket_files(spark, table)
    assert {b for b in before if before[b] != after[b]} == set(touched)
    assert KeyedTable.open(spark, table.path).keys == ["k"] and KeyedTable.open(spark, table.path).n_buckets == 16


def test_only_touched_partitions_are_scanned(spark):
    _, table = _table(spark)
    some = table.bucket_rows([3, 5])
    text = plan_text(some, "formatted")
    assert "PartitionFilters" in text and f"{BUCKET}" in text.split("PartitionFilters", 1)[1].split("\n")[0]
    files = some.select("_metadata.file_path").distinct().collect()
    assert {f[0].split(f"{BUCKET}=")[1].split("/")[0] for f in files} == {"3", "5"}


def test_random_batches_follow_a_plain_dictionary(spark):
    rng = random.Random(11)
    _, table = _table(spark, 60, 5)
    want = {i: (f"n{i}", float(i)) for i in range(60)}
    for step in range(4):
        keys = rng.sample(range(90), rng.choice([0, 1, 7, 40]))
        # Keys of another integer type hash as the table's do.
        batch = spark.createDataFrame([(k, f"s{step}", -float(k)) for k in keys], "k int, name string, v double")
        table.upsert(batch)
        want |= {k: (f"s{step}", -float(k)) for k in keys}
        assert {r.k: (r.name, r.v) for r in table.rows().collect()} == want


def test_replaced_keys_may_leave_a_bucket_empty(spark):
    df = spark.createDataFrame([(i, f"n{i}", 0.0) for i in range(3)], SCHEMA)
    table = KeyedTable.create(df, scratch_path(spark, "keyed-test"), ["k"], 64)
    gone = spark.createDataFrame([(0,), (1,), (77,)], "k bigint")
    table.replace_keys(gone, spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], SCHEMA))
    assert rows(table.rows().select("k", "name", "v")) == [(1, "a", 1.0), (1, "b", 2.0), (2, "n2", 0.0)]
    table.replace_keys(table.rows().select("k"), df.limit(0))
    assert table.rows().count() == 0
    table.upsert(df)
    assert table.rows().count() == 3


def test_what_is_refused(spark):
    df, table = _table(spark, 10, 4)
    before = _bucket_files(spark, table)
    with pytest.raises(merge.DuplicateKeyError):
        table.upsert(spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], SCHEMA))
    with pytest.raises(merge.NullKeyError):
        table.upsert(spark.createDataFrame([(None, "a", 1.0)], SCHEMA))
    with pytest.raises(ValueError, match="not replaced"):
        table.replace_keys(spark.createDataFrame([(1,)], "k bigint"), df)
    with pytest.raises(Exception, match="NULL in key"):
        KeyedTable.create(spark.createDataFrame([(None, "a", 1.0)], SCHEMA), scratch_path(spark, "keyed-test"), ["k"])
    bad = spark.createDataFrame([(1, "a", 1.0)], SCHEMA).withColumn("v", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        table.upsert(bad)
    assert _bucket_files(spark, table) == before  # a job that fails changes nothing
