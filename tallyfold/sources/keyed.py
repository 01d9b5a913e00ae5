"""Tables changed key by key without rewriting them (O28 on a stored table).

A keyed table is a parquet table partitioned by a hash bucket of its key.  A
batch of changes names the buckets it touches (at most their number, so the
list is small); only those partitions are read, joined with the batch and
overwritten, and the files of all other buckets stay as they are.  Work and
shuffle follow the touched buckets, not the table.

The new version of the touched buckets is written whole to scratch space
before the table is changed, so a job that fails while it computes leaves the
table as it was; running the same batch again after a failure gives the same
table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyfold.functions.keys import require_keys
from tallyfold.operators.merge import assert_unique, upsert
from tallyfold.session import delete_path, scratch_path
from tallyfold.sources.tables import overwrite_into, partitions_for

BUCKET = "_bucket"
# Readers of the table skip names that begin with an underscore.
_LAYOUT = "_layout"


class KeyedTable:
    """A keyed table at ``path``; make one with :meth:`create` or :meth:`open`."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], n_buckets: int, schema: StructType):
        self.spark, self.path, self.keys, self.n_buckets = spark, path.rstrip("/"), list(keys), n_buckets
        self.schema = schema

    @classmethod
    def create(cls, df: DataFrame, path: str, keys: Sequence[str], n_buckets: int | None = None) -> KeyedTable:
        """Write ``df`` as a keyed table (by default with as many buckets as its
        size asks for; more buckets make smaller changes cheaper)."""
        table = cls(df.sparkSession, path, keys, n_buckets or partitions_for(df), df.schema)
        rows = require_keys(df, table.keys, "keyed table")
        table._dealt(rows.withColumn(BUCKET, table._bucket())).write.mode("overwrite").partitionBy(BUCKET).parquet(table.path)
        layout = table.spark.createDataFrame([(table.keys, table.n_buckets, df.schema.json())], "keys array<string>, n_buckets int, columns string")
        layout.coalesce(1).write.mode("overwrite").parquet(f"{table.path}/{_LAYOUT}")
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> KeyedTable:
        layout = spark.read.parquet(f"{path.rstrip('/')}/{_LAYOUT}").first()
        return cls(spark, path, layout["keys"], layout["n_buckets"], StructType.fromJson(json.loads(layout["columns"])))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.n_buckets)).cast("int")

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """One bucket, one task, one file."""
        return rows.repartition(self.n_buckets, BUCKET)

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(StructType([*self.schema.fields, StructField(BUCKET, IntegerType())])).parquet(self.path)

    def rows(self) -> DataFrame:
        return self._stored().drop(BUCKET)

    def _typed(self, df: DataFrame) -> DataFrame:
        """``df`` with the keys in the table's types (equal values of different
        types hash apart) and their bucket."""
        for k in self.keys:
            df = df.withColumn(k, F.col(k).cast(self.schema[k].dataType))
        return df.withColumn(BUCKET, self._bucket())

    def touched(self, df: DataFrame) -> list[int]:
        """The buckets that the keys of ``df`` lie in: at most ``n_buckets``."""
        return sorted(r[0] for r in self._typed(df).select(BUCKET).distinct().collect())

    def bucket_rows(self, buckets: Sequence[int]) -> DataFrame:
        """The rows of some buckets: other partitions are not listed or read."""
        return self._stored().where(F.col(BUCKET).isin(*buckets))

    def upsert(self, updates: DataFrame, update_cols: Sequence[str] | None = None) -> list[int]:
        """Insert or update by key (see :func:`tallyfold.operators.merge.upsert`);
        returns the buckets that were rewritten."""
        assert_unique(updates, self.keys)
        batch, buckets = self._typed(updates), self.touched(updates)
        if buckets:
            columns = list(update_cols or [c for c in updates.columns if c not in self.keys])
            merged = upsert(self.bucket_rows(buckets), batch, [BUCKET, *self.keys], columns, check_unique=False)
            self._replace(merged, buckets)
        return buckets

    def replace_keys(self, keys: DataFrame, rows: DataFrame) -> list[int]:
        """Take out all rows of ``keys`` and put ``rows`` in (of those keys, any
        number each); returns the buckets that were rewritten."""
        buckets = self.touched(keys)
        if buckets:
            on = [BUCKET, *self.keys]
            gone = self._typed(require_keys(keys, self.keys, "keys to replace")).select(*on).distinct()
            old = self.bucket_rows(buckets)
            new = self._typed(rows).select(*old.columns)
            stray = new.join(gone, on, "left_anti").limit(1).collect()
            if stray:
                raise ValueError(f"row of a key that is not replaced: {[stray[0][k] for k in self.keys]}")
            self._replace(old.join(gone, on, "left_anti").unionByName(new), buckets)
        return buckets

    def _replace(self, rows: DataFrame, buckets: list[int]) -> None:
        staged = scratch_path(self.spark, "keyed/staged")
        self._dealt(rows).write.partitionBy(BUCKET).parquet(staged)
        new = self.spark.read.schema(rows.schema).parquet(staged)
        left = {r[0] for r in new.select(BUCKET).distinct().collect()}
        overwrite_into(self._dealt(new), self.path, partition_by=[BUCKET])
        for bucket in buckets:
            if bucket not in left:  # a dynamic overwrite keeps what it has no rows for
                delete_path(self.spark, f"{self.path}/{BUCKET}={bucket}")
        delete_path(self.spark, staged)
