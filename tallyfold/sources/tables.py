"""Readers and writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder; Catalyst prunes columns and pushes
    filters into the scan, so callers select only what they need."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_files(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """(name, bytes, modification time) of the files below a path, whatever
    store it is in: differs as soon as rows arrive or change."""
    sc = spark.sparkContext
    top = sc._jvm.org.apache.hadoop.fs.Path(path)
    files, out = top.getFileSystem(sc._jsc.hadoopConfiguration()).listFiles(top, True), []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


# A bucket or layout partition should hold about this much.
TARGET_BYTES = 64 << 20


def partitions_for(df: DataFrame, target_bytes: int = TARGET_BYTES) -> int:
    """Partitions of about ``target_bytes`` for a frame, from Spark's size
    estimate of its plan: at least the smaller of 8 and the session's shuffle
    partitions, at most the latter."""
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(min(8, most), min(most, -(-size // target_bytes)))


# A bucket should hold about this many rows.
BUCKET_ROWS = 500_000


def buckets_for(*frames: DataFrame, rows: int = BUCKET_ROWS) -> int:
    """Buckets of about ``rows`` rows for tables to be bucketed alike, from the
    rows of the largest (for a parquet table they stand in the footers): at
    least the smaller of 8 and the session's shuffle partitions, at most as
    many as Spark allows.  A bucket is one task's share of a join in place, so
    that share stays the same as the tables grow; bytes of files do not tell
    it, as their columns are packed."""
    conf = frames[0].sparkSession.conf
    least = min(8, int(conf.get("spark.sql.shuffle.partitions")))
    most = int(conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return max(least, min(most, -(-max(df.count() for df in frames) // rows)))


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    infer: bool = False,
) -> DataFrame:
    """Header CSV.  An explicit schema is the default contract; type
    inference costs an extra pass over the files and is only done on request."""
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


# The columns of a rejected line.
BAD_TEXT, BAD_REASON = "line", "reason"


def read_csv_checked(
    spark: SparkSession, path: str, schema: StructType | str, header: bool = True, reject_path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """O31 that survives bad rows: (good rows of ``schema``, rejected lines).

    A line that does not fit the schema is kept whole as ``line``, with the file
    it stands in and a ``reason``: how many fields it has instead of how many,
    or which column's value is not of its type.  Every line is in one of the
    two results.  With ``reject_path`` the rejected lines are written there and
    read back.  An empty field is NULL, as in the plain reader.
    """
    from tallyfold.session import materialize  # session writes through this module

    if not isinstance(schema, StructType):
        schema = StructType.fromDDL(schema)
    raw = "_line"
    wide = StructType([*schema.fields, StructField(raw, StringType())])
    reader = spark.read.option("header", str(header).lower()).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", raw)
    # Parsed once, into scratch space: both results come from there.
    parsed = reader.schema(wide).csv(path).withColumn("_file", F.col("_metadata.file_path"))
    rows = materialize(parsed, "csv-parsed")
    good = rows.where(F.col(raw).isNull()).drop(raw, "_file")
    bad = rows.where(F.col(raw).isNotNull())
    # The fields as text: one that is there but that the reader left NULL is
    # the one it could not read.
    texts = F.from_csv(F.col(raw), ", ".join(f"_f{i} string" for i in range(len(schema))))
    fields = bad.withColumn("_p", texts)
    count = F.size(F.split(F.regexp_replace(raw, r'"(?:[^"\\]|\\.)*"', "q"), ",", -1))
    reason = F.when(count != len(schema), F.concat(count.cast("string"), F.lit(f" fields instead of {len(schema)}")))
    for i, f in enumerate(schema.fields):
        unread = F.col(f"_p._f{i}").isNotNull() & F.col(f.name).isNull()
        reason = reason.when(unread, F.lit(f"{f.name} is not a {f.dataType.simpleString()}"))
    bad = fields.select(F.col(raw).alias(BAD_TEXT), F.col("_file").alias("file"), reason.otherwise(F.lit("not readable")).alias(BAD_REASON))
    if reject_path is not None:
        bad.write.mode("overwrite").parquet(reject_path)
        bad = spark.read.schema(bad.schema).parquet(reject_path)
    return good, bad


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", str(header).lower()).csv(path)


def overwrite_into(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> None:
    """Replace a table's content with a result.

    Columns are selected by name first, so a positional insert can never swap
    two columns of equal type.  With partition columns the overwrite is
    dynamic: only the partitions present in ``df`` are replaced, which makes a
    rerun of one period idempotent and lets a job read period p-1 while it
    writes period p.
    """
    out = df.select(*columns) if columns is not None else df
    writer = out.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.save(path)


def write_bucketed(
    df: DataFrame,
    table: str,
    key: str | Sequence[str],
    n_buckets: int | None = None,
    path: str | None = None,
    sort: bool = True,
) -> DataFrame:
    """Hash the rows into ``n_buckets`` files per key, sorted inside each
    bucket, as a parquet catalog table; later joins and aggregations on the
    key read co-located buckets without an Exchange.

    ``n_buckets`` defaults to :func:`partitions_for` the data (the reference
    used 16 buckets for its own); tables to be joined in place need the same
    number.

    Returns the table as read back from the catalog.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if n_buckets is None:
        n_buckets = partitions_for(df)
    # Same hash and modulus as bucketing: each write task receives exactly one
    # bucket and writes one file, instead of every task writing n_buckets
    # small files.
    df = df.repartition(n_buckets, *keys)
    writer = df.write.format("parquet").mode("overwrite").bucketBy(n_buckets, *keys)
    if sort:
        writer = writer.sortBy(*keys)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def write_snapshot_table(
    df: DataFrame,
    table: str,
    period_col: str,
    keys: Sequence[str],
    n_buckets: int,
    path: str,
) -> DataFrame:
    """Create (or replace) a snapshot table partitioned by period and
    bucketed by entity key.  The next period's step reads partition p-1 as a
    bucketed scan, so its join with the period's aggregate (hashed into the
    same number of partitions) shuffles only the new facts, never the
    accumulated history.  The table carries dynamic partition overwrite, so
    :func:`insert_periods` replaces just the periods it writes."""
    keys = list(keys)
    (
        df.repartition(n_buckets, *keys)
        .write.format("parquet")
        .mode("overwrite")
        .option("path", path)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(period_col)
        .bucketBy(n_buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table).select(*df.columns)


def insert_periods(df: DataFrame, table: str) -> None:
    """Overwrite the periods present in ``df`` in an existing snapshot table
    (columns matched by name first; rows are bucketed as the table says)."""
    target = df.sparkSession.table(table).columns
    df.select(*target).write.insertInto(table, overwrite=True)
