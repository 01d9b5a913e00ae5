"""Session helpers: shared scratch location and lineage cuts.

The cluster names a shared folder in ``spark.checkpoint.dir``.  Everything
this library writes on its own (checkpoints, intermediate tables, bucketed
layouts) goes below that folder.  The library never picks a machine-local
folder itself; only tests and local entry points set one when it is unset.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        return None


def session_id(spark: SparkSession) -> str:
    """Identifies the running application (for per-session memos)."""
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", str(id(spark)))


_SHIPPED: set[str] = set()
_SCRATCH: dict[str, list[str]] = {}
_TABLES: dict[str, list[str]] = {}
_ON_DROP: list[Callable[[SparkSession], None]] = []


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the session's Python workers: a zip of
    its source goes to every executor through Spark, once per application."""
    sc = _context(spark)
    if sc is None or sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tallyfold-src-"), "tallyfold.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("tallyfold", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder configured on the session, if any."""
    sc = _context(spark)
    d = sc.getCheckpointDir() if sc is not None else None
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the configured checkpoint folder; set ``fallback`` only if unset."""
    sc = _context(spark)
    d = checkpoint_dir(spark)
    if sc is None:
        if d is None:
            spark.conf.set("spark.checkpoint.dir", fallback)
            d = fallback
        return d
    if d is None:
        sc.setCheckpointDir(fallback)
        d = sc.getCheckpointDir() or fallback
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def durable_path(spark: SparkSession, name: str) -> str:
    """A fixed path below the shared checkpoint folder for what must outlive
    the session (a stream's state, a table of the caller's own name):
    :func:`drop_scratch` leaves it alone."""
    base = checkpoint_dir(spark)
    if base is None:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder "
            "(e.g. on HDFS/S3) before running jobs that write intermediate tables"
        )
    return f"{base.rstrip('/')}/tallyfold/{name}"


def scratch_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A path below the shared checkpoint folder for an intermediate table."""
    path = durable_path(spark, f"{name}-{uuid.uuid4().hex[:12]}" if unique else name)
    _SCRATCH.setdefault(session_id(spark), []).append(path)
    return path


def scratch_table(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A catalog table name for an intermediate table of this session."""
    clean = "tallyfold_" + "".join(ch if ch.isalnum() else "_" for ch in name)
    table = f"{clean}_{uuid.uuid4().hex[:10]}" if unique else clean
    _TABLES.setdefault(session_id(spark), []).append(table)
    return table


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, whatever store it is in."""
    sc = _context(spark)
    if sc is not None:
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def existing_files(spark: SparkSession, path: str) -> list[str]:
    """The files right below a folder, whatever store it is in; none if there is
    no such folder."""
    sc = _context(spark)
    if sc is None:
        raise RuntimeError("listing a folder needs a SparkContext")
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(sc._jsc.hadoopConfiguration())
    return [s.getPath().toString() for s in store.listStatus(at)] if store.exists(at) else []


def on_drop(forget: Callable[[SparkSession], None]) -> None:
    """Have ``forget`` called by :func:`drop_scratch`: for memos of what was
    written."""
    _ON_DROP.append(forget)


def drop_scratch(spark: SparkSession) -> None:
    """Drop the intermediate catalog tables and folders that this library made
    for this session, and nothing else: call it when no result is read any
    more (results are lazy and read the intermediate tables).  Queries that
    run later make theirs anew."""
    for forget in _ON_DROP:
        forget(spark)
    for table in _TABLES.pop(session_id(spark), []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    for path in _SCRATCH.pop(session_id(spark), []):
        delete_path(spark, path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: the plan becomes a
    scan of columnar files that survive the loss of an executor.  Without a
    shared folder this raises, since results may rest on rows being pinned."""
    return materialize(df, "cut")


def materialize(
    df: DataFrame,
    name: str,
    partition_by: list[str] | tuple[str, ...] = (),
    bucket_by: list[str] | tuple[str, ...] = (),
) -> DataFrame:
    """Write ``df`` as a parquet table below the shared folder and return it
    read back: the lineage is cut (a lost executor re-reads files instead of
    recomputing), and a table partitioned by its period lets later period
    filters prune whole partitions.  With ``bucket_by`` (and one partition
    column) it becomes a catalog table bucketed for its size, so joins on the
    key read it in place."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if bucket_by:
        from tallyfold.sources.tables import partitions_for, write_snapshot_table

        if len(partition_by) != 1:
            raise ValueError("a bucketed snapshot needs exactly one period column")
        return write_snapshot_table(df, scratch_table(spark, name), partition_by[0], bucket_by, partitions_for(df), path)
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


@contextlib.contextmanager
def scoped_conf(spark: SparkSession, settings: dict[str, str]):
    """Set session settings for the duration of a block, then restore."""
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
