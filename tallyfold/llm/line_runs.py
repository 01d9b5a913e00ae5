"""Line deduplication over levelled sorted runs of line hashes (operator 11).

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with
A-Z lower-cased.  A key of at least ``min_chars`` code points that at least
``min_docs`` documents hold is frequent: all its lines go, except those of
the largest document id that holds it.  Every other line stays.

:class:`LineRuns` is the store.  A run holds one row per key, bucketed and
sorted by the key's hash: ``_h1, _h2`` (two 64-bit hashes of the key under
different seeds), ``_n`` (documents that hold it) and ``_top`` (the largest of
their ids).  A batch is reduced to one row per key, merge-anti-joined with
the runs (a key that a run shows as frequent, with a larger id than the batch
has, needs nothing more) and written as a run of level 0.  When a level has
``fanout`` runs they are merged into one run of the next level: counts add
up, the largest id stays.  All runs have the same buckets, so joins with them
move the batch only.  The store is a set of catalog tables named after it; a
later session that has the tables goes on where the last one stopped.  A store
without a name is scratch space of its session.

Everything is DataFrame functions, run in the JVM.

Edge cases: a null or empty text is one empty line; rows of the same id are
one document (each keeps its own text; all of them keep the lines of a key
whose largest id they are); rows of a null id are returned as they are and
counted nowhere; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.plans.joins import join_small
from tallyfold.session import delete_path, durable_path, scratch_path, scratch_table

MIN_CHARS = 40
MIN_DOCS = 5
#: Runs of one level that are merged into a run of the next.
FANOUT = 2
#: Batches that a whole table is added in.
BATCHES = 4

_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HASH = ["_h1", "_h2"]


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """Stripped at both ends, A-Z lower-cased (``lower`` does just that where
    all bytes are ASCII, and is much the faster)."""
    bare = F.btrim(line, F.lit(_SPACE))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), key).alias(h) for seed, h in enumerate(_HASH, start=11)]


def long_lines(docs: DataFrame, min_chars: int, text_col: str, id_col: str) -> DataFrame:
    """(``_id``, ``_text`` hash, ``_pos``, ``_h1``, ``_h2``) of every line whose
    key is long enough."""
    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("_id"),
        F.xxhash64(F.col(text_col)).alias("_text"),
        F.posexplode(text_lines(F.col(text_col))).alias("_pos", "_line"),
    )
    # No key is longer than its line, so short lines leave before their key is made.
    keyed = rows.where(F.char_length("_line") >= min_chars).withColumn("_key", line_key(F.col("_line")))
    return keyed.where(F.char_length("_key") >= min_chars).select("_id", "_text", "_pos", *_hashes(F.col("_key")))


class LineRuns:
    """The runs of the store ``name``, see above."""

    def __init__(
        self,
        spark: SparkSession,
        name: str | None = None,
        min_docs: int = MIN_DOCS,
        min_chars: int = MIN_CHARS,
        fanout: int = FANOUT,
        n_buckets: int | None = None,
    ):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.spark, self.min_docs, self.min_chars, self.fanout = spark, min_docs, min_chars, fanout
        self.name, self._own = name or f"tallyfold_lines_{uuid.uuid4().hex[:10]}", name is None
        found = [re.fullmatch(re.escape(self.name) + r"_l(\d+)_r(\d+)", t.name) for t in spark.catalog.listTables()]
        #: (level, number) of every run.
        self.runs: list[tuple[int, int]] = sorted((int(m[1]), int(m[2])) for m in found if m)
        self._next = max((r for _, r in self.runs), default=-1) + 1
        self.n_buckets = n_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _table(self, run: tuple[int, int]) -> str:
        return f"{self.name}_l{run[0]}_r{run[1]}"

    def _path(self, run: tuple[int, int]) -> str:
        name = f"lines/{self._table(run)}"
        return scratch_path(self.spark, name, unique=False) if self._own else durable_path(self.spark, name)

    def run(self, run: tuple[int, int]) -> DataFrame:
        return self.spark.table(self._table(run))

    def _write(self, rows: DataFrame, level: int) -> tuple[int, int]:
        run = (level, self._next)
        self._next += 1
        table = self._table(run)
        # Rows come dealt out by hash: a task holds whole buckets.
        writer = rows.write.format("parquet").mode("overwrite").bucketBy(self.n_buckets, *_HASH).sortBy(*_HASH)
        if self._own:
            scratch_table(self.spark, table.removeprefix("tallyfold_"), unique=False)
        writer.option("path", self._path(run)).saveAsTable(table)
        self.runs.append(run)
        return run

    def add(self, docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> None:
        """Add a batch of documents.  No document may be in two batches: its
        lines would count twice."""
        lines = long_lines(docs, self.min_chars, text_col, id_col)
        # A hot key has one row per task before it is dealt out by key.
        batch = lines.groupBy(*_HASH).agg(F.countDistinct("_id").alias("_n"), F.max("_id").alias("_top"))
        for run in self.runs:
            settled = self.run(run).where(F.col("_n") >= self.min_docs).alias("r").hint("merge")
            same = (F.col("b._h1") == F.col("r._h1")) & (F.col("b._h2") == F.col("r._h2"))
            batch = batch.alias("b").join(settled, same & (F.col("r._top") > F.col("b._top")), "left_anti")
        self._write(batch, 0)
        self._compact()

    def _merge(self, runs: Sequence[tuple[int, int]]) -> DataFrame:
        """Merge joins of the sorted runs, smallest first; two runs merge in
        place.  (Not a union: over bucketed scans Spark 4.1 plans the aggregate
        of one without an exchange, and keys of different runs stay apart.)"""
        runs = sorted(runs)
        rows = self.run(runs[0])
        for run in runs[1:]:
            same = (F.col("x._h1") == F.col("y._h1")) & (F.col("x._h2") == F.col("y._h2"))
            both = rows.alias("x").join(self.run(run).alias("y").hint("merge"), same, "full_outer")
            rows = both.select(
                *[F.coalesce(f"x.{h}", f"y.{h}").alias(h) for h in _HASH],
                (F.coalesce("x._n", F.lit(0)) + F.coalesce("y._n", F.lit(0))).alias("_n"),
                F.greatest("x._top", "y._top").alias("_top"),
            )
        return rows

    def _compact(self) -> None:
        level = 0
        while len(full := [r for r in self.runs if r[0] == level]) >= self.fanout:
            self._write(self._merge(full), level + 1)
            # The merged runs go once the new one is whole.
            for run in full:
                self._drop(run)
            level += 1

    def _drop(self, run: tuple[int, int]) -> None:
        self.runs.remove(run)
        self.spark.sql(f"DROP TABLE {self._table(run)}")
        # Tables with a path of their own leave their files.
        delete_path(self.spark, self._path(run))

    def frequent(self) -> DataFrame:
        """``_h1, _h2, _top`` of every frequent key."""
        return self._merge(self.runs).where(F.col("_n") >= self.min_docs).select(*_HASH, "_top")

    def drop_lines(self, docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
        """``id``, ``n_lines``, ``n_dropped`` and the text that is left of every
        row of ``docs``, judged by all batches added so far."""
        lines = long_lines(docs, self.min_chars, text_col, id_col)
        hits = join_small(lines, self.frequent(), _HASH).where(F.col("_top") != F.col("_id"))
        # At most one entry a line of one document.
        marks = hits.groupBy("_id", "_text").agg(F.sort_array(F.collect_set("_pos")).alias("_at"))
        mask = F.flatten(
            F.transform(
                "_at",
                lambda p, j: F.concat(
                    F.array_repeat(F.lit(False), p - F.coalesce(F.get(F.col("_at"), j - 1), F.lit(-1)) - 1), F.array(F.lit(True))
                ),
            )
        )
        marks = marks.select(F.col("_id").alias("_mid"), F.col("_text").alias("_mtext"), F.size("_at").cast("long").alias("_dropped"), mask.alias("_mask"))
        rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_body"), F.xxhash64(F.col(text_col)).alias("_text"))
        out = join_small(rows, marks, (F.col("_id") == F.col("_mid")) & (F.col("_text") == F.col("_mtext")), "left")
        body = text_lines(F.col("_body"))
        kept = F.array_join(F.filter(body, lambda _, i: ~F.coalesce(F.get(F.col("_mask"), i), F.lit(False))), "\n")
        return out.select(
            F.col("_id").alias(id_col),
            F.size(body).cast("long").alias("n_lines"),
            F.coalesce("_dropped", F.lit(0)).alias("n_dropped"),
            F.when(F.col("_mask").isNull(), F.coalesce("_body", F.lit(""))).otherwise(kept).alias(text_col),
        )


def id_ranges(docs: DataFrame, n: int, id_col: str = "doc_id") -> list[Column]:
    """Conditions that cut the rows with an id into at most ``n`` ranges of
    about the same size, largest ids first."""
    # The most accurate sketch that is still small; only the balance of the
    # ranges depends on it.
    cuts = docs.agg(F.percentile_approx(F.col(id_col).cast("long"), [i / n for i in range(1, n)], 1000)).first()[0] if n > 1 else []
    cuts = sorted(set(cuts or []), reverse=True)
    col = F.col(id_col)
    uppers, lowers = [None, *cuts], [*cuts, None]
    return [
        (F.lit(True) if low is None else col > low) & (F.lit(True) if high is None else col <= high) & col.isNotNull()
        for high, low in zip(uppers, lowers)
    ]


def dedupe_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """The whole table through a store of its own: added in ranges of ids, the
    largest first (so that a key's last holder is known when the key is first
    met), then judged.  Returns ``id``, ``n_lines``, ``n_dropped``, ``text``."""
    store = LineRuns(docs.sparkSession, min_docs=min_docs, min_chars=min_chars, fanout=fanout)
    for part in id_ranges(docs, batches, id_col):
        store.add(docs.where(part), text_col, id_col)
    return store.drop_lines(docs, text_col, id_col)
