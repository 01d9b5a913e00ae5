"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in the order of a hash, are cut into blocks.  In the
ideal stream all sources run at once, each at a rate of its target weight over
the weights of the sources that have blocks left.  A block is released in the
slot in which the ideal stream begins it, and due by the end of the slot in
which the ideal stream ends it; one block runs per slot, the released block of
earliest deadline first.  In any stretch of slots the windows that lie inside
it are no more than its slots, so every deadline is met: after any number of
slots each source has had less than one block more or fewer than in the ideal
stream.  The weights are integers in units of 2^-40 of their sum and the
windows are computed from them without rounding.

A schedule is a sequence, so one task walks it; it walks block numbers, not
rows, and there are at most about ``MAX_BLOCKS`` of them, plus one a source,
whatever the size of the data: a block has ``block_tokens`` tokens, or as many
more as that takes.  The task keeps the numbers of the sources, no document.
The schedule is a table that the documents join by (source, block).

Block numbers come from running token sums computed in two levels: per
(source, hash range) sums first, then inside each range, whose size is
bounded, so a source holding a third of all rows is spread over many tasks.

Edge cases: a null source is a source of its own; a null or blank text has 0
tokens and goes with its neighbours in hash order; repeated rows are placed
one by one; weights of absent sources are ignored, and a source without a
positive weight gets the smallest one (nothing is dropped).  Columns named
like the result's are replaced; others are kept, whatever their names.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.plans.joins import join_small
from tallyfold.session import materialize

BLOCK_TOKENS = 32_768
MAX_BLOCKS = 1_000_000
RANGE_ROWS = 5_000
#: Units of the integer weights.
UNITS = 1 << 40
_OUT = ("mix_tokens", "mix_block", "mix_slot", "mix_offset")


class Ideal:
    """The ideal stream of sources with integer weights and numbers of blocks:
    when (in slots) it has run a given part of a source."""

    def __init__(self, weights: list[int], blocks: list[int]):
        self.weights, self.blocks = weights, blocks
        # Sources end in the order of blocks / weight.  Until the i-th end the
        # stream has run `done[i]` blocks of ended sources, and the others run
        # with `rate[i]` together.
        order = sorted(range(len(weights)), key=lambda s: Fraction(blocks[s], weights[s]))
        self.ends = [blocks[s] / weights[s] for s in order]
        self.done = [0, *accumulate(blocks[s] for s in order)]
        self.rate = [sum(weights) - x for x in accumulate((weights[s] for s in order), initial=0)]

    def slots(self, source: int, part: int) -> tuple[int, int]:
        """Numerator and denominator of the time at which ``part`` blocks of the
        source have run."""
        w = self.weights[source]
        i = min(bisect_right(self.ends, part / w), len(self.ends) - 1)
        return self.done[i] * w + self.rate[i] * part, w

    def window(self, source: int, block: int) -> tuple[int, int]:
        """Release slot of a block, and the slot before which it must have run."""
        a, w = self.slots(source, block)
        b, _ = self.slots(source, block + 1)
        return a // w, -(-b // w)


def walk(weights: list[int], blocks: list[int]) -> Iterator[tuple[int, int]]:
    """(source, block) of slot 0, 1, ...: the released block of earliest deadline
    first, of equal deadlines the first source's."""
    ideal = Ideal(weights, blocks)
    waiting = [(0, s, 0) for s in range(len(weights)) if blocks[s] > 0]
    ready: list[tuple[int, int, int]] = []
    heapq.heapify(waiting)
    for slot in range(sum(blocks)):
        while waiting and waiting[0][0] <= slot:
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (ideal.window(s, k)[1], s, k))
        _, s, k = heapq.heappop(ready)
        yield s, k
        if k + 1 < blocks[s]:
            heapq.heappush(waiting, (ideal.window(s, k + 1)[0], s, k + 1))


def schedule(sources: DataFrame) -> DataFrame:
    """(``_mk``, ``mix_block``, ``mix_slot``) of all blocks of the sources (``_mk``,
    ``_mu`` integer weight, ``_mb`` blocks), written."""

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights, blocks = [], [], []
        for batch in batches:
            names += batch.column(0).to_pylist()
            weights += batch.column(1).to_pylist()
            blocks += batch.column(2).to_pylist()
        rows: list[tuple[str, int, int]] = []

        def put() -> pa.RecordBatch:
            types = (pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["_mk", "mix_block", "mix_slot"])

        for slot, (s, k) in enumerate(walk(weights, blocks)):
            rows.append((names[s], k, slot))
            if len(rows) == 50_000:
                yield put()
                rows = []
        if rows:
            yield put()

    one = sources.select("_mk", "_mu", "_mb").repartition(1).sortWithinPartitions("_mk")
    return materialize(one.mapInArrow(walked, "_mk string, mix_block long, mix_slot long"), "mix-schedule")


def n_tokens(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _unused(taken: list[str], names: list[str]) -> list[str]:
    """The names, made longer where a column has them already."""
    return [next(n for k in range(len(taken) + 1) if (n := "_" * k + name) not in taken) for name in names]


def mix_sources(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    block_tokens: int = BLOCK_TOKENS,
    smoothing: float = 0.5,
    max_blocks: int = MAX_BLOCKS,
    source_col: str = "source",
    text_col: str = "text",
    id_col: str = "doc_id",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Every row of ``docs`` with ``mix_tokens``, ``mix_block`` (number within
    the source), ``mix_slot`` (global order of blocks) and ``mix_offset`` (order
    inside the block: tokens of the source before it).  Without ``weights`` a
    source's target is its token total to the power ``smoothing``."""
    spark = docs.sparkSession
    cols = [c for c in docs.columns if c not in _OUT]  # an earlier mix is replaced
    key, part, hashed, start, last = _unused(docs.columns, ["_mk", "_mr", "_mh", "_ms", "_ml"])
    keyed = docs.withColumns({
        key: F.when(F.col(source_col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source_col).cast("string"))),
        "mix_tokens": n_tokens(F.col(text_col)),
        hashed: F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)), 1),
    })
    n_rows = docs.select(F.lit(1)).count()
    ranges = max(1, -(-n_rows // range_rows))
    # Ranges of the hash's 31 high bits, so ranges follow the hash order.
    range_of = lambda h: F.shiftright(F.shiftright(h, 32) * F.lit(ranges), 31)
    sums = keyed.groupBy(F.col(key).alias("_mk"), range_of(F.col(hashed)).alias("_mr")).agg(F.sum("mix_tokens").alias("_mt"))
    sums = materialize(sums, "mix-sums")
    totals = sums.groupBy("_mk").agg(F.sum("_mt").alias("t"))
    if weights is None:
        wanted = totals.withColumn("_mw", F.pow(F.col("t").cast("double"), F.lit(float(smoothing))))
    else:
        named = [("n" if k is None else f"s{k}", float(w)) for k, w in weights.items() if w is not None]
        wanted = join_small(totals, spark.createDataFrame(named, "_mk string, _mw double"), "_mk", "left")
    wanted = materialize(wanted, "mix-weights")
    least = wanted.where("_mw > 0").agg(F.min("_mw")).first()[0] or 1.0
    positive = wanted.withColumn("_mw", F.when(F.col("_mw") > 0, F.col("_mw")).otherwise(F.lit(least)))
    all_tokens, all_weight = positive.agg(F.sum("t"), F.sum("_mw")).first()
    size = max(block_tokens, -(-(all_tokens or 0) // max_blocks))
    sources = positive.select(
        "_mk",
        F.greatest(F.lit(1), F.round(F.col("_mw") / F.lit(all_weight or 1.0) * UNITS).cast("long")).alias("_mu"),
        F.greatest(F.lit(1), F.ceil(F.col("t") / size)).cast("long").alias("_mb"),
    )
    sources = materialize(sources, "mix-sources")

    before = Window.partitionBy("_mk").orderBy("_mr").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_mk", "_mr", F.coalesce(F.sum("_mt").over(before), F.lit(0)).alias("_ms"))
    starts = join_small(starts, sources.select("_mk", (F.col("_mb") - 1).alias("_ml")), "_mk")
    starts = starts.select(*[F.col(a).alias(b) for a, b in (("_mk", key), ("_mr", part), ("_ms", start), ("_ml", last))])
    inside = Window.partitionBy(key, part).orderBy(hashed, id_col, "mix_tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        keyed.withColumn(part, range_of(F.col(hashed)))
        .join(starts, [key, part])
        .withColumn("mix_offset", (F.col(start) + F.coalesce(F.sum("mix_tokens").over(inside), F.lit(0))).cast("long"))
        .withColumn("mix_block", F.least(F.floor(F.col("mix_offset") / size), F.col(last)).cast("long"))
    )
    placed = join_small(placed, schedule(sources).withColumnRenamed("_mk", key), [key, "mix_block"])
    return placed.select(*cols, "mix_tokens", "mix_block", "mix_slot", "mix_offset")
