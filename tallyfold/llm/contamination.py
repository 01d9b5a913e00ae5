"""Benchmark decontamination: a prefix-filtered set join, DataFrame functions
only.

Every benchmark item is cut into windows of ``window`` consecutive words (an
item of fewer words is one window).  A document is hit where it contains all
words of a window, in order and side by side: containment 1, so the necessary
prefix of a window, its words ordered by rarity, is the single rarest one.
Rarity is counted over all documents, by the benchmark's vocabulary.

The document words are joined with the prefix words alone; a match gives the
place the window would have to stand in, which must lie inside the document
(positional and length bounds), and the words there are compared with the
whole window (exact check).  Of a run of windows that occur one after another
only the first and the last are put out.  Explode, join and check are one
generated stage, so a document's word array is never copied for a word of it,
and nothing but the ends of matching runs is shuffled.

The window table is broadcast in blocks of at most ``broadcast_bytes``, sized
from its measured bytes: a larger benchmark takes more passes over the
documents, never a larger broadcast.

Edge cases: a null text has no words; a document without hits has 0 items and
the digest of the empty string; rows that repeat an id are judged each by its
own text; empty tables give empty results, an empty benchmark no hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.plans.joins import row_bytes
from tallyfold.session import materialize

WINDOW = 10
BROADCAST_BYTES = 64 << 20

# A word before lower-casing; A-Z becomes a-z, nothing else changes case.  The
# characters between words, all but letters and digits of ASCII's, are listed one
# by one: Java looks single characters up in one table, ranges it tries in turn.
_WORD = "[^" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_WORD), F.lit(0))


def _key(word: str) -> Column:
    """What words are joined by, the same for any case: a number, as joins look
    numbers up without making a row of each."""
    return F.xxhash64(F.lower(word))


def _keyed(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """Id, a digest that tells rows of one id apart, and the words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(text).alias("_h"), F.octet_length(text).alias("_b"), words(F.col(text_col)).alias("_w")
    )


def item_classes(items: DataFrame, text_col: str, item_col: str) -> DataFrame:
    """Distinct word sequences of the items: ``_c`` (a number), ``_w`` (the
    words) and ``_items``."""
    found = (
        items.select(F.col(item_col).alias("_i"), words(F.translate(F.col(text_col), _UPPER, _LOWER)).alias("_w"))
        .where(F.size("_w") > 0)
        .groupBy(F.concat_ws(" ", "_w").alias("_t"))
        .agg(F.collect_set("_i").alias("_items"))
    )
    return materialize(found.select(F.monotonically_increasing_id().alias("_c"), F.split("_t", " ").alias("_w"), "_items"), "item-classes")


def _windows(classes: DataFrame, window: int) -> DataFrame:
    """``_c``, ``_s`` (start), ``_n`` (words), ``_x`` (the words) and the words
    of the item beside the window (null at its ends)."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("_w") - window, F.lit(0)))
    return classes.select("_c", "_w", F.explode(starts).alias("_s")).select(
        "_c", "_s",
        F.least(F.size("_w"), F.lit(window)).alias("_n"),
        F.slice("_w", F.col("_s") + 1, window).alias("_x"),
        F.get("_w", F.col("_s") - 1).alias("_prev"),
        F.get("_w", F.col("_s") + window).alias("_next"),
    )


def _blocks(table: DataFrame, broadcast_bytes: int) -> list[DataFrame]:
    """A table with column ``_k`` in parts that may each be broadcast."""
    size = table.agg(F.sum(row_bytes(table).cast("long"))).first()[0] or 0
    n = max(1, -(-size // broadcast_bytes))
    return [table] if n == 1 else [table.where(F.pmod(F.xxhash64("_k"), F.lit(n)) == i) for i in range(n)]


def prefix_words(docs: DataFrame, classes: DataFrame, window: int, broadcast_bytes: int, text_col: str) -> DataFrame:
    """One row per window: the hash ``_k`` of its rarest word (any case), the
    word's offset ``_o``, the window and what is beside it.  Windows with a word
    that no document has are left out.  (Words of one hash are counted as one:
    their windows may stay in, or have a prefix less rare than another.)"""
    found = _windows(classes, window)
    placed = found.select("_c", "_s", F.posexplode("_x").alias("_o", "_p")).withColumn("_k", _key("_p"))
    vocabulary = materialize(placed.select("_k").distinct(), "window-words")
    seen = docs.select(F.explode(words(F.col(text_col))).alias("_p")).select(_key("_p").alias("_k"))
    counts = reduce(
        DataFrame.unionByName,
        [seen.join(F.broadcast(b), "_k", "left_semi").groupBy("_k").agg(F.count(F.lit(1)).alias("_n")) for b in _blocks(vocabulary, broadcast_bytes)],
    )
    rarest = (
        placed.join(counts, "_k", "left")
        .groupBy("_c", "_s")
        .agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_k").alias("k"), F.col("_o").alias("o"))).alias("_r"))
    )
    return materialize(
        found.join(rarest, ["_c", "_s"])
        .where("_r.n > 0")
        .select(
            F.col("_r.k").alias("_k"), F.col("_r.o").alias("_o"), "_c", "_s", "_n", F.concat_ws(" ", "_x").alias("_t"),
            F.lower(F.get("_x", F.lit(0))).alias("_first"), "_prev", "_next",
        ),
        "prefix-words",
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    text_col: str = "text",
    id_col: str = "doc_id",
    item_text_col: str = "text",
    item_col: str = "item_id",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_hit`` (words inside
    occurring windows), ``items`` (those with occurring windows, sorted as
    strings), ``spans`` (hit word ranges, end exclusive) and the row digest
    columns ``_h``, ``_b``."""
    classes = item_classes(items, item_text_col, item_col)
    table = prefix_words(docs, classes, window, broadcast_bytes, text_col)
    keyed = _keyed(docs, text_col, id_col)
    spread = keyed.select("_id", "_h", "_b", F.col("_w").alias("_all"), F.posexplode("_w").alias("_pos", "_word")).withColumn("_wk", _key("_word"))

    at = F.col("_pos") - F.col("_o")
    same = lambda a, b: F.translate(a, _UPPER, _LOWER).eqNullSafe(b)
    first = F.col("_prev").isNull() | ~same(F.get("_all", at - 1), F.col("_prev"))
    last = F.col("_next").isNull() | ~same(F.get("_all", at + F.col("_n")), F.col("_next"))
    there = F.concat_ws(" ", F.slice("_all", F.greatest(at, F.lit(0)) + 1, F.col("_n")))
    fits = (
        (F.col("_wk") == F.col("_k"))
        & (at >= 0)
        & (at + F.col("_n") <= F.size("_all"))
        & (F.lower(F.get("_all", at)) == F.col("_first"))
        & same(there, F.col("_t"))
        & (first | last)
    )
    ends = reduce(
        DataFrame.unionByName,
        [
            spread.join(F.broadcast(b), fits).select(
                "_id", "_h", "_b", "_c", (at - F.col("_s")).alias("_d"), at.alias("_a"), (at + F.col("_n")).alias("_e"), first.alias("_first"), last.alias("_last")
            )
            for b in _blocks(table, broadcast_bytes)
        ],
    )
    # Along one alignment of item and document runs start and end in turn.
    runs = ends.groupBy("_id", "_h", "_b", "_c", "_d").agg(
        F.sort_array(F.collect_list(F.when(F.col("_first"), F.col("_a")))).alias("_as"),
        F.sort_array(F.collect_list(F.when(F.col("_last"), F.col("_e")))).alias("_es"),
    )
    ranges = F.zip_with("_as", "_es", lambda a, e: F.struct(a.alias("a"), e.alias("e")))
    per_doc = (
        runs.select("_id", "_h", "_b", "_c", ranges.alias("_s"))
        .groupBy("_id", "_h", "_b", "_c").agg(F.flatten(F.collect_list("_s")).alias("_s"))
        .join(classes.select("_c", "_items"), "_c")
        .groupBy("_id", "_h", "_b")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_s")))).alias("_s"), F.flatten(F.collect_list("_items")).alias("_i"))
    )
    # Ranges in order of their starts: join those that touch.
    top = lambda acc: F.try_element_at(acc, F.lit(-1))
    joined = F.aggregate(
        "_s",
        F.expr("cast(array() as array<struct<a:int,e:int>>)"),
        lambda acc, s: F.when(
            s.a <= F.coalesce(top(acc).e, F.lit(-1)),
            F.concat(
                F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(F.struct(top(acc).a.alias("a"), F.greatest(top(acc).e, s.e).alias("e"))),
            ),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    hits = per_doc.select(
        F.col("_id").alias("_hid"), F.col("_h").alias("_hh"), F.col("_b").alias("_hb"),
        joined.alias("_s"), F.array_sort(F.transform("_i", lambda x: x.cast("string"))).alias("_i"),
    )
    sizes = keyed.select("_id", "_h", "_b", F.size("_w").cast("long").alias("n_words"))
    on = F.col("_id").eqNullSafe(F.col("_hid")) & (F.col("_h") == F.col("_hh")) & (F.col("_b") == F.col("_hb"))
    spans = F.coalesce("_s", F.expr("cast(array() as array<struct<a:int,e:int>>)"))
    return sizes.join(hits, on, "left").select(
        F.col("_id").alias(id_col),
        "n_words",
        F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + (s.e - s.a)).alias("n_hit"),
        F.coalesce("_i", F.expr("cast(array() as array<string>)")).alias("items"),
        spans.alias("spans"),
        "_h",
        "_b",
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that hold a window of an item."""
    bad = contamination(docs, items, window, text_col, id_col).where("n_hit > 0").select(F.col(id_col).alias("_bi"), F.col("_h").alias("_bh"), F.col("_b").alias("_bb"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    on = F.col(id_col).eqNullSafe(F.col("_bi")) & (F.xxhash64(text) == F.col("_bh")) & (F.octet_length(text) == F.col("_bb"))
    return docs.join(bad.distinct(), on, "left_anti")
