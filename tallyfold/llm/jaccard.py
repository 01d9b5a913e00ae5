"""N-gram Jaccard join by vertical partitioning.

A document's set is its distinct ``n``-word shingles (the whole sequence if it
has fewer words), as 64-bit fingerprints.  Documents of one and the same set
are one class and take part once.

1. The global order of the shingles (by fingerprint) is cut into fragments
   holding about ``fragment_keys`` shingles each.  Every task packs its sets'
   segments by fragment, so what is shuffled is six bytes a shingle.  A
   fragment keeps the shingles found in two sets or more, with the number of
   sets, and drops the rest: they cannot add to any overlap.
2. A set linked with another shares at least ``threshold`` of its shingles, so
   sets with fewer shared ones drop out.  The rest order their shingles by
   rarity; two linked sets share one within the necessary prefix.
3. Links are verified by counting the overlap of each vertical part of the two
   sets apart and summing the counts per pair.
4. Instead of all pairs of a group, each prefix shingle first links its sets
   with its most central one; connected sets then need no further pair, and
   only pairs of sets that are still apart (with length and positional bounds)
   are verified in a second round.  Components are the same as with all pairs:
   a pair left out has both ends in one component already.

Edge cases: null texts and texts without words have the empty set, are linked
with nothing and are their own component; repeated rows are members of one
class; a null id never becomes a component unless no member has one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.components import components
from tallyfold.llm.text import (
    bucket_of, hash_words, mix, pack48, slices, split_words, text_bytes, texts, unpack48, windows, word_ids,
)
from tallyfold.session import materialize

SHINGLE = 5
THRESHOLD_PERCENT = 80
FRAGMENT_KEYS = 2_000_000
#: Sets whose shared shingles meet in one task.
BUCKET_SETS = 10_000
#: Vertical parts of a set in the verification.
PARTS = 4


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle fingerprints of every text of a slice."""
    offsets, flat = split_words(pc.ascii_lower(column))
    ids, vocab = word_ids(flat)
    h = hash_words(vocab)[ids]
    fps = windows(h, n)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= n:
            yield np.unique(fps[a : b - n + 1])
        elif b > a:
            yield windows(h[a:b], b - a) ^ mix(np.array([b - a], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def set_id(keys: np.ndarray) -> int:
    """64-bit fingerprint of a set (free of order, with its size); 0 if empty."""
    if len(keys) == 0:
        return 0
    sums = np.array([mix(keys).sum(dtype=np.uint64), mix(~keys).sum(dtype=np.uint64), len(keys)], np.uint64)
    return int(windows(sums, 3).view(np.int64)[0]) or 1


def full_keys(low: np.ndarray, fragment: int) -> np.ndarray:
    """Shingle keys from their low 48 bits and their fragment."""
    return mix(low ^ mix(np.array([fragment + 1], np.uint64)))


def set_of(text: Column, n: int) -> Column:
    """struct(n_shingles, _set) of a text."""

    @F.arrow_udf("struct<n_shingles:long,_set:long>")
    def described(column: pa.Array) -> pa.Array:
        col, got = texts(column), []
        for a, b in slices(col):
            got += [(len(k), set_id(k)) for k in shingle_sets(col.slice(a, b - a), n)]
        return pa.StructArray.from_arrays([pa.array([g[i] for g in got], pa.int64()) for i in (0, 1)], ["n_shingles", "_set"])

    # Evaluated once a row, below any filter on its result.
    return described.asNondeterministic()(text)


def doc_sets(docs: DataFrame, n: int, text_col: str, id_col: str) -> DataFrame:
    """(id, ``n_shingles``, ``_set``) of every document."""
    return docs.select(F.col(id_col).alias("_id"), set_of(F.col(text_col), n).alias("_d")).select("_id", "_d.*")


def _segments(docs: DataFrame, n: int, fragments: int, text_col: str) -> DataFrame:
    """Per task slice and fragment: the sets, the sizes of their segments, and
    the segments' shingles (low 48 bits; the fragment fixes the high ones)."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = texts(batch.column(0))
            for a, b in slices(col):
                sets = {set_id(k): k for k in shingle_sets(col.slice(a, b - a), n) if len(k)}
                if not sets:
                    continue
                who = np.array(list(sets), np.int64)
                keys = np.concatenate(list(sets.values()))
                size = np.array([len(k) for k in sets.values()], np.int64)
                owner = np.repeat(np.arange(len(who)), size)
                # Fragments that have some: the work follows the shingles,
                # however many fragments there are.
                fragment = bucket_of(keys, fragments)
                order = np.argsort(fragment, kind="stable")
                keys, owner = keys[order], owner[order]
                present, starts = np.unique(fragment[order], return_index=True)
                rows = []
                for f, lo, hi in zip(present.tolist(), starts.tolist(), [*starts[1:].tolist(), len(keys)]):
                    there, first = np.unique(owner[lo:hi], return_index=True)
                    counts = np.diff(np.append(first, hi - lo)).astype("<u4")
                    rows.append((f, who[there].astype("<i8").tobytes(), counts.tobytes(), pack48(keys[lo:hi])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3)]],
                    ["_f", "_who", "_n", "_keys"],
                )

    return docs.select(F.col(text_col).alias("_t")).mapInArrow(packed, "_f int, _who binary, _n binary, _keys binary")


def _set_bucket(sets: np.ndarray, n: int) -> np.ndarray:
    return ((sets.view(np.uint64) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _shared(buckets: int):
    def shared(fragment: pa.Table) -> pa.Table:
        """Of one fragment, packed by bucket of sets: per set its shingles
        that another set has too, with the number of sets."""
        who, sizes, keys = [], [], []
        seen: set[int] = set()
        for w, n, k in zip(*(fragment.column(c).to_pylist() for c in ("_who", "_n", "_keys"))):
            w, n, k = np.frombuffer(w, "<i8"), np.frombuffer(n, "<u4").astype(np.int64), unpack48(k)
            new = np.array([x not in seen for x in w.tolist()])
            seen.update(w.tolist())
            if not new.all():
                k, w, n = k[np.repeat(new, n)], w[new], n[new]
            who.append(w)
            sizes.append(n)
            keys.append(k)
        f = int(fragment.column("_f")[0].as_py())
        who, sizes, keys = np.concatenate(who), np.concatenate(sizes), np.concatenate(keys)
        order = np.sort(keys)
        edge = np.flatnonzero(np.append(True, order[1:] != order[:-1]))
        count = np.diff(np.append(edge, len(order)))
        often = count > 1
        value, count = order[edge[often]], count[often].astype("<u4")
        del order, edge
        where = pc.index_in(pa.array(keys), value_set=pa.array(value))
        hit = where.is_valid().to_numpy(zero_copy_only=False)
        df = count[where.drop_null().to_numpy(zero_copy_only=False)] if len(value) else count
        owner, kept = np.repeat(np.arange(len(who)), sizes)[hit], keys[hit]
        there, n = np.unique(owner, return_counts=True)
        by = _set_bucket(who[there], buckets)
        turn = np.argsort(by, kind="stable")
        begin = np.concatenate([[0], np.cumsum(n)])
        cut = np.concatenate([[0], np.cumsum(np.bincount(by, minlength=buckets))])
        out = []
        for b in np.unique(by).tolist():
            mine = turn[cut[b] : cut[b + 1]]
            at = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in mine])
            out.append((b, f, who[there[mine]].tobytes(), n[mine].astype("<u4").tobytes(), pack48(kept[at]), zstandard.compress(df[at].tobytes(), 1)))
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
        return pa.table([pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)], names=["_b", "_f", "_who", "_n", "_keys", "_df"])

    return shared


def _need(n: int, percent: int) -> int:
    """Least overlap of a set of ``n`` with any set it can be linked to."""
    return -(-percent * n // 100)


_ABLE = "_set long, _size long, _alone long, _mass long, _parts array<binary>, _prefix array<long>"


def _able(percent: int, fragments: int):
    schema = pa.schema([
        *[(c, pa.int64()) for c in ("_set", "_size", "_alone", "_mass")],
        ("_parts", pa.list_(pa.binary())), ("_prefix", pa.list_(pa.int64())),
    ])

    def able(packed: pa.Table, sizes: pa.Table) -> pa.Table:
        """Of one bucket: the sets that share enough shingles to be linked.
        ``_parts`` are their shared shingles by vertical part, ``_prefix``
        those of the necessary prefix, rarest first, after the ``_alone`` that
        no other set has; ``_mass`` tells how much of the set others share."""
        if packed.num_rows == 0 or sizes.num_rows == 0:
            return schema.empty_table()
        owner, keys, df, part = [], [], [], []
        for r in packed.to_pylist():
            n = np.frombuffer(r["_n"], "<u4").astype(np.int64)
            k = full_keys(unpack48(r["_keys"]), r["_f"])
            owner.append(np.repeat(np.frombuffer(r["_who"], "<i8"), n))
            keys.append(k)
            df.append(np.frombuffer(zstandard.decompress(r["_df"]), "<u4"))
            part.append(np.full(len(k), r["_f"] * PARTS // fragments, np.int8))
        owner, keys, df, part = (np.concatenate(x) for x in (owner, keys, df, part))
        order = np.argsort(owner, kind="stable")
        owner, keys, df, part = owner[order], keys[order], df[order].astype(np.int64), part[order]
        edge = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        ends = np.append(edge[1:], len(owner))
        size = dict(zip(sizes.column("_set").to_pylist(), sizes.column("_size").to_pylist()))
        rows = []
        for a, b in zip(edge.tolist(), ends.tolist()):
            who = int(owner[a])
            n = size[who]
            if 100 * (b - a) < percent * n:
                continue
            k, d = keys[a:b], df[a:b]
            alone = n - (b - a)
            take = np.lexsort((k, d))[: max(0, n - _need(n, percent) + 1 - alone)]
            parts = [pack48(k[part[a:b] == v]) for v in range(PARTS)]
            rows.append((who, n, alone, int(d.sum()) * 1000 // n, parts, k[take].view(np.int64).tolist()))
        return pa.table([pa.array([r[i] for r in rows], schema.field(i).type) for i in range(6)], schema=schema)

    return able


def _verify(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets whose Jaccard similarity reaches the threshold:
    overlaps counted per vertical part, summed per pair."""

    @F.arrow_udf("long")
    def overlap(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([len(np.intersect1d(unpack48(x), unpack48(y), assume_unique=True)) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.int64())

    side = lambda s: parts.select(F.col("_set").alias(s), F.col("_v").alias(f"_v{s}"), F.col("_keys").alias(f"_k{s}"), F.col("_size").alias(f"_n{s}"))
    met = pairs.select("a", "b").join(side("a"), "a").join(side("b").withColumnRenamed("_vb", "_va"), ["b", "_va"])
    total = met.select("a", "b", "_na", "_nb", overlap("_ka", "_kb").alias("_o")).groupBy("a", "b", "_na", "_nb").agg(F.sum("_o").alias("_o"))
    return total.where(100 * F.col("_o") >= percent * (F.col("_na") + F.col("_nb") - F.col("_o"))).select("a", "b")


def jaccard_links(docs: DataFrame, sets: DataFrame, n: int, percent: int, fragment_keys: int, text_col: str) -> DataFrame:
    """Links (a, b) between different sets that give the same components as
    all links would."""
    # About one shingle for every six bytes of text.
    fragments = max(1, -(-text_bytes(docs, text_col) // (6 * fragment_keys)))
    sizes = materialize(sets.select("_set", F.col("n_shingles").alias("_size")).where("_size > 0").distinct(), "jaccard-sizes")
    buckets = max(1, -(-sizes.count() // BUCKET_SETS))
    shared = (
        _segments(docs, n, fragments, text_col)
        .groupBy("_f")
        .applyInArrow(_shared(buckets), "_b long, _f int, _who binary, _n binary, _keys binary, _df binary")
    )
    bucket = F.shiftrightunsigned(F.shiftrightunsigned("_set", 32) * F.lit(buckets), 32)
    able = materialize(
        shared.groupBy("_b").cogroup(sizes.withColumn("_b", bucket).groupBy("_b")).applyInArrow(_able(percent, fragments), _ABLE),
        "jaccard-able",
    )
    parts = able.select("_set", "_size", F.posexplode("_parts").alias("_v", "_keys"))
    postings = able.select("_set", "_size", "_mass", "_alone", F.posexplode("_prefix").alias("_i", "_key")).withColumn("_at", F.col("_alone") + F.col("_i"))

    # Round 1: each shingle's sets against its most central one.
    centre = postings.groupBy("_key").agg(F.max(F.struct("_mass", F.col("_set").alias("s"), F.col("_size").alias("n"))).alias("_c"), F.count(F.lit(1)).alias("_m")).where("_m > 1")
    near = lambda x, y: (100 * F.least(x, y) >= percent * F.greatest(x, y))
    star = materialize(
        postings.join(centre, "_key")
        .where(F.col("_set") != F.col("_c.s"))
        .where(near(F.col("_size"), F.col("_c.n")))
        .select(F.least("_set", "_c.s").alias("a"), F.greatest("_set", "_c.s").alias("b"))
        .distinct(),
        "jaccard-star",
    )
    first = materialize(_verify(star, parts, percent), "jaccard-links")
    group = components(first, "a", "b")

    # Round 2: pairs that share a prefix shingle and are still apart.
    placed = postings.join(group.select(F.col("node").alias("_set"), "component"), "_set", "left").withColumn("_g", F.coalesce("component", "_set"))
    mixed = placed.groupBy("_key").agg(F.min("_g").alias("_lo"), F.max("_g").alias("_hi")).where("_lo < _hi").select("_key")
    open_ = materialize(placed.join(mixed, "_key").select("_key", "_set", "_size", "_at", "_g"), "jaccard-open")
    side = lambda s: open_.select("_key", *[F.col(c).alias(f"{c}{s}") for c in ("_set", "_size", "_at", "_g")])
    need = F.ceil((F.col("_sizea") + F.col("_sizeb")) * percent / (100.0 + percent) - 1e-9)
    # This shingle is the first in common, or the pair comes up by that one.
    room = F.least(F.col("_sizea") - F.col("_ata"), F.col("_sizeb") - F.col("_atb"))
    rest = (
        side("a").join(side("b"), "_key")
        .where("_seta < _setb and _ga <> _gb")
        .where(near(F.col("_sizea"), F.col("_sizeb")) & (room >= need))
        .select(F.col("_seta").alias("a"), F.col("_setb").alias("b"))
        .distinct()
    )
    second = _verify(rest.join(star, ["a", "b"], "left_anti"), parts, percent)
    return first.unionByName(second)


def jaccard_groups(
    docs: DataFrame,
    n: int = SHINGLE,
    percent: int = THRESHOLD_PERCENT,
    text_col: str = "text",
    id_col: str = "doc_id",
    fragment_keys: int = FRAGMENT_KEYS,
) -> DataFrame:
    """Per document ``_id``, ``n_shingles``, ``_set`` (its set's fingerprint,
    0 if empty), ``_group`` (one of the sets of its component) and
    ``component_id``."""
    sets = materialize(doc_sets(docs, n, text_col, id_col), "jaccard-sets")
    links = materialize(jaccard_links(docs, sets, n, percent, fragment_keys, text_col), "jaccard-all-links")
    group = components(links, "a", "b")
    least = sets.where("n_shingles > 0").groupBy("_set").agg(F.min("_id").alias("_m"))
    named = least.join(group.select(F.col("node").alias("_set"), "component"), "_set", "left")
    of_group = named.where("component is not null").groupBy("component").agg(F.min("_m").alias("_gm"))
    label = named.join(of_group, "component", "left").select(
        "_set", F.coalesce("component", "_set").alias("_group"), F.coalesce("_gm", "_m").alias("component_id")
    )
    return sets.join(label, "_set", "left").select(
        "_id", "n_shingles", "_set", "_group", F.coalesce("component_id", "_id").alias("component_id")
    )


def jaccard_components(
    docs: DataFrame,
    n: int = SHINGLE,
    percent: int = THRESHOLD_PERCENT,
    text_col: str = "text",
    id_col: str = "doc_id",
    fragment_keys: int = FRAGMENT_KEYS,
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (the
    smallest id reachable by links of similarity ``percent`` or more)."""
    groups = jaccard_groups(docs, n, percent, text_col, id_col, fragment_keys)
    return groups.select(F.col("_id").alias(id_col), "n_shingles", "component_id")


def keep_one(docs: DataFrame, n: int = SHINGLE, percent: int = THRESHOLD_PERCENT, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component left, the one of smallest id
    (of rows repeating that id, one); rows with the empty set all stay."""
    groups = jaccard_groups(docs, n, percent, text_col, id_col)
    keep = (
        groups.where("n_shingles > 0")
        .groupBy("_group")
        .agg(F.min(F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_set").alias("s"))).alias("_k"))
        .select(F.col("_k.i").alias("_ki"), F.col("_k.s").alias("_ks"))
    )
    cols = docs.columns
    marked = docs.withColumn("_tf_set", set_of(F.col(text_col), n)["_set"])
    # The set is unique to its keeper, so it alone decides; the id picks the row.
    kept = (
        marked.where("_tf_set <> 0")
        .join(keep, (F.col("_tf_set") == F.col("_ks")) & F.col(id_col).eqNullSafe(F.col("_ki")))
        .dropDuplicates(["_tf_set"])
    )
    return kept.select(*cols).unionByName(marked.where("_tf_set = 0").select(*cols))
