"""Language-model scores by deleted interpolation.

The probability of a token after the two before it is a mixture of the
maximum-likelihood estimates of its trigram, bigram and unigram and of the
uniform distribution.  The mixture weights depend on how often the context was
seen (buckets by the power of two of its count) and are learned by
expectation-maximisation on deleted data: the documents of one part of the
training rows, scored with the counts of all others.

How the counts travel: documents are kept as compressed chunks.  A chunk's
distinct n-grams, sorted fingerprints packed as differences (about four bytes
each), are shuffled with their counts into buckets of the key space, summed
there over all chunks, and the totals go back to the chunks in the order the
keys were sent in, so no key is sent twice and a frequent n-gram is one entry
a chunk at most.  Fingerprints have 24 bits more than the number of tokens
takes, so the share of n-grams that collide stays below 2**-24 at any size.  Every n-gram of every training
document counts.  Expectation-maximisation runs on a histogram of the deleted
tokens (context bucket x binary orders of magnitude of the three estimates,
with the means of their logarithms): its size is bounded by its cells,
``CONTEXTS * LEVELS**3``, and not by the data.

Edge cases: a null text is the empty text (one end token); a document without
id counts as training data and is not held out; with no training rows every
estimate but the uniform one is missing and it gets all the weight; rows that
repeat are scored and counted each time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.text import (
    bucket_of, chunk_table, chunk_texts, crc_mod, hash_words, mix, pack_sorted, split_words, text_bytes, unpack_sorted, windows, word_ids,
)
from tallyfold.session import materialize

BUCKET_KEYS = 2_000_000
CHUNK_BYTES = 6 << 20
ORDERS = (1, 2, 3)
COUNTED, DELETED, HELD_OUT = 0, 1, 2

LEVELS = 31  # powers of two an estimate may lie in: 1 to 2**-30 and below
_FREQUENCIES = 24
CONTEXTS = 1 + 2 * _FREQUENCIES

_BOS = mix(np.array([11, 12], np.uint64))  # two marks before a text
_END = mix(np.array([13], np.uint64))


class _Grams:
    """The n-grams of a chunk: its tokens padded per text, the distinct keys
    of each order and, per place, the number of its key."""

    def __init__(self, row: dict):
        self.ids = row["_ids"]
        offsets, flat = split_words(pc.ascii_lower(chunk_texts(row["_len"], row["_blob"])))
        coded, vocab = word_ids(flat)
        n = np.diff(offsets)
        self.n_tokens = n + 1
        starts = np.concatenate([[0], np.cumsum(n + 3)])  # two marks, words, end
        h = np.empty(starts[-1], np.uint64)
        h[starts[:-1]], h[starts[:-1] + 1], h[starts[1:] - 1] = _BOS[0], _BOS[1], _END[0]
        word = np.ones(len(h), bool)
        word[starts[:-1]] = word[starts[:-1] + 1] = word[starts[1:] - 1] = False
        h[word] = hash_words(vocab)[coded]
        #: Places of the real tokens (words and ends).
        token = np.ones(len(h), bool)
        token[starts[:-1]] = token[starts[:-1] + 1] = False
        self.at = np.flatnonzero(token)
        self.text = np.concatenate([[0], np.cumsum(self.n_tokens)])
        # An order's keys are those of n-grams inside one text.
        inside = {1: np.ones(len(h), bool), 2: np.ones(len(h), bool), 3: token}
        inside[2][starts[:-1]] = False
        self.keys, self.index, self.count = {}, {}, {}
        for k in ORDERS:
            ends = np.flatnonzero(inside[k])
            coded_keys = pa.array((mix(h) if k == 1 else windows(h, k))[ends - k + 1]).dictionary_encode()
            index = np.full(len(h), -1)
            index[ends] = coded_keys.indices.to_numpy(zero_copy_only=False)
            self.index[k] = index
            self.keys[k] = coded_keys.dictionary.to_numpy().astype(np.uint64)
            self.count[k] = np.bincount(index[ends], minlength=len(self.keys[k]))


def _sorted(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, dict[int, tuple[int, int]]]:
    """The order of keys by value, and the range of each bucket that has some:
    the work follows the keys, however many buckets there are."""
    order = np.argsort(keys)
    present, first = np.unique(bucket_of(keys[order], buckets), return_index=True)
    stops = [*first[1:].tolist(), len(keys)]
    return order, {b: (lo, hi) for b, lo, hi in zip(present.tolist(), first.tolist(), stops)}


def _counts(chunks: DataFrame, buckets: int, bits: int) -> DataFrame:
    """Per chunk, order and bucket: the distinct keys and their counts."""
    low = np.uint64(64 - bits)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                g, rows = _Grams(row), []
                for k in ORDERS:
                    order, ranges = _sorted(g.keys[k], buckets)
                    keys, count = g.keys[k][order], g.count[k][order].astype("<u4")
                    for b, (lo, hi) in ranges.items():
                        n = zstandard.compress(count[lo:hi].tobytes(), 1)
                        rows.append((k, b, row["_chunk"], row["_part"], pack_sorted(keys[lo:hi] >> low), n))
                kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["_k", "_b", "_chunk", "_part", "_keys", "_n"]
                )

    return chunks.mapInArrow(sent, "_k int, _b int, _chunk long, _part int, _keys binary, _n binary")


def _totals(group: pa.Table) -> pa.Table:
    """Totals of one bucket, to each chunk for the keys it sent: over all
    training rows and over the deleted ones.  One more row has the distinct
    keys and the sums."""
    rows = group.to_pylist()
    keys = [unpack_sorted(r["_keys"]) for r in rows]
    coded = pa.array(np.concatenate(keys)).dictionary_encode()
    index, n = coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary)
    every, deleted, at = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
    places = []
    for r, k in zip(rows, keys):
        mine = index[at : at + len(k)]
        at += len(k)
        places.append(mine)
        if r["_part"] != HELD_OUT:
            count = np.frombuffer(zstandard.decompress(r["_n"]), "<u4").astype(np.int64)
            np.add.at(every, mine, count)
            if r["_part"] == DELETED:
                np.add.at(deleted, mine, count)
    small = lambda x: zstandard.compress(x.astype("<u8").tobytes(), 3)
    out = [(r["_chunk"], r["_k"], r["_b"], small(every[p]), small(deleted[p]) if r["_part"] == DELETED else None, 0, 0, 0) for r, p in zip(rows, places)]
    out.append((-1, rows[0]["_k"], rows[0]["_b"], None, None, int((every > 0).sum()), int(every.sum()), int(deleted.sum())))
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = ["_chunk", "_k", "_b", "_all", "_del", "_distinct", "_sum", "_sumdel"]
    return pa.table([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=names)


_TOTALS = "_chunk long, _k int, _b int, _all binary, _del binary, _distinct long, _sum long, _sumdel long"


def _returned(g: _Grams, totals: pa.Table, buckets: int, column: str) -> dict[int, np.ndarray]:
    """Totals by key number, back in the chunk's own order."""
    out = {k: np.zeros(len(g.keys[k]), np.int64) for k in ORDERS}
    cuts = {k: _sorted(g.keys[k], buckets) for k in ORDERS}
    for k, b, blob in zip(*(totals.column(c).to_pylist() for c in ("_k", "_b", column))):
        order, ranges = cuts[k]
        out[k][order[slice(*ranges[b])]] = np.frombuffer(zstandard.decompress(blob), "<u8").astype(np.int64)
    return out


def _estimates(g: _Grams, c: dict[int, np.ndarray], total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: its context's bucket, the three estimates (0 where the
    context is unseen) and the token's count."""
    at = g.at
    own = [c[k][g.index[k][at]] for k in ORDERS]
    before = [np.full(len(at), total), c[1][g.index[1][at - 1]], c[2][g.index[2][at - 1]]]
    p = np.stack([np.divide(a, b, out=np.zeros(len(at)), where=b > 0) for a, b in zip(own, before)], 1)
    level = lambda x: np.minimum(np.log2(np.maximum(x, 1)).astype(np.int64), _FREQUENCIES - 1)
    context = np.where(before[2] > 0, 1 + _FREQUENCIES + level(before[2]), np.where(before[1] > 0, 1 + level(before[1]), 0))
    return context, p, own[0]


def _histogram(buckets: int, total: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    names = ["_cell", "_w", "_l1", "_l2", "_l3"]

    def cells(chunk: pa.Table, totals: pa.Table) -> pa.Table:
        """Deleted tokens by cell, with their counts taken out."""
        g = _Grams(chunk.to_pylist()[0])
        every, deleted = _returned(g, totals, buckets, "_all"), _returned(g, totals, buckets, "_del")
        context, p, _ = _estimates(g, {k: every[k] - deleted[k] for k in ORDERS}, total)
        logs = np.log2(np.maximum(p, 2.0**-60))
        level = np.where(p > 0, np.minimum(np.floor(-logs).astype(np.int64), LEVELS - 2), LEVELS - 1)
        cell = ((context * LEVELS + level[:, 0]) * LEVELS + level[:, 1]) * LEVELS + level[:, 2]
        at, inverse = np.unique(cell, return_inverse=True)
        sums = [np.bincount(inverse, weights=w, minlength=len(at)) for w in (None, logs[:, 0], logs[:, 1], logs[:, 2])]
        return pa.table([pa.array(at), *[pa.array(s.astype(float)) for s in sums]], names=names)

    return cells


def learn_weights(cells: list[tuple[int, float, float, float, float]], uniform: float, rounds: int = 40) -> np.ndarray:
    """Mixture weights (contexts x [uniform, unigram, bigram, trigram]) by
    expectation-maximisation on histogram cells.  Contexts with few events use
    the weights of all contexts of their order."""
    order = np.array([0] + [1] * _FREQUENCIES + [2] * _FREQUENCIES)
    allowed = np.array([[1, 1, o >= 1, o >= 2] for o in order], float)
    out = allowed / allowed.sum(1, keepdims=True)
    if not cells:
        return out
    x = np.array(cells, float)
    cell = x[:, 0].astype(np.int64)
    levels = np.stack([cell // LEVELS**2 % LEVELS, cell // LEVELS % LEVELS, cell % LEVELS], 1)
    p = np.where(levels == LEVELS - 1, 0.0, 2.0 ** (x[:, 2:5] / x[:, 1:2]))
    p = np.concatenate([np.full((len(x), 1), uniform), p], 1)
    context, weight = cell // LEVELS**3, x[:, 1]

    def fit(group: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lam = start.copy()
        for _ in range(rounds):
            r = lam[group] * p
            r *= (weight / np.maximum(r.sum(1), 1e-300))[:, None]
            new = np.stack([np.bincount(group, weights=r[:, i], minlength=len(lam)) for i in range(4)], 1)
            n = new.sum(1)
            lam = np.where(n[:, None] > 0, new / np.maximum(n, 1e-300)[:, None], lam)
        return lam, np.bincount(group, weights=weight, minlength=len(lam))

    pooled, _ = fit(order[context], np.array([[1, 1, o >= 1, o >= 2] for o in range(3)], float) / np.array([[2], [3], [4]]))
    lam, seen = fit(context, out)
    lam = np.where(seen[:, None] >= 100, lam, pooled[order]) * allowed
    lam[:, 0] = np.maximum(lam[:, 0], 1e-6)
    return lam / lam.sum(1, keepdims=True)


def _scores(buckets: int, lam: np.ndarray, total: int, distinct: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def scored(chunk: pa.Table, totals: pa.Table) -> pa.Table:
        row = chunk.to_pylist()[0]
        g = _Grams(row)
        context, p, count = _estimates(g, _returned(g, totals, buckets, "_all"), total)
        mixed = (lam[context, 1:] * p).sum(1) + lam[context, 0] / (distinct + 1)
        sums = lambda x: np.add.reduceat(x, g.text[:-1]) if len(g.ids) else np.zeros(0)
        n = len(g.ids)
        return pa.table([
            pa.array(g.ids, pa.int64()), pa.array(np.full(n, row["_part"] == HELD_OUT)), pa.array(g.n_tokens),
            pa.array(sums((count > 0).astype(np.int64)).astype(np.int64)), pa.array(np.full(n, total)),
            pa.array(sums(np.log10((count + 1) / (total + distinct + 1)))), pa.array(sums(np.log10(mixed))),
        ], names=["_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return scored


def score_texts(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    modulus: int = 7,
    held_out: int = 2,
    deleted: int = 3,
    bucket_keys: int = BUCKET_KEYS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` (add-one unigram) and ``score``, log10
    probabilities.  Documents whose crc32 of the id modulo ``modulus`` is
    ``held_out`` are scored only; those with ``deleted`` also set the weights."""
    fold = crc_mod(id_col, modulus)
    part = F.when(fold == held_out, HELD_OUT).when(fold == deleted, DELETED).otherwise(COUNTED)
    chunks = chunk_table(docs, "lm-chunks", text_col, id_col, part, chunk_bytes)
    size = text_bytes(docs, text_col)
    buckets = max(1, -(-size // (6 * bucket_keys)))
    bits = min(64, 24 + (size // 6 + 2).bit_length())
    totals = materialize(_counts(chunks, buckets, bits).groupBy("_k", "_b").applyInArrow(_totals, _TOTALS), "lm-totals")
    sums = totals.where("_chunk = -1 and _k = 1").agg(F.sum("_distinct"), F.sum("_sum"), F.sum("_sumdel")).first()
    # The unigram sums hold two marks a text besides the tokens.
    texts = chunks.groupBy("_part").agg(F.sum(F.size("_ids"))).collect()
    n = {r[0]: r[1] for r in texts}
    marks = 2 * (n.get(COUNTED, 0) + n.get(DELETED, 0))
    total = (sums[1] or 0) - marks
    distinct = (sums[0] or 0) - (2 if marks else 0)
    kept_total = total - ((sums[2] or 0) - 2 * n.get(DELETED, 0))
    back = totals.where("_chunk >= 0").select("_chunk", "_k", "_b", "_all", "_del")
    cells = (
        chunks.where(F.col("_part") == DELETED).groupBy("_chunk")
        .cogroup(back.where(F.col("_del").isNotNull()).groupBy("_chunk"))
        .applyInArrow(_histogram(buckets, kept_total), "_cell long, _w double, _l1 double, _l2 double, _l3 double")
        .groupBy("_cell").agg(*[F.sum(c).alias(c) for c in ("_w", "_l1", "_l2", "_l3")])
    )
    lam = learn_weights([tuple(r) for r in cells.collect()], 1 / (distinct + 1))
    return (
        chunks.groupBy("_chunk").cogroup(back.drop("_del").groupBy("_chunk"))
        .applyInArrow(
            _scores(buckets, lam, total, distinct),
            "_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
        .withColumnRenamed("_id", id_col)
    )
