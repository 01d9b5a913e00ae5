"""Substring dedup by prefix-partitioned suffix trees.

Words that lie in a run of ``length`` words that also starts in a document
with a smaller id are removed; runs are judged on the input.

A suffix takes part with its first ``length`` words.  Suffixes are split into
groups by a prefix of words that starts at the suffix's anchor: the eight-word
gram of smallest fingerprint among those in its first ``length`` words.  Equal
runs have equal anchors at equal places, so no repeat is split between groups.
Neighbouring suffixes share their anchor and travel as one segment (their
common text, four bytes a word), not as one copy of the text each.

* Anchors found in one document only are leaves: their suffixes are dropped
  before any text is shuffled.
* Equal segments of a chunk collapse to one with the smallest id, so a passage
  that a third of all documents share is one segment a chunk.
* Anchors are packed into groups of about ``task_segments`` segments.  An
  anchor with more than ``group_segments`` gets a longer prefix: each of its
  suffixes is told apart by all of its ``length`` words, and the nodes they
  end in are combined map-side (smallest id), no text and no group at all.
* In each group the suffix tree is built over the segments' words by prefix
  doubling (names of 1, 2, 4 ... words, then of ``length`` words).  A node of
  depth ``length`` with suffixes of several documents lies above a repeat; it
  passes the smallest id below it to its suffixes.  Overlapping runs join into
  the maximal repeated spans.

Edge cases: null texts have no words; a document without an id neither loses
words nor makes others lose any; rows that repeat an id do not count against
each other; words are compared unchanged, through 32-bit word hashes over
whole runs and a 64-bit anchor.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.text import chunk_table, chunk_texts, hash_words, mix, split_words, windows, word_ids
from tallyfold.session import materialize

LENGTH = 50
GRAM = 8
GROUP_SEGMENTS = 20_000
TASK_SEGMENTS = 20_000

_PLACE = np.uint64((1 << 28) - 1)


class _Chunk:
    """The words of a chunk and the segments of its suffixes."""

    def __init__(self, row: dict, length: int):
        self.ids = row["_ids"]
        self.offsets, self.flat = split_words(chunk_texts(row["_len"], row["_blob"]))
        ids, vocab = word_ids(self.flat)
        self.h = hash_words(vocab)[ids]
        self.n = np.diff(self.offsets)
        self.length = length
        self._segments()

    def _segments(self) -> None:
        """Runs of suffix starts ``first``..``last`` with one anchor."""
        k, span = self.length, self.length - GRAM + 1
        doc = np.repeat(np.arange(len(self.n)), self.n)
        grams = windows(self.h, GRAM)
        empty = np.zeros(0, np.int64)
        self.first = self.last = self.doc = empty
        self.anchor = np.zeros(0, np.uint64)
        if len(self.h) < k:
            return
        low = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        size = 1
        while size * 2 <= span:  # minimum over `span` grams, by doubling
            low = np.minimum(low[: len(low) - size], low[size:])
            size *= 2
        low = np.minimum(low[: len(low) - (span - size)], low[span - size :])
        m = len(self.h) - k + 1
        starts = np.flatnonzero(doc[:m] == doc[k - 1 :])
        named = np.array([i is not None for i in self.ids])
        starts = starts[named[doc[starts]]]
        if len(starts) == 0:
            return
        at = (low[starts] & _PLACE).astype(np.int64)
        cut = np.flatnonzero((np.diff(at) != 0) | (np.diff(starts) != 1) | (np.diff(doc[starts]) != 0)) + 1
        edge = np.concatenate([[0], cut, [len(starts)]])
        self.first, self.last = starts[edge[:-1]], starts[edge[1:] - 1]
        self.doc = doc[self.first]
        self.anchor = grams[at[edge[:-1]]]

    def owners(self) -> np.ndarray:
        """The document id of every segment."""
        return np.array([-1 if i is None else i for i in self.ids], np.int64)[self.doc] if len(self.doc) else self.doc

    def names(self) -> np.ndarray:
        """A 64-bit fingerprint of every segment's words."""
        power = np.uint64(0x9E3779B97F4A7C15)
        size = self.last - self.first + self.length
        out = mix(size.astype(np.uint64))
        left = np.arange(len(size))
        for j in range(int(size.max()) if len(size) else 0):  # word by word, all segments at once
            left = left[size[left] > j]
            out[left] = out[left] * power + self.h[self.first[left] + j]
        return mix(out).view(np.int64)

    def suffixes(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, fingerprints (of their first ``length`` words) and owners
        of the suffixes of some segments."""
        n = self.last[which] - self.first[which] + 1
        at = np.repeat(self.first[which] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return at, mix(~windows(self.h, self.length)[at]).view(np.int64), np.repeat(self.owners()[which], n)


def _least(names: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The places that hold the smallest id of each name."""
    order = np.lexsort((ids, names))
    return order[np.append(True, names[order][1:] != names[order][:-1])] if len(order) else order


def _anchors(chunks: DataFrame, length: int) -> DataFrame:
    """(anchor, chunk, smallest and largest id, segments) of every chunk."""

    def found(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = _Chunk(row, length)
                if len(c.anchor) == 0:
                    continue
                keys, inverse = np.unique(c.anchor, return_inverse=True)
                ids = c.owners()
                lo, hi = np.full(len(keys), np.iinfo(np.int64).max), np.full(len(keys), np.iinfo(np.int64).min)
                np.minimum.at(lo, inverse, ids)
                np.maximum.at(hi, inverse, ids)
                n = np.bincount(inverse[_least(c.names(), ids)], minlength=len(keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), row["_chunk"])), pa.array(lo), pa.array(hi), pa.array(n)],
                    ["_anchor", "_chunk", "_lo", "_hi", "_n"],
                )

    return chunks.mapInArrow(found, "_anchor long, _chunk long, _lo long, _hi long, _n long")


_SEGMENTS = "_chunk long, _anchor long, _seg long, _id long, _words binary"


def _segment_rows(length: int):
    schema = pa.schema([("_chunk", pa.int64()), ("_anchor", pa.int64()), ("_seg", pa.int64()), ("_id", pa.int64()), ("_words", pa.binary())])

    def rows(chunk: pa.Table, shared: pa.Table) -> pa.Table:
        """Distinct segments of a chunk with a shared anchor; of a frequent
        anchor its distinct suffixes instead, without words."""
        if chunk.num_rows == 0 or shared.num_rows == 0:
            return schema.empty_table()
        row = chunk.to_pylist()[0]
        c = _Chunk(row, length)
        frequent = shared.column("_frequent").to_numpy(zero_copy_only=False).astype(bool)
        anchors = shared.column("_anchor").to_numpy()
        anchor, names, ids = c.anchor.view(np.int64), c.names(), c.owners()
        at = np.flatnonzero(np.isin(anchor, anchors[~frequent]))
        at = at[_least(names[at], ids[at])]
        symbols = (c.h >> np.uint64(32)).astype("<u4")
        words = [symbols[a : b + length].tobytes() for a, b in zip(c.first[at].tolist(), c.last[at].tolist())]
        _, deep, owner = c.suffixes(np.flatnonzero(np.isin(anchor, anchors[frequent])))
        own = _least(deep, owner)
        n = len(at) + len(own)
        return pa.table(
            [
                pa.array(np.full(n, row["_chunk"])),
                pa.array(np.append(anchor[at], deep[own])),
                pa.array(np.append(names[at], deep[own])),
                pa.array(np.append(ids[at], owner[own])),
                pa.array(words + [None] * len(own), pa.binary()),
            ],
            schema=schema,
        )

    return rows


def tree_nodes(symbols: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """The node of depth ``length`` every position's suffix passes (a dense
    name), -1 where fewer words are left before its segment's end; by prefix
    doubling over all segments at once."""

    def names(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = pa.array(a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64))
        return pair.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)

    n = len(symbols)
    name = pa.array(symbols).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = 1
    while size * 2 <= length:
        name = names(name[: n - 2 * size + 1], name[size : n - size + 1])
        size *= 2
    m = n - length + 1
    if m <= 0:
        return np.full(n, -1)
    if size < length:
        name = names(name[:m], name[length - size : length - size + m])
    left = np.repeat(ends, np.diff(np.concatenate([[0], ends]))) - np.arange(n)
    out = np.full(n, -1)
    out[:m] = name[:m]
    out[left < length] = -1
    return out


_FOUND = "_chunk long, _seg long, _low long, _mask long, _deep boolean"


def _subtrees(length: int):
    def masks(group: pa.Table) -> pa.Table:
        """Per segment the smallest id it occurs in; bit i is set where its
        i-th suffix also starts in a document with an id below that."""
        names, ids = group.column("_seg").to_numpy(), group.column("_id").to_numpy()
        one = _least(names, ids)  # ordered by name
        low = ids[one]
        blobs = group.column("_words")
        words = [blobs[int(i)].as_py() for i in one]
        size = np.array([len(w) // 4 for w in words], np.int64)
        ends = np.cumsum(size)
        node = tree_nodes(np.frombuffer(b"".join(words), "<u4"), ends, length)
        owner = np.repeat(np.arange(len(words)), size)
        at = np.flatnonzero(node >= 0)
        least = np.full(int(node.max(initial=-1)) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, node[at], low[owner[at]])
        at = at[least[node[at]] < low[owner[at]]]
        bits = np.zeros(len(words), np.uint64)
        np.bitwise_or.at(bits, owner[at], np.uint64(1) << (at - (ends - size)[owner[at]]).astype(np.uint64))
        back = np.searchsorted(names[one], names)
        return pa.table({
            "_chunk": group.column("_chunk"), "_seg": group.column("_seg"), "_low": pa.array(low[back]),
            "_mask": pa.array(bits.view(np.int64)[back]), "_deep": pa.array(np.zeros(len(names), bool)),
        })

    return masks


def _result(length: int):
    schema = pa.schema([("_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def removed(chunk: pa.Table, found: pa.Table) -> pa.Table:
        if chunk.num_rows == 0:
            return schema.empty_table()
        c = _Chunk(chunk.to_pylist()[0], length)
        cover = np.zeros(len(c.h) + 1, np.int64)
        if found.num_rows:
            deep = found.column("_deep").to_numpy(zero_copy_only=False)
            names, low = found.column("_seg").to_numpy(), found.column("_low").to_numpy()
            mask = found.column("_mask").to_numpy().view(np.uint64)
            if deep.any():
                place, name, owner = c.suffixes(np.arange(len(c.anchor)))
                order = np.flatnonzero(deep)[np.argsort(names[deep])]
                at = np.minimum(np.searchsorted(names[order], name), len(order) - 1)
                place = place[(names[order][at] == name) & (low[order][at] < owner)]
                np.add.at(cover, place, 1)
                np.add.at(cover, place + length, -1)
            order = np.flatnonzero(~deep)[np.argsort(names[~deep])]
            names, low, mask = (np.append(x[order], x[:1]) for x in (names, low, mask))
            mine = c.names()
            at = np.searchsorted(names[:-1], mine)  # the last stands for "none"
            there = (at < len(names) - 1) & (names[at] == mine)
            every = there & (c.owners() > low[at])
            np.add.at(cover, c.first[every], 1)
            np.add.at(cover, c.last[every] + length, -1)
            some = np.flatnonzero(there & ~every & (mask[at] != 0))
            for i in range(length - GRAM + 1):
                hit = c.first[some[(mask[at[some]] >> np.uint64(i)) & np.uint64(1) != 0]] + i
                np.add.at(cover, hit, 1)
                np.add.at(cover, hit + length, -1)
        gone = np.cumsum(cover[:-1]) > 0
        count = np.diff(np.concatenate([[0], np.cumsum(gone)])[c.offsets])
        left = np.concatenate([[0], np.cumsum(~gone)])[c.offsets]
        kept = pa.LargeListArray.from_arrays(pa.array(left), c.flat.filter(pa.array(~gone)))
        joined = pc.binary_join(kept, pa.scalar(" ", c.flat.type))
        digests = [hashlib.sha256(t.as_buffer()).hexdigest() for t in joined]
        spans = []
        for n, a, b in zip(count.tolist(), c.offsets[:-1].tolist(), c.offsets[1:].tolist()):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].astype(np.int8), [0]]))) if n else ()
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2])])
        return pa.table([pa.array(c.ids, pa.int64()), pa.array(c.n), pa.array(count), pa.array(digests), pa.array(spans, schema.field("spans").type)], schema=schema)

    return removed


def repeated_spans(
    docs: DataFrame,
    length: int = LENGTH,
    text_col: str = "text",
    id_col: str = "doc_id",
    group_segments: int = GROUP_SEGMENTS,
    task_segments: int = TASK_SEGMENTS,
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed``, ``kept_sha256``
    (of the kept words joined by one space) and ``spans``, the removed word
    ranges (end exclusive)."""
    if not GRAM < length <= GRAM + 63:
        raise ValueError(f"length must be over {GRAM} and at most {GRAM + 63}")
    chunks = chunk_table(docs, "repeat-chunks", text_col, id_col)
    anchors = materialize(_anchors(chunks, length), "repeat-anchors")
    shared = (
        anchors.groupBy("_anchor")
        .agg(F.min("_lo").alias("_l"), F.max("_hi").alias("_h"), F.sum("_n").alias("_m"))
        .where("_l < _h")
        .select("_anchor", (F.col("_m") > group_segments).alias("_frequent"), "_m")
    )
    wanted = materialize(anchors.select("_anchor", "_chunk", "_n").join(shared, "_anchor").select("_chunk", "_anchor", "_frequent", "_n"), "repeat-shared")
    total = wanted.where("not _frequent").agg(F.sum("_n")).first()[0] or 0
    groups = max(1, -(-total // task_segments))
    rows = chunks.groupBy("_chunk").cogroup(wanted.select("_chunk", "_anchor", "_frequent").groupBy("_chunk")).applyInArrow(_segment_rows(length), _SEGMENTS)
    if wanted.where("_frequent").limit(1).count():
        rows = materialize(rows, "repeat-segments")  # read by the tree and the deep nodes
        deep = rows.where("_words is null").select("_chunk", "_seg", "_id")
        least = deep.groupBy("_seg").agg(F.min("_id").alias("_low"))
        nodes = deep.join(least, "_seg").select("_chunk", "_seg", "_low", F.lit(0).cast("long").alias("_mask"), F.lit(True).alias("_deep"))
    else:
        nodes = None
    found = (
        rows.where("_words is not null")
        .withColumn("_g", F.pmod(F.xxhash64("_anchor"), F.lit(groups)))
        .select("_g", "_chunk", "_seg", "_id", "_words")
        .groupBy("_g")
        .applyInArrow(_subtrees(length), _FOUND)
    )
    if nodes is not None:
        found = found.unionByName(nodes)
    return (
        chunks.groupBy("_chunk").cogroup(found.groupBy("_chunk"))
        .applyInArrow(_result(length), "_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:long,end:long>>")
        .withColumnRenamed("_id", id_col)
    )
