"""Cross-tokenizer alignment with external spill counting (operator 12).

Every text is encoded, with one space before it, by a byte-level BPE (side A)
and by a sentencepiece BPE (side B).  Where tokens of both sides end at the
same byte the text is cut into groups; an A and a B token whose byte ranges
overlap are linked.  The count of a pair of ids is the number of documents
that hold it linked; it is an A id's best pair when no other pair of that id
has a larger count.

1. *Spill.*  Tasks encode their texts and collect pair-document records (pair,
   document, number of links).  Every ``SPILL_BYTES`` of text the records are
   sorted by pair (A id first) and document, cut by a radix of the A id into
   ``RADIX`` runs, and written, zstd-compressed, to the shared folder.  A run's
   head is its pairs with their numbers of documents.
2. *Count.*  The heads of a radix are merged by a heap, ``WAYS`` at a time and
   level by level, into one run of all its pairs and their counts.  That run
   is in the order of A ids, so each id's maximum is known when its pairs end.
3. *Stream back.*  The merged run of a radix meets the spilled runs, ``WAYS`` of
   them in a task, and each spilled run is read once in order and turned into
   sums per document; the sums of a spill's runs are added.

A pair that a third of all documents hold, or an A id that takes a third of
all links, is one entry of a spill's head, so counting it is no more work than
any other; the records themselves only move in shares of ``WAYS`` runs.  The
merged runs grow with the pairs of the two vocabularies, not with the corpus.

Tokens never cross from a word into a space before the next one (checked for
the vocabulary of side B when it is loaded; the pattern of side A cuts there),
so texts are encoded word by word, each distinct word once a task, and words
of one text are put together by adding and joining.

Edge cases: null and empty texts and texts whose tokens do not spell them
(such as those with U+2581, which side B reads as a space) have no tokens:
zeros and an empty group text.  Every row is a document of its own, so a
repeated row counts twice; a null id stays null.  A text without spaces is one
word, however long.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.text import pack_sorted, slices, texts, unpack_sorted
from tallyfold.session import materialize

#: Bytes of text whose records make one spill.
SPILL_BYTES = 8 << 20
#: Runs that a spill's records are cut into, by the A id.
RADIX = 64
#: Runs that one merge reads.
WAYS = 256
#: Distinct words, and bytes of them, that a task keeps encoded.
KEEP_WORDS, KEEP_BYTES = 200_000, 16 << 20

_BREAK = re.compile(r"(?<=\S) (?=\S)")
_MARK = "▁"
# Fixed value: the published splitting pattern of byte-level vocabularies.
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# ---------------------------------------------------------------- encoding


def byte_symbols() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable
    Latin-1 bytes are themselves, the others follow from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Words:
    """Aligned encodings of distinct words, each with the space before it."""

    def __init__(self, byte_vocabulary: str, piece_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_vocabulary)
        self.ranks = byte_ranks(json.loads(byte_vocabulary))
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=piece_model)
        symbol = byte_symbols()
        size = self.a.get_vocab_size(with_added_tokens=True)
        plain = [self.a.id_to_token(i) or "" for i in range(size)]
        self.bytes_a = [bytes(symbol[c] for c in t) if all(c in symbol for c in t) else t.encode() for t in plain]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.length_a, self.length_b = (np.array([len(t) for t in parts], np.int64) for parts in (self.bytes_a, self.bytes_b))
        self.digits = _digit_table(max(len(plain), len(pieces)))
        #: False if some piece goes on from a word into the next.
        self.splits = not any(_MARK in p.lstrip(_MARK) for p in pieces)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.held = 0
        #: Per word: A tokens, B tokens, groups, links, 1 if both sides spell it.
        self.sizes = array("q")
        self.groups: list[str] = []
        #: Pairs of all words (A id, B id below it), and where each word's end.
        self.pairs = array("q")
        self.pair_ends = array("q", [0])

    def full(self) -> bool:
        return len(self.index) > KEEP_WORDS or self.held > KEEP_BYTES

    def cut(self, text: str) -> list[str]:
        """The words of a text, without the one space before each."""
        return _BREAK.split(text) if self.splits else [text]

    def add(self, new: list[str]) -> None:
        """Encode and align words that are not held yet."""
        plain = [w for w in new if len(w) <= 256 and w.isascii() and not (w[0].isspace() or w[-1].isspace())]
        if self.ranks is None or len(plain) == 0:
            plain, rest = [], new
        else:
            rest = sorted(set(new).difference(plain)) if len(plain) < len(new) else []
        new = plain + rest
        want = [b" " + w.encode() for w in new]
        # Plain words are put end to end and encoded at once; they part where
        # the bytes of each end.
        joined = np.array(self.ranks.encode_ordinary(" " + " ".join(plain)) if plain else [], np.int64)
        marks = np.searchsorted(np.cumsum(self.length_a[joined]), np.cumsum([len(t) for t in want[: len(plain)]])) + 1
        counts = np.diff(marks.astype(np.int64), prepend=0)
        lists = [e.ids for e in self.a.encode_batch([" " + w for w in rest], add_special_tokens=False)]
        a, n_a = np.concatenate([joined, _flat(lists)]), np.concatenate([counts, [len(x) for x in lists]]).astype(np.int64)
        lists = self.b.encode(new, num_threads=1)
        b, n_b = _flat(lists), np.array([len(x) for x in lists], np.int64)
        ok = _spelt(self.bytes_a, a, n_a, want) & _spelt(self.bytes_b, b, n_b, want)
        sizes, groups, pairs = np.zeros((len(new), 5), np.int64), [""] * len(new), np.zeros(0, np.int64)
        if ok.any():
            good = np.flatnonzero(ok).tolist()
            sizes[ok, :4], shown, pairs = self._align(a[np.repeat(ok, n_a)], n_a[ok], b[np.repeat(ok, n_b)], n_b[ok], [want[k] for k in good])
            sizes[ok, 4] = 1
            for k, text in zip(good, shown):
                groups[k] = text
        self.held += sum(map(len, want))
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        self.groups += groups
        self.pair_ends.frombytes((self.pair_ends[-1] + np.cumsum(sizes[:, 3])).tobytes())
        self.sizes.frombytes(sizes.tobytes())
        self.pairs.frombytes(pairs.tobytes())

    def _align(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, want: list[bytes]) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Numbers of A tokens, B tokens, groups and links of each word, its
        groups as text, and the pairs of all words.  The words are put end to
        end: their tokens' ends are cuts of the same bytes, so every stretch
        between two neighbouring cuts is a link."""
        ends_a, ends_b, word_ends = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b]), np.cumsum([len(t) for t in want])
        cuts = np.union1d(ends_a, ends_b)
        i, j = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        word = np.searchsorted(word_ends, cuts)
        both = (ends_a[i] == cuts) & (ends_b[j] == cuts)
        group_ends, n = cuts[both], len(want)
        sizes = np.stack([n_a, n_b, np.bincount(word[both], minlength=n), np.bincount(word, minlength=n)], axis=1)
        # Tokens in the order of the text: a group's A tokens, then its B tokens.
        own = np.concatenate([2 * np.searchsorted(group_ends, ends_a), 2 * np.searchsorted(group_ends, ends_b) + 1])
        order = np.argsort(own, kind="stable")
        own = own[order]
        last = np.append(own[1:] != own[:-1], True)
        shown = np.concatenate([self.digits[a], self.digits[b]])[order]
        shown[:, -1] = np.where(last, np.where(own % 2 == 0, ord("|"), ord(";")), ord(","))
        text = shown[shown != 0].tobytes().decode()
        stops = np.cumsum((shown != 0).sum(axis=1))[np.cumsum(n_a + n_b) - 1].tolist()
        return sizes, [text[x : y - 1] for x, y in zip([0, *stops], stops)], a[i] << 32 | b[j]


def _spelt(parts: list[bytes], tokens: np.ndarray, counts: np.ndarray, want: list[bytes]) -> np.ndarray:
    """For each word, whether its tokens' bytes are those wanted."""
    own = [parts[t] for t in tokens.tolist()]
    stops = np.cumsum(counts).tolist()
    return np.fromiter((b"".join(own[x:y]) == t for x, y, t in zip([0, *stops], stops, want)), bool, len(want))


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


def byte_ranks(vocabulary: dict) -> tiktoken.Encoding | None:
    """The same encoding with the ids as ranks, much faster on plain words;
    None unless ids are in the order of the merges, as ranks must be."""
    symbol = byte_symbols()
    ids, merges = vocabulary["model"]["vocab"], vocabulary["model"]["merges"]
    made = [ids["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
    single = sorted(i for t, i in ids.items() if len(t) == 1)
    special = {t["content"] for t in vocabulary.get("added_tokens", [])}
    if made != sorted(set(made)) or (single and made and single[-1] > made[0]) or len(made) + len(single) != len(set(ids) - special):
        return None
    ranks = {bytes(symbol[c] for c in t): i for t, i in ids.items() if t not in special}
    return tiktoken.Encoding("plain", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


def _digit_table(size: int) -> np.ndarray:
    """The decimal digits of every number below ``size``, zero bytes after them
    and room for one more character."""
    width = len(str(size)) + 1
    return np.frombuffer(b"".join(str(i).encode().ljust(width, b"\0") for i in range(size)), np.uint8).reshape(size, width)


@lru_cache(maxsize=2)
def _words(byte_vocabulary: str, piece_model: bytes) -> Words:
    return Words(byte_vocabulary, piece_model)


def _encoded(words: Words, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[np.ndarray | None], int]]:
    """Slices of rows: their ids, the word numbers of each text (None without
    tokens) and the bytes of text."""
    for batch in batches:
        column = texts(batch.column(1))
        for a, b in slices(column):
            if words.full():
                words.clear()
            cut = [words.cut(t) if t else [] for t in column.slice(a, b - a).to_pylist()]
            unseen = {w for c in cut for w in c if w not in words.index}
            if unseen:
                words.add(sorted(unseen))
            number = words.index.__getitem__
            rows = [np.fromiter(map(number, c), np.int64, len(c)) if c else None for c in cut]
            yield batch.column(0).slice(a, b - a), rows, column.slice(a, b - a).nbytes


# ------------------------------------------------------------ packed runs


def _pack(values: np.ndarray) -> bytes:
    """Non-negative numbers below 2^32, byte plane by byte plane."""
    return zstandard.compress(np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def _join(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def _part(blob: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at : at + 4], "little")
        out.append(blob[at + 4 : at + 4 + n])
        at += 4 + n
    return out


def _head(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    return _join(pack_sorted(pairs.astype(np.uint64)), _pack(counts & 0xFFFFFFFF), _pack(counts >> 32))


def _unhead(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    pairs, low, high = _part(blob)
    return unpack_sorted(pairs).astype(np.int64), _unpack(low) | _unpack(high) << 32


def radix_of(a: np.ndarray) -> np.ndarray:
    """Neighbouring (often equally frequent) ids go to different runs."""
    return (a.astype(np.uint64) * np.uint64(0x9E3779B1) >> np.uint64(16)).astype(np.int64) % RADIX


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after another."""
    before = np.concatenate([[0], np.cumsum(lengths)])
    return np.repeat(starts - before[:-1], lengths) + np.arange(before[-1])


_DOC_FIELDS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
_DOC_SCHEMA = pa.schema([(f, pa.int64()) for f in _DOC_FIELDS[:-1]] + [("groups_sha256", pa.string())])


def _spill(words: Words, ids: list[pa.Array], rows: list[np.ndarray | None]) -> Iterator[tuple[int, bytes, bytes]]:
    """One spill: (radix, head, records) of every run, and (-1, b'', documents)."""
    sizes, all_pairs, pair_ends = np.array(words.sizes).reshape(-1, 5), np.array(words.pairs), np.array(words.pair_ends)
    stats, digests, at, doc = np.zeros((len(rows), 4), np.int64), [], [], []
    for k, own in enumerate(rows):
        if own is None or not sizes[own, 4].all():
            digests.append("")
            continue
        stats[k] = sizes[own, :4].sum(axis=0)
        digests.append(hashlib.sha256(";".join(map(words.groups.__getitem__, own.tolist())).encode()).hexdigest())
        at.append(own)
        doc.append(np.full(len(own), k))
    table = pa.table([pa.concat_arrays(ids).cast(pa.int64()), *stats.T, pa.array(digests, pa.string())], schema=_DOC_SCHEMA)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _DOC_SCHEMA, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    yield -1, b"", sink.getvalue().to_pybytes()
    if not at:
        return
    # Links of a word come with it: first how often each text has each word ...
    n = len(rows)
    seen, times = np.unique(np.concatenate(at) * n + np.concatenate(doc), return_counts=True)
    word, doc = seen // n, seen % n
    # ... then the pairs of those words, numbered in run order.
    own_words, local = np.unique(word, return_inverse=True)
    lengths = pair_ends[own_words + 1] - pair_ends[own_words]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    pairs, number = np.unique(all_pairs[_ranges(pair_ends[own_words], lengths)], return_inverse=True)
    radix = radix_of(pairs >> 32)
    order = np.argsort(radix, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    pairs, radix, number = pairs[order], radix[order], rank[number]
    many = lengths[local]
    keys = number[_ranges(bounds[local], many)] * n + np.repeat(doc, many)
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], np.repeat(times, many)[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    links, keys = np.add.reduceat(times, first), keys[first]
    pair, doc = keys // n, keys % n
    counts = np.bincount(pair, minlength=len(pairs))
    new = np.concatenate([[True], pair[1:] != pair[:-1]])
    steps = np.where(new, doc, doc - np.concatenate([[0], doc[:-1]]))
    ends = np.concatenate([[0], np.cumsum(counts)])
    for r in np.unique(radix).tolist():
        a, b = np.searchsorted(radix, [r, r + 1])
        i, j = ends[a], ends[b]
        yield r, _head(pairs[a:b], counts[a:b]), _join(_pack(steps[i:j]), _pack(links[i:j]))


def _unrecord(head: bytes, records: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and documents per pair; document and links of every record."""
    pairs, counts = _unhead(head)
    steps, links = map(_unpack, _part(records))
    total = np.cumsum(steps)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    before = np.where(starts > 0, total[starts - 1], 0)
    return pairs, counts, total - np.repeat(before, counts), links


_RUNS = "_spill long, _r int, _head binary, _body binary"


def spill_records(docs: DataFrame, byte_vocabulary: str, piece_model: bytes, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The spilled runs of all documents, written: ``_spill``, ``_r`` (-1 for the
    row of its documents), ``_head`` and ``_body``."""

    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(byte_vocabulary, piece_model)
        words.clear()
        number = TaskContext.get().partitionId() << 32
        ids, rows, held = [], [], 0

        def put() -> Iterator[pa.RecordBatch]:
            nonlocal number, ids, rows, held
            for r, head, body in _spill(words, ids, rows) if rows else ():
                columns = [pa.array([number]), pa.array([r], pa.int32()), pa.array([head], pa.binary()), pa.array([body], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["_spill", "_r", "_head", "_body"])
            number, ids, rows, held = number + 1, [], [], 0

        for own, numbers, size in _encoded(words, batches):
            ids.append(own)
            rows += numbers
            held += size
            # Words are forgotten before the next slice, so their spill ends here.
            if held >= SPILL_BYTES or words.full():
                yield from put()
        yield from put()

    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t"))
    return materialize(source.mapInArrow(spill, _RUNS), "token-pairs")


# ------------------------------------------------------------------- merge


def merged(heads: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """K-way heap merge: every pair of the heads once, with its summed count."""

    def entries(head: bytes) -> Iterator[tuple[int, int]]:
        pairs, counts = _unhead(head)
        for i in range(0, len(pairs), 1024):
            yield from zip(pairs[i : i + 1024].tolist(), counts[i : i + 1024].tolist())

    pairs, counts = array("q"), array("q")
    last = -1
    for pair, count in heapq.merge(*map(entries, heads)):
        if pair == last:
            counts[-1] += count
        else:
            pairs.append(pair)
            counts.append(count)
            last = pair
    return np.array(pairs, np.int64), np.array(counts, np.int64)


def best_pairs(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """True for pairs whose count is the largest of their A id (``pairs`` are in
    the order of A ids)."""
    if not len(pairs):
        return np.zeros(0, bool)
    a = pairs >> 32
    new = np.concatenate([[True], a[1:] != a[:-1]])
    return counts == np.maximum.reduceat(counts, np.flatnonzero(new))[np.cumsum(new) - 1]


def merge_counts(runs: DataFrame, n_spills: int, ways: int = WAYS) -> DataFrame:
    """One run per radix (``_r``, ``_head``) with the counts of all its pairs."""

    def merge(table: pa.Table) -> pa.Table:
        head = _head(*merged(table["_head"].to_pylist()))
        return pa.table({"_r": table["_r"].slice(0, 1), "_g": table["_g"].slice(0, 1), "_head": pa.array([head], pa.binary())})

    rows = runs.where(F.col("_r") >= 0).select("_r", F.col("_spill").alias("_g"), "_head")
    left = n_spills
    while True:
        left = max(1, -(-left // ways))
        dealt = rows.withColumn("_g", F.pmod(F.xxhash64("_g"), F.lit(left)))
        rows = materialize(dealt.groupBy("_r", "_g").applyInArrow(merge, "_r int, _g long, _head binary"), "token-pair-counts")
        if left <= 1:
            return rows.select("_r", "_head")


def stream_back(runs: DataFrame, totals: DataFrame, n_spills: int, ways: int = WAYS) -> DataFrame:
    """``n_best`` and ``count_sum`` of every document of every spill, joined with
    the documents' own numbers."""
    shares = max(1, -(-n_spills // ways))

    def back(mine: pa.Table, all_of_radix: pa.Table) -> pa.Table:
        out: dict[str, list] = {"_spill": [], "_sums": []}
        if mine.num_rows:
            pairs, counts = _unhead(all_of_radix["_head"][0].as_py())
            best = best_pairs(pairs, counts)
            for spill, head, body in zip(mine["_spill"].to_pylist(), mine["_head"].to_pylist(), mine["_body"].to_pylist()):
                own, docs_of, doc, links = _unrecord(head, body)
                at = np.repeat(np.searchsorted(pairs, own), docs_of)
                some, local = np.unique(doc, return_inverse=True)
                sums = np.zeros((2, len(some)), np.int64)
                np.add.at(sums[0], local, links * best[at])
                np.add.at(sums[1], local, links * counts[at])
                out["_spill"].append(spill)
                out["_sums"].append(_join(_pack(some), _pack(sums[0]), _pack(sums[1] & 0xFFFFFFFF), _pack(sums[1] >> 32)))
        return pa.table({"_spill": pa.array(out["_spill"], pa.int64()), "_sums": pa.array(out["_sums"], pa.binary())})

    share = F.pmod(F.xxhash64("_spill"), F.lit(shares))
    records = runs.where(F.col("_r") >= 0).withColumn("_s", share).groupBy("_r", "_s")
    copies = totals.withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long")))).groupBy("_r", "_s")
    sums = records.cogroup(copies).applyInArrow(back, "_spill long, _sums binary")

    def rows_of(docs: pa.Table, parts: pa.Table) -> pa.Table:
        table = pa.ipc.open_stream(docs["_body"][0].as_py()).read_all()
        total = np.zeros((2, table.num_rows), np.int64)
        for blob in parts["_sums"].to_pylist():
            some, best, low, high = map(_unpack, _part(blob))
            total[0, some] += best
            total[1, some] += low | high << 32
        return table.append_column("n_best", pa.array(total[0])).append_column("count_sum", pa.array(total[1]))

    schema = ", ".join(f"{f} {'string' if f == 'groups_sha256' else 'long'}" for f in [*_DOC_FIELDS, "n_best", "count_sum"])
    own = runs.where(F.col("_r") == -1).select("_spill", "_body").groupBy("_spill")
    return own.cogroup(sums.groupBy("_spill")).applyInArrow(rows_of, schema)


# --------------------------------------------------------------- interface


def read_vocabularies(byte_path: str, piece_path: str) -> tuple[str, bytes]:
    """The two vocabulary files, read where the job starts; tasks get them from
    Spark."""
    with open(byte_path, encoding="utf-8") as a, open(piece_path, "rb") as b:
        return a.read(), b.read()


def align_documents(docs: DataFrame, byte_vocabulary: str, piece_model: bytes, ways: int = WAYS, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: the id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links
    that are their A id's best pair, ties included), ``count_sum`` (counts of
    its links added) and ``groups_sha256`` (of :func:`token_groups`; empty
    without tokens)."""
    runs = spill_records(docs, byte_vocabulary, piece_model, text_col, id_col)
    n = runs.where(F.col("_r") == -1).count()
    out = stream_back(runs, merge_counts(runs, n, ways), n, ways)
    return out.withColumnRenamed("doc_id", id_col)


def pair_counts(docs: DataFrame, byte_vocabulary: str, piece_model: bytes, ways: int = WAYS, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``a_id``, ``b_id``, ``n_docs`` and ``is_best`` of every linked pair."""
    runs = spill_records(docs, byte_vocabulary, piece_model, text_col, id_col)
    totals = merge_counts(runs, runs.where(F.col("_r") == -1).count(), ways)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for head in batch.column(0).to_pylist():
                pairs, counts = _unhead(head)
                best = best_pairs(pairs, counts)
                for i in range(0, len(pairs), 50_000):
                    p = pairs[i : i + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array(p >> 32), pa.array(p & 0xFFFFFFFF), pa.array(counts[i : i + 50_000]), pa.array(best[i : i + 50_000])], ["a_id", "b_id", "n_docs", "is_best"])

    return totals.select("_head").mapInArrow(rows_of, "a_id long, b_id long, n_docs long, is_best boolean")


def token_groups(docs: DataFrame, byte_vocabulary: str, piece_model: bytes, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The id and the groups of every row as text: ids of both sides with ``|``
    between, groups with ``;`` between; empty without tokens."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(byte_vocabulary, piece_model)
        words.clear()
        for ids, rows, _ in _encoded(words, batches):
            spelt = np.array(words.sizes[4::5], bool)
            whole = [own is not None and spelt[own].all() for own in rows]
            out = [";".join(map(words.groups.__getitem__, own.tolist())) if ok else "" for own, ok in zip(rows, whole)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.string())], ["id", "groups"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(groups, "id long, groups string").withColumnRenamed("id", id_col)
