"""Shared helpers of the text operators: word splitting in Arrow, 64-bit
word hashes and window fingerprints in numpy, and packed key blobs.

All of it runs inside Spark tasks on one Arrow batch (or one bounded slice
of a batch) at a time; nothing here holds state between batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text bytes handled at once inside a task.
SLICE_BYTES = 4 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def texts(column: pa.Array) -> pa.Array:
    """The column as large strings, null as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, stop) ranges of rows holding at most ``most`` bytes each (a
    longer single text makes a range of its own)."""
    if len(column) == 0:
        return
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
    start, base = 0, 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield start, stop
        start, base = stop, int(ends[stop - 1])


def split_words(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text: row offsets into the flat
    array of words."""
    parts = pc.split_pattern_regex(column, "[ \t\n\x0b\x0c\r]+") if _odd_space(column) else pc.ascii_split_whitespace(column)
    offsets = parts.offsets.to_numpy().astype(np.int64)
    flat = parts.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    full = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        flat = flat.filter(pa.array(full))
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
    return offsets, flat


def _odd_space(column: pa.Array) -> bool:
    """True where the fast splitter might see other separators than asked."""
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return bool(((data >= 0x1C) & (data <= 0x1F)).any())


def word_ids(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Dense local ids of the words, and the distinct words."""
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def hash_words(words: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hash of each distinct word's UTF-8 bytes."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + n + 1].tolist()
    data = memoryview(words.buffers()[2] or b"")
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(data[a:b], seed) for a, b in zip(offsets, offsets[1:])), np.uint64, n)


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser: spreads every input bit over the 64 output bits."""
    h = (h ^ (h >> np.uint64(32))) * _ODD
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Fingerprint of every run of ``k`` consecutive hashes (the polynomial of
    the run, built by doubling), ``len(h) - k + 1`` values."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out, have, step, span = None, 0, h, 1
    power = int(_MIX)
    bits = k
    while bits:
        if bits & 1:
            # The next `span` hashes after the `have` already folded in.
            n = len(h) - have - span + 1
            out = step[:n].copy() if out is None else out[:n] * np.uint64(power) + step[have : have + n]
            have += span
        bits >>= 1
        if bits:
            n = len(step) - span
            step = step[:n] * np.uint64(power) + step[span : span + n]
            span *= 2
            power = power * power % (1 << 64)
    return mix(out)


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Total UTF-8 bytes of a text column: one column scan, one number."""
    return int(docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0)


def crc_mod(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def pack48(keys: np.ndarray) -> bytes:
    """The low 48 bits of each key, six bytes a key."""
    return np.ascontiguousarray(keys, "<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :6] = raw
    return out.view("<u8").reshape(-1).astype(np.uint64)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending keys as compressed differences, byte plane by byte plane (the
    planes of high bytes are nearly constant)."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack_sorted(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").reshape(-1), dtype=np.uint64)


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Range of the key space (by its high 24 bits) each key lies in."""
    return ((keys >> np.uint64(40)) * np.uint64(n) >> np.uint64(24)).astype(np.int64)


def parts_by(bucket: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A stable order that groups rows by bucket, and the bucket bounds."""
    small = bucket.astype(np.uint16) if n < 65536 else bucket
    order = np.argsort(small, kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=n))])


CHUNK_SCHEMA = "_part int, _ids array<long>, _len binary, _blob binary"


def chunk_table(
    docs: DataFrame, name: str, text_col: str = "text", id_col: str = "doc_id", part: Column | None = None, chunk_bytes: int = SLICE_BYTES
) -> DataFrame:
    """The documents as compressed chunks of at most ``chunk_bytes`` of text,
    each of one ``part``, written once to the shared folder: ``_chunk`` (a
    number that stays), ``_part``, ``_ids`` and the texts.  Later passes read
    or shuffle these instead of the texts."""
    from tallyfold.session import materialize

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(2).to_numpy(zero_copy_only=False)
            for p in np.unique(parts):
                at = pa.array(np.flatnonzero(parts == p))
                ids, col = batch.column(0).take(at), texts(batch.column(1).take(at))
                for a, b in slices(col, chunk_bytes):
                    rows = col.slice(a, b - a)
                    sizes = pc.binary_length(rows).to_numpy(zero_copy_only=False).astype("<u4")
                    data = pc.binary_join(pa.array([rows.to_pylist()], pa.large_list(pa.large_string())), pa.scalar("", pa.large_string()))[0].as_py().encode()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([int(p)], pa.int32()),
                            pa.array([ids.slice(a, b - a).to_pylist()], pa.list_(pa.int64())),
                            pa.array([sizes.tobytes()], pa.binary()),
                            pa.array([zstandard.compress(data, 3)], pa.binary()),
                        ],
                        ["_part", "_ids", "_len", "_blob"],
                    )

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t"), (F.lit(0) if part is None else part).cast("int").alias("_p"))
    return materialize(rows.mapInArrow(packed, CHUNK_SCHEMA).withColumn("_chunk", F.monotonically_increasing_id()), name)


def chunk_texts(lengths: bytes, blob: bytes) -> pa.Array:
    """The texts of a chunk."""
    data = zstandard.decompress(blob)
    offsets = np.concatenate([[0], np.cumsum(np.frombuffer(lengths, "<u4").astype(np.int64))])
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data))
