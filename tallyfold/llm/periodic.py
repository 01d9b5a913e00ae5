"""Periodic runs of a text's words by block convolution (operator 13).

A run is a stretch of consecutive words whose smallest period is q (words q
apart are the same), of at least ``max(min_words, min_repeats * q)`` words,
that no neighbouring word extends with period q.

Periods are searched scale by scale.  At the scale of blocks of L words a text
is cut into blocks at multiples of L; the sum of squared differences of a
block's word numbers and those of every place d words on (L <= d < 2L; the
first scale also takes all shorter d) is a convolution, computed exactly by a
number-theoretic transform over as many primes as the largest possible sum
needs.  Where the sum is zero the block occurs again, and d words seed a run:
the stretch around them is extended word by word, and kept if it is long
enough and its first d words are not themselves a repetition.  A run of period
q in [L, 2L) has at least 3q >= 2L - 1 + q words, so some block and its copy q
words on lie inside it: no run is missed.

Two exact conditions spare most transforms.  A block that occurs again within
2L words holds no eight words that do not; their next occurrences come from
one sort of the fingerprints of all eight-word windows.  And where a block and
all places looked at lie in a run of a smaller period, any other distance has
that period too.

A text is searched whole, within one task, in time that grows with its words
times the square of their logarithm at most; tasks take slices of a few
megabytes.

Edge cases: a null or empty text has no words, no runs and an empty result;
rows are independent of each other, so equal ids do no harm; a null id stays
null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.text import hash_words, mix, slices, split_words, texts, windows, word_ids

#: A run has at least so many words ...
MIN_WORDS = 24
#: ... and so many repeats of its period.
MIN_REPEATS = 3
#: Words of a block at the first scale, and of the windows compared by sorting.
FIRST = 8
#: Values that one batch of transforms holds.
BATCH_VALUES = 1 << 20

# Primes k * 2^m + 1 below 2^31, with a generator of each.
_PRIMES = ((2013265921, 31), (469762049, 3), (167772161, 3))
_FAR = np.iinfo(np.int64).max


# ------------------------------------------------------- exact transforms


@lru_cache(maxsize=256)
def _powers(prime: int, generator: int, size: int, inverse: bool) -> np.ndarray:
    """The first ``size // 2`` powers of a root of unity of order ``size``."""
    root = pow(generator, (prime - 1) // size, prime)
    if inverse:
        root = pow(root, prime - 2, prime)
    out = np.ones(max(1, size // 2), np.uint64)
    have = 1
    while have < len(out):
        n = min(have, len(out) - have)
        out[have : have + n] = out[:n] * np.uint64(pow(root, have, prime)) % np.uint64(prime)
        have += n
    return out


def _forward(x: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Transform of every row, in bit-reversed order."""
    p, m = np.uint64(prime), x.shape[1]
    while m > 1:
        y, h = x.reshape(len(x), -1, m), m // 2
        low, high = y[:, :, :h], y[:, :, h:]
        total, apart = (low + high) % p, (low + p - high) * _powers(prime, generator, m, False) % p
        y[:, :, :h], y[:, :, h:] = total, apart
        m = h
    return x


def _backward(x: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """The rows whose transforms, in bit-reversed order, are given."""
    p, m = np.uint64(prime), 2
    while m <= x.shape[1]:
        y, h = x.reshape(len(x), -1, m), m // 2
        low, high = y[:, :, :h].copy(), y[:, :, h:] * _powers(prime, generator, m, True) % p
        y[:, :, :h], y[:, :, h:] = (low + high) % p, (low + p - high) % p
        m *= 2
    return x * np.uint64(pow(x.shape[1], prime - 2, prime)) % p


def zero_distances(blocks: np.ndarray, spans: np.ndarray, top: int) -> np.ndarray:
    """Where each block (B x L, numbers below ``top``) occurs in its span
    (B x W): a B x (W - L + 1) mask, true where the sum of squared differences
    is zero.  Enough primes are used that a sum that is zero modulo all of
    them is zero."""
    length, width = blocks.shape[1], spans.shape[1]
    size = 1 << (width - 1).bit_length()
    zero = np.ones((len(blocks), width - length + 1), bool)
    bound, product = length * max(1, top) ** 2, 1
    for prime, generator in _PRIMES:
        p = np.uint64(prime)
        x, y = np.zeros((len(blocks), size), np.uint64), np.zeros((len(blocks), size), np.uint64)
        x[:, :length] = blocks[:, ::-1]
        y[:, :width] = spans
        x %= p
        y %= p
        squares = np.zeros((len(blocks), width + 1), np.uint64)
        np.cumsum(y[:, :width] * y[:, :width] % p, axis=1, out=squares[:, 1:])
        own = (x * x % p).sum(axis=1, dtype=np.uint64)[:, None]
        cross = _backward(_forward(x, prime, generator) * _forward(y, prime, generator) % p, prime, generator)[:, length - 1 : width]
        zero &= (own + squares[:, length:] - squares[:, : width - length + 1]) % p == cross * np.uint64(2) % p
        product *= prime
        if product > bound or not zero.any():
            break
    return zero


# ------------------------------------------------------------- extension


def _agree(ids: np.ndarray, a: int, b: int, end: int) -> int:
    """How many words from ``a`` on equal those from ``b`` on (b > a)."""
    n, step = 0, 64
    while b + n < end:
        m = min(step, end - b - n)
        differ = ids[a + n : a + n + m] != ids[b + n : b + n + m]
        if differ.any():
            return n + int(differ.argmax())
        n, step = n + m, step * 2
    return n


def _agree_back(ids: np.ndarray, a: int, b: int, start: int) -> int:
    """How many words before ``a`` equal those before ``b`` (b > a)."""
    n, step = 0, 64
    while a - n > start:
        m = min(step, a - n - start)
        differ = (ids[a - n - m : a - n] != ids[b - n - m : b - n])[::-1]
        if differ.any():
            return n + int(differ.argmax())
        n, step = n + m, step * 2
    return n


def _primitive(root: np.ndarray) -> bool:
    """True if the word sequence is not two or more copies of a shorter one."""
    n = rest = len(root)
    f = 2
    while rest > 1:
        if f * f > rest:
            f = rest
        if rest % f == 0:
            part = n // f
            if (root[part:] == root[:-part]).all():
                return False
            while rest % f == 0:
                rest //= f
        f += 1
    return True


# --------------------------------------------------------------- search


def next_same(ids: np.ndarray, hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Distance from each word to the next place of its text where the same
    ``FIRST`` words start."""
    out = np.full(len(ids), _FAR)
    grams = windows(hashes[ids], FIRST)
    if not len(grams):
        return out
    at = np.arange(len(grams))
    text = np.searchsorted(offsets, at, side="right") - 1
    inside = at + FIRST <= offsets[text + 1]
    at, keys = at[inside], mix(grams[inside] + text[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    first, then = at[order[:-1][same]], at[order[1:][same]]
    out[first] = then - first
    return out


def _candidates(ahead: np.ndarray, start: int, end: int, length: int, most: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Starts of the blocks of one text that may occur again fewer than
    ``most`` words on, and not only because of a known run."""
    n = (end - start - length) // length + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    again = ahead[start : start + n * length].reshape(n, length)[:, : length - FIRST + 1].max(axis=1) < most
    blocks = start + np.flatnonzero(again) * length
    for s, size, _ in found:
        blocks = blocks[(blocks < s) | (np.minimum(end, blocks + most - 1 + length) > s + size)]
    return blocks


def find_runs(
    ids: np.ndarray, hashes: np.ndarray, offsets: np.ndarray, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS
) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of every text, by start and then
    period; ``ids`` are the word numbers of all texts and ``offsets`` where the
    texts begin and end."""
    if min_words < MIN_WORDS or min_repeats < MIN_REPEATS:
        raise ValueError(f"a run has at least {MIN_WORDS} words and {MIN_REPEATS} repeats")
    ahead = next_same(ids, hashes, offsets)
    near = np.concatenate([[0], np.cumsum(ahead != _FAR)])
    found: dict[int, list[tuple[int, int, int]]] = {}
    texts_left = np.flatnonzero(near[offsets[1:]] > near[offsets[:-1]])
    length, least = FIRST, 1
    while len(texts_left := [t for t in texts_left if (offsets[t + 1] - offsets[t]) >= max(MIN_REPEATS * least, length + least)]):
        most = 2 * length
        blocks, owner = [], []
        for t in texts_left:
            b = _candidates(ahead, int(offsets[t]), int(offsets[t + 1]), length, most, found.get(int(t), []))
            blocks.append(b)
            owner.append(np.full(len(b), t))
        blocks, owner = np.concatenate(blocks), np.concatenate(owner)
        width = most - least - 1 + length
        rows = max(1, BATCH_VALUES // (2 * width))
        known: dict[tuple[int, int], tuple[int, int]] = {}
        for r in range(0, len(blocks), rows):
            at, own = blocks[r : r + rows], owner[r : r + rows]
            place = at[:, None] + least + np.arange(width)
            spans = ids[np.minimum(place, len(ids) - 1)]
            blocks_ids = ids[at[:, None] + np.arange(length)]
            zero = zero_distances(blocks_ids, spans, int(max(spans.max(), blocks_ids.max())) + 1)
            for k, d in zip(*np.nonzero(zero)):
                _seed(ids, offsets, int(own[k]), int(at[k]), int(d) + least, length, min_words, min_repeats, known, found)
        least = length = 2 * length
    own = (sorted(found.get(t, []), key=lambda run: (run[0], run[2])) for t in range(len(offsets) - 1))
    return [[(s - int(start), n, q) for s, n, q in runs] for start, runs in zip(offsets, own)]


def _seed(ids, offsets, text, at, d, length, min_words, min_repeats, known, found) -> None:
    """Extend a block's occurrence ``d`` words on to its whole stretch."""
    start, end = int(offsets[text]), int(offsets[text + 1])
    if at + d + length > end:
        return  # reaches past its text
    low, high = known.get((text, d), (0, 0))
    if low <= at and at + d + length <= high:
        return  # in the stretch that was extended last
    low = at - _agree_back(ids, at, at + d, start)
    high = at + d + length + _agree(ids, at + length, at + d + length, end)
    known[text, d] = (low, high)
    if high - low >= max(min_words, min_repeats * d) and _primitive(ids[low : low + d]):
        found.setdefault(text, []).append((low, high - low, d))


_SCHEMA = "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, text string"


def periodic_runs(
    docs: DataFrame, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """Per row: the id, ``n_words``, ``runs`` (start word, length and period,
    by start and then period) and the text left when every run keeps its first
    period only: a word goes if any run holds it after that run's first
    ``period`` words; the others are joined by one space."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            column = texts(batch.column(1))
            for a, b in slices(column):
                offsets, flat = split_words(column.slice(a, b - a))
                ids, distinct = word_ids(flat)
                runs = find_runs(ids, hash_words(distinct), offsets, min_words, min_repeats)
                kept = np.ones(len(flat), bool)
                for start, own in zip(offsets, runs):
                    for s, n, q in own:
                        kept[start + s + q : start + s + n] = False
                left = np.concatenate([[0], np.cumsum(kept)])[offsets]
                words = pa.LargeListArray.from_arrays(pa.array(left), flat.filter(pa.array(kept)) if not kept.all() else flat)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(np.diff(offsets)),
                        pa.array([[{"start": s, "length": n, "period": q} for s, n, q in own] for own in runs], kind),
                        pc.binary_join(words, pa.scalar(" ", flat.type)).cast(pa.string()),
                    ],
                    ["id", "n_words", "runs", "text"],
                )

    found = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(search, _SCHEMA)
    return found.select(F.col("id").alias(id_col), "n_words", "runs", F.col("text").alias(text_col))
