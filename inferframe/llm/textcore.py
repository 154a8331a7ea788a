"""Vectorised text kernels for Arrow batches.

Everything works on the UTF-8 bytes of a whole batch slice at once: word spans, 64-bit word
hashes and per-document word offsets come from a handful of numpy passes, with no Python loop
over words. Word separators are the ASCII bytes 0x20 and 0x09-0x0D, so cutting bytes and cutting
code points give the same words.

Memory: `slices` hands out at most about `SLICE_BYTES` of text at a time (a longer document
comes alone, whole), and hashes are built in windows of `WINDOW` bytes, so temporaries stay a
small multiple of one slice whatever the batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
WINDOW = 1 << 20
U = np.uint64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: one random word per byte value, and the odd base of the rolling hash with its inverse mod 2^64
_BYTE = np.random.default_rng(20240917).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: spreads every input bit over the word."""
    x = x.astype(U)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, WINDOW + 4096)
        for k, base in enumerate((_BASE, _INV)):
            p = np.full(size, base, U)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def strings(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows holding about `limit` bytes."""
    data, offsets = strings(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes unchanged."""
    return _LOWER[data]


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and each document's first word (n + 1 offsets).
    A document's edge ends a word."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word
    last[:-1] &= ~word[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges (sorted by start, not overlapping): a rolling hash's prefix
    sums, moved to a common origin by the base's inverse power, then mixed with the length."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + WINDOW)))
        a, b = int(starts[i]), int(ends[j - 1])
        power, inverse = _power_table(b - a + 1)
        h = np.empty(b - a + 1, U)
        h[0] = 0
        np.multiply(_BYTE[data[a:b]], power[:b - a], out=h[1:])
        np.cumsum(h, out=h)
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (h[e] - h[s]) * inverse[s] + (e - s).astype(U) * U(0xD6E8FEB86659FD93)
        i = j
    return mix(out)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and each document's first word (n + 1 offsets)."""
    starts, ends, first = spans(data, offsets)
    return hash_spans(data, starts, ends), first


def shingles(word: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles with each document's first shingle; a document of 1 to k - 1
    words gives one shingle of its whole sequence, one without words none. Repeats stay."""
    n = np.diff(first)
    counts = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    at = np.zeros(len(first), np.int64)
    np.cumsum(counts, out=at[1:])
    long = np.flatnonzero(n >= k)
    reps = counts[long]
    where = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps) + np.repeat(first[long], reps)
    rolled = word[where].copy()
    for j in range(1, k):
        rolled *= U(0x9FB21C651E98DF25)
        rolled += word[where + j]
        rolled ^= rolled >> U(29)
    out = np.empty(at[-1], U)
    out[np.arange(len(where)) - np.repeat(np.cumsum(reps) - reps, reps) + np.repeat(at[long], reps)] = rolled
    for d in np.flatnonzero((n > 0) & (n < k)):
        h = 0x2545F4914F6CDD1D * int(n[d])
        for w in word[first[d]:first[d + 1]].tolist():
            h = (h * 0x9FB21C651E98DF25 + w) % (1 << 64)
        out[at[d]] = h
    return mix(out), at


def reduce_rows(ufunc: np.ufunc, values: np.ndarray, at: np.ndarray, empty) -> np.ndarray:
    """ufunc over each document's values; `empty` where it has none."""
    n = len(at) - 1
    out = np.full((n, *values.shape[1:]), empty, values.dtype)
    full = np.flatnonzero(np.diff(at) > 0)
    if len(full):
        out[full] = ufunc.reduceat(values, at[full], axis=0)
    return out


def ordinals(sizes: np.ndarray) -> np.ndarray:
    """0 .. size - 1 for each size, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The pieces of `data` at starts, one after the other."""
    return data[ordinals(sizes) + np.repeat(starts, sizes)]
