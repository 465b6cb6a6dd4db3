"""Words and shingles of a whole Arrow batch of texts at once, with numpy inside a task.

Texts are bytes in one buffer with offsets, as Arrow holds them. A word is a run of bytes other than
space, tab, newline, vertical tab, form feed and carriage return, lower-cased in A-Z only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Every byte that is no ASCII letter or digit and belongs to no longer character.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, column: str, size: int | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch with about SLICE_BYTES, or ``size``, of text (one row at least), each with the bytes
    of its texts and their offsets. A null text counts as empty."""
    size = size or SLICE_BYTES
    texts = pc.fill_null(batch.column(column), "").cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1 + texts.offset)[texts.offset :]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first, n = 0, len(texts)
    while first < n:
        last = int(np.searchsorted(at, at[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        yield batch.slice(first, last - first), data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the number of words before it. ``between``
    marks the bytes that stand between words."""
    inner = ~between[data]
    new = np.zeros(len(data) + 1, bool)
    new[offsets] = True
    begin, end = inner.copy(), inner.copy()
    begin[1:] &= ~inner[:-1] | new[1:-1]
    end[:-1] &= ~inner[1:] | new[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, the same wherever the word stands."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        # Words of about SLICE_BYTES at a time, so that long texts don't need long arrays.
        last = max(int(np.searchsorted(ends, starts[first] + SLICE_BYTES, "right")), first + 1)
        s, e = starts[first:last], ends[first:last]
        sizes = e - s
        total = int(sizes.sum())
        heads = np.cumsum(sizes) - sizes
        within = np.arange(total) - np.repeat(heads, sizes)
        powers = np.full(int(sizes.max()), BASE)
        powers[0] = 1
        powers = np.cumprod(powers)
        values = _LOWER[data[np.repeat(s, sizes) + within]].astype(np.uint64) + np.uint64(1)
        sums = np.add.reduceat(values * powers[within], heads)
        out[first:last] = mix(sums + sizes.astype(np.uint64) * M2)
        first = last
    return out


def ngrams(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each run of ``n`` words, at the position of its first word, and whether the run
    lies within one text (the last ``n - 1`` positions of a text have none)."""
    total = len(hashes)
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    out = np.zeros(total, np.uint64)
    for i in range(n):
        out = out * BASE + padded[i : i + total]
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(total)
    return mix(out), left >= n


def shingle_sets(hashes: np.ndarray, offsets: np.ndarray, n: int, bits: int = 64) -> Iterator[np.ndarray]:
    """For each text the hashes of its ``n``-word shingles, repeated ones included. A text of fewer
    words has its whole sequence as the one shingle, a text without words none."""
    runs, _ = ngrams(hashes, offsets, n)
    shift = np.uint64(64 - bits)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= n:
            yield runs[a : b - n + 1] >> shift
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for i in range(a, b):
                whole = whole * BASE + hashes[i : i + 1]
            yield mix(whole) >> shift
        else:
            yield runs[:0]
