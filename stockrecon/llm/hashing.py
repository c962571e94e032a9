"""Hashes of the words of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of text hashed at a time; a longer text makes a slice of its own.
SLICE_BYTES = 500_000


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x + GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_lower = np.arange(256, dtype=np.uint64)
_lower[65:91] += np.uint64(32)
_LETTER = mix(_lower * GOLDEN)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1) modulo 2**64; grown on demand and kept up to the usual slice."""
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, 1), base, dtype=np.uint64)
        steps[0] = 1
        grown = np.cumprod(steps, dtype=np.uint64)
        if n > 2 * SLICE_BYTES:
            return grown
        _powers[base] = grown
    return _powers[base][:n]


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and bounds of runs of texts; nulls count as empty."""
    column = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z lower-cased, and where the words of each text begin (and end)."""
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    space = _SPACE[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[bounds] = True
    begins, ends = ~space, ~space
    begins[1:] &= space[:-1] | cut[1:n]
    ends[:-1] &= space[1:] | cut[1:n]
    b, e = np.flatnonzero(begins), np.flatnonzero(ends)
    total = np.cumsum(_LETTER[data] * _power(_BASE, n), dtype=np.uint64)
    before = np.where(b > 0, total[np.maximum(b, 1) - 1], np.uint64(0))
    hashes = mix((total[e] - before) * _power(_INVERSE, n)[b] + (e - b).astype(np.uint64))
    return hashes, np.searchsorted(b, bounds)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and the sorted distinct shingle hashes of each text, slice by slice.

    A text with fewer than ``size`` words has its whole sequence as one shingle, a text
    without words has none.
    """
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    for first, data, bounds in slices(texts):
        hashes, starts = word_hashes(data, bounds)
        windows = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
        for k in range(size):
            windows += hashes[k : k + len(windows)] * factors[k]
        windows = mix(windows)
        found = []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            if b - a >= size:
                found.append(np.unique(windows[a : b - size + 1]))
            elif b > a:
                short = (hashes[a:b] * factors[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                found.append(mix(np.array([short], np.uint64)))
            else:
                found.append(np.empty(0, np.uint64))
        yield first, found
