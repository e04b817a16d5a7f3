"""Vectorized words and hashes over the UTF-8 bytes of Arrow text columns.

Texts of one Arrow batch lie one after another in a single buffer, so words and
their hashes come from a few numpy passes over it, without Python strings. Memory
is a fixed multiple of ``CHUNK_BYTES`` (or of one text, where that is longer).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text handled at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_seeded = np.random.default_rng(20240517)
_BYTE = _seeded.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: np.uint64, name: str, n: int) -> np.ndarray:
    """base ** i for i < n modulo 2**64; kept up to the chunk size."""
    if name not in _powers or len(_powers[name]) < n:
        steps = np.full(max(n, 1), base, np.uint64)
        steps[0] = 1
        table = np.multiply.accumulate(steps)
        if n > CHUNK_BYTES + 1:
            return table
        _powers[name] = table
    return _powers[name]


def text_chunks(column: pa.ChunkedArray | pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets): the texts of ``rows`` are bytes[offsets[i]:offsets[i+1]]; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None and data_buffer.size else np.zeros(0, np.uint8)
    begin = 0
    while begin < n:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + CHUNK_BYTES, "right")) - 1)
        end = min(end, n)
        own = offsets[begin : end + 1]
        yield slice(begin, end), data[own[0] : own[-1]], own - own[0]
        begin = end


def ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... for length[0] numbers, and so on."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(begin - (ends - length), length)


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all words of a chunk, and the first word of each text (with a last entry)."""
    inside = ~SPACE[data]
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    starts[cuts] = inside[cuts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = cuts[cuts > 0] - 1
    ends[last] = inside[last]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; equal bytes have equal hashes."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * _power(_BASE, "power", len(data))[: len(data)], out=sums[1:])
    unshift = _power(_BASE_INVERSE, "inverse", len(data) + 1)
    return mix((sums[ends] - sums[starts]) * unshift[starts] + (ends - starts).astype(np.uint64))


_SHINGLE = _seeded.integers(1, 2**63, 16, dtype=np.uint64) | np.uint64(1)


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word shingles and the first of each text (with a last entry).

    A text of fewer words has one shingle, its whole sequence; without words, none.
    """
    counts = np.diff(first)
    n_shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(n_shingles)])
    at = np.arange(begin[-1]) - np.repeat(begin[:-1] - first[:-1], n_shingles)
    length = np.repeat(np.minimum(counts, size), n_shingles)
    out = length.astype(np.uint64)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    for k in range(size):
        part = padded[at + k] * _SHINGLE[k]
        if len(length) and length.min() <= k:
            part[length <= k] = 0
        out += part
    return mix(out), begin
