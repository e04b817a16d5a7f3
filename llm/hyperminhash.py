"""HyperMinHash sketches: per bucket the leading-zero count and a few mantissa bits of the minimum.

A 64-bit shingle hash picks one of ``REGISTERS`` buckets with its low bits; the
bucket keeps the smallest of the remaining bits as a 16-bit register: six bits of
leading zeros, ten bits of mantissa. Buckets no shingle fell into borrow the
register of another bucket, in an order that depends on the bucket alone, so two
sets agree in a register with the probability of their Jaccard similarity, small
sets too. Both sketches of equal sets are equal.
"""

from __future__ import annotations

import numpy as np

from llm.byteops import mix

REGISTERS = 256
BUCKET_BITS = 8
MANTISSA_BITS = 10
# The largest chance of a pair at the threshold to share no band.
MOST_MISSED = 1e-8
BORROW_TRIES = 256

_EMPTY = np.uint64(2**64 - 1)
_buckets = np.arange(REGISTERS, dtype=np.uint64)
# Column t: whom an empty bucket asks in try t.
_DONORS = np.stack(
    [
        (mix(_buckets + np.uint64((t + 1) << 20)) % np.uint64(REGISTERS)).astype(np.int64)
        for t in range(BORROW_TRIES)
    ],
    axis=1,
)


def minima(hashes: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """The smallest remaining hash per (set, bucket); all ones where no hash fell."""
    out = np.full(owners * REGISTERS, _EMPTY, np.uint64)
    bucket = (hashes & np.uint64(REGISTERS - 1)).astype(np.int64)
    np.minimum.at(out, owner * REGISTERS + bucket, hashes >> np.uint64(BUCKET_BITS))
    return out.reshape(owners, REGISTERS)


def borrow(values: np.ndarray) -> np.ndarray:
    """Fill empty buckets from other buckets of the same set; an empty set stays empty."""
    out, filled = values.copy(), values != _EMPTY
    row, column = np.nonzero(~filled & filled.any(axis=1, keepdims=True))
    for t in range(BORROW_TRIES):
        if not len(row):
            return out
        donor = _DONORS[column, t]
        found = filled[row, donor]
        out[row[found], column[found]] = values[row[found], donor[found]]
        row, column = row[~found], column[~found]
    for r, c in zip(row, column, strict=True):
        full = np.flatnonzero(filled[r])
        out[r, c] = values[r, full[np.searchsorted(full, c) % len(full)]]
    return out


def registers(values: np.ndarray) -> np.ndarray:
    """16-bit registers of minima of 64 - BUCKET_BITS bits."""
    width = 64 - BUCKET_BITS
    clean = np.minimum(values, np.uint64(2**width - 1))
    # frexp is exact enough here: the top ten bits decide, and ties round alike in all sets.
    mantissa, exponent = np.frexp((clean >> np.uint64(4)).astype(np.float64))
    zeros = np.clip(width - 4 - exponent, 0, 63).astype(np.uint16)
    bits = np.clip((mantissa * 2 - 1) * 2**MANTISSA_BITS, 0, 2**MANTISSA_BITS - 1).astype(np.uint16)
    return (zeros << np.uint16(MANTISSA_BITS)) | bits


def sketch(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(sets, REGISTERS) registers of the sets hashes[first[i]:first[i+1]]."""
    owners = len(first) - 1
    owner = np.repeat(np.arange(owners), np.diff(first))
    return registers(borrow(minima(hashes, owner, owners)))


def band_rows(threshold: float) -> int:
    """Registers of a band: as many as keep the chance of missing a pair below MOST_MISSED."""
    missed = lambda rows: (1 - threshold**rows) ** (REGISTERS // rows)
    return max((r for r in range(1, 17) if missed(r) <= MOST_MISSED), default=1)


def chance_equal(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that a register of two disjoint sets of n and m shingles is equal.

    Sum over leading-zero counts of both having that count, times one in
    2**MANTISSA_BITS for the mantissas.
    """
    zeros = np.arange(64 - BUCKET_BITS)[:, None]
    low, high = 2.0 ** -(zeros + 1), 2.0**-zeros

    def at(size):
        size = np.maximum(size / REGISTERS, 1.0)
        return np.exp(-size * low) - np.exp(-size * high)

    return (at(n) * at(m)).sum(axis=0) / 2**MANTISSA_BITS


def jaccard(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity of set pairs from their equal registers, less accidental matches."""
    chance = chance_equal(n, m)
    return np.clip((equal.mean(axis=1) - chance) / (1 - chance), 0, 1)


def slack(n: np.ndarray, threshold: float) -> np.ndarray:
    """Six standard deviations of the estimate at ``threshold``, for the smaller set's size."""
    return 6 * np.sqrt(threshold * (1 - threshold) / np.minimum(np.maximum(n, 1), REGISTERS))


def possible(equal: np.ndarray, n: np.ndarray, m: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the corrected estimate does not rule out the threshold; ``equal`` is (pairs, REGISTERS)."""
    return jaccard(equal, n, m) >= threshold - slack(np.minimum(n, m), threshold)
