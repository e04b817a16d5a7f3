"""Words and word n-grams of Arrow texts, interned in an open-addressed numpy table.

A batch's n-grams are spans of bytes. Each span's xxhash64 names a first slot; a taken
slot is the span's own only if the bytes are equal, else the next slot is tried. A slot
stores what is worked out once per different n-gram: its bucket and its count.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from xxhash import xxh64_intdigest

from llm.byteops import LOWER

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
# Longer spans are compared as Python bytes, one pair at a time.
_LANES_TO = 64


def folded_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, first): words in lower case (A-Z), with one space after each.

    A word is a run of digits, letters a to z and everything beyond ASCII; word i is
    bytes[starts[i]:ends[i]], text t has the words first[t] to first[t + 1].
    """
    data = LOWER[data]
    inside = _WORD[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    cuts = offsets[1:-1]
    before[cuts[cuts < len(data)]] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    last = cuts[cuts > 0] - 1
    after[last] = False
    starts = np.flatnonzero(inside & ~before)
    length = np.flatnonzero(inside & ~after) + 1 - starts
    first = np.searchsorted(starts, offsets)
    # The i-th word moves behind the i words and spaces before it.
    number = np.repeat(np.arange(len(starts)), length)
    out = np.full(int(length.sum()) + len(starts), ord(" "), np.uint8)
    out[np.arange(len(number)) + number] = data[inside]
    ends = np.cumsum(length + 1) - 1
    return out, ends - length, ends, first


def ngrams(starts: np.ndarray, ends: np.ndarray, first: np.ndarray, least: int, most: int):
    """(starts, ends, text) of all runs of ``least`` to ``most`` words that lie in one text."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    runs = []
    for n in range(least, most + 1):
        whole = text[n - 1 :] == text[: len(text) - n + 1] if len(text) >= n else np.zeros(0, bool)
        at = np.flatnonzero(whole)
        runs.append((starts[at], ends[at + n - 1], text[at]))
    return tuple(np.concatenate(column) for column in zip(*runs, strict=True))


def span_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """xxhash64 of each span's bytes."""
    buffer = data.tobytes()
    words = np.flatnonzero(data == ord(" "))
    if len(words) == len(starts) and (words == ends).all():
        # Single words: all that stands between the spaces.
        return np.array(list(map(xxh64_intdigest, buffer.split(b" ")[:-1])), np.uint64)
    keys = (xxh64_intdigest(buffer[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True))
    return np.fromiter(keys, np.uint64, len(starts))


def equal_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the ``length`` bytes from ``a`` and from ``b`` are the same, for each pair."""
    same = np.ones(len(a), bool)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    short = np.flatnonzero(length <= _LANES_TO)
    for at in range(0, _LANES_TO, 8):
        short = short[length[short] > at]
        if not len(short):
            break
        rest = np.minimum(length[short] - at, 8).astype(np.uint64)
        differ = (lanes[a[short] + at] ^ lanes[b[short] + at]) << (np.uint64(64) - np.uint64(8) * rest)
        same[short] &= differ == 0
    for i in np.flatnonzero(length > _LANES_TO).tolist():
        n = int(length[i])
        same[i] = data[a[i] : a[i] + n].tobytes() == data[b[i] : b[i] + n].tobytes()
    return same


@dataclass(frozen=True)
class Interned:
    """The slots of a batch: ``bucket`` and ``count`` by slot, and the slot of each occurrence."""

    bucket: np.ndarray
    count: np.ndarray
    slot: np.ndarray


def intern(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray, buckets: int) -> Interned:
    """Give each different span a slot, by its key and then by its bytes.

    All spans are placed at once: those at a free slot claim it, the first of them
    holds it; those that find other bytes there go one slot on. The table has twice as
    many slots as spans at least, so every span finds one. The bucket of an n-gram is
    the crc32 of its bytes modulo ``buckets``.
    """
    n, length = len(starts), ends - starts
    slots = 1 << max(4, (2 * n - 1).bit_length())
    holder = np.full(slots, -1, np.int64)
    slot = (keys & np.uint64(slots - 1)).astype(np.int64)
    open_ = np.arange(n)
    while len(open_):
        at = slot[open_]
        free = holder[at] < 0
        # Written from behind, so the first claim of a slot stays.
        holder[at[free][::-1]] = open_[free][::-1]
        held = holder[at]
        same = (keys[held] == keys[open_]) & (length[held] == length[open_])
        check = np.flatnonzero(same & (held != open_))
        same[check] = equal_spans(data, starts[held[check]], starts[open_[check]], length[open_[check]])
        open_ = open_[~same]
        slot[open_] = (slot[open_] + 1) & (slots - 1)
    buffer, used = data.tobytes(), np.flatnonzero(holder >= 0)
    bucket = np.zeros(slots, np.int64)
    spans = zip(starts[holder[used]].tolist(), ends[holder[used]].tolist(), strict=True)
    bucket[used] = np.fromiter((zlib.crc32(buffer[s:e]) % buckets for s, e in spans), np.int64, len(used))
    return Interned(bucket, np.bincount(slot, minlength=slots), slot)
