"""Counts that quality rules and classifiers use, for all texts of an Arrow batch at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from llm.byteops import shingle_hashes, span_hashes, text_chunks, word_bounds

WINDOW_WORDS = 8
SYMBOLS = b"#*$%&|<>"


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_IS_SYMBOL = _table(SYMBOLS)
_CONTINUES = np.zeros(256, bool)
_CONTINUES[0x80:0xC0] = True


def counts_between(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many entries of ``mask`` are set in each span offsets[i]:offsets[i+1]."""
    sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def repeats(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(later, any): whether an equal value of the same owner came before; or exists at all."""
    order = np.lexsort((np.arange(len(values)), values, owner))
    v, o = values[order], owner[order]
    same = (v[1:] == v[:-1]) & (o[1:] == o[:-1])
    later, some = np.zeros(len(v), bool), np.zeros(len(v), bool)
    later[1:] = same
    some[1:] |= same
    some[:-1] |= same
    out_later, out_some = np.empty_like(later), np.empty_like(some)
    out_later[order], out_some[order] = later, some
    return out_later, out_some


def line_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the \\n-split lines of a chunk, and the text each belongs to."""
    newline = np.flatnonzero(data == 0x0A)
    texts = np.arange(len(offsets) - 1)
    starts = np.concatenate([offsets[:-1], newline + 1])
    ends = np.concatenate([newline, offsets[1:]])
    of_newline = np.searchsorted(offsets, newline, "right") - 1
    owner_start = np.concatenate([texts, of_newline])
    owner_end = np.concatenate([of_newline, texts])
    start_order, end_order = np.lexsort((starts, owner_start)), np.lexsort((ends, owner_end))
    return starts[start_order], ends[end_order], owner_start[start_order]


def rule_counts(column: pa.Array) -> Iterator[tuple[slice, dict[str, np.ndarray]]]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of each text."""
    for rows, data, offsets in text_chunks(column):
        starts, ends, first = word_bounds(data, offsets)
        n_words = np.diff(first)
        characters = np.concatenate([[0], np.cumsum(~_CONTINUES[data], dtype=np.int64)])
        per_word = characters[ends] - characters[starts]
        chars = np.concatenate([[0], np.cumsum(per_word)])
        line_start, line_end, line_owner = line_bounds(data, offsets)
        with_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
        line_start, line_end, line_owner = line_start[with_word], line_end[with_word], line_owner[with_word]
        later, _ = repeats(span_hashes(data, line_start, line_end), line_owner)
        words = span_hashes(data, starts, ends)
        yield rows, {
            "n_words": n_words,
            "word_chars": chars[first[1:]] - chars[first[:-1]],
            "n_symbols": counts_between(_IS_SYMBOL[data], offsets),
            "n_lines": np.bincount(line_owner, minlength=len(n_words)),
            "n_dup_lines": np.bincount(line_owner[later], minlength=len(n_words)),
            "n_repeat_words": _repeat_words(words, first),
        }


def _repeat_words(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words in windows of WINDOW_WORDS found twice or more in their text."""
    counts = np.diff(first)
    windows, begin = shingle_hashes(words, first, WINDOW_WORDS)
    n_windows = np.diff(begin)
    owner = np.repeat(np.arange(len(counts)), n_windows)
    _, again = repeats(windows, owner)
    again &= np.repeat(counts >= WINDOW_WORDS, n_windows)
    at = np.arange(len(windows)) - np.repeat(begin[:-1] - first[:-1], n_windows)
    edge = np.zeros(len(words) + WINDOW_WORDS + 1, np.int64)
    np.add.at(edge, at[again], 1)
    np.add.at(edge, at[again] + WINDOW_WORDS, -1)
    covered = np.cumsum(edge)[: len(words)] > 0
    return counts_between(covered, first)
