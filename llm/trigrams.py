"""Boolean trigram queries of regular expressions, and a postings index to answer them.

A query is a conjunction of clauses; a clause lists alternative literals, each standing
for all its trigrams. Letters are folded to lower case in queries and index alike.
"""

from __future__ import annotations

import re
from re import _constants as C
from re import _parser as parser

import numpy as np
import pyarrow as pa

from llm.byteops import LOWER, text_chunks

Query = tuple[frozenset[bytes], ...]
MOST_ALTERNATIVES = 64


def trigram_query(pattern: str) -> Query:
    """Clauses every match satisfies; none if the pattern has no mandatory trigram."""
    exact, clauses = _walk(parser.parse(pattern))
    return tuple(dict.fromkeys([*clauses, *_clause(exact)]))


def _clause(exact: frozenset[str] | None) -> list[frozenset[bytes]]:
    """The clause that one of these literals occurs; none where one is too short to tell."""
    folded = frozenset(x.lower().encode() for x in exact or ())
    return [folded] if folded and all(len(x) >= 3 for x in folded) else []


def _walk(tree) -> tuple[frozenset[str] | None, list[frozenset[bytes]]]:
    """(all strings the tree matches, if they are few; clauses of the rest)."""
    exact: frozenset[str] | None = frozenset([""])
    parts, clauses = exact, []
    for op, value in tree:
        own, inner = _node(op, value)
        clauses += inner
        if own is not None and len(parts) * len(own) <= MOST_ALTERNATIVES:
            parts = frozenset(x + y for x in parts for y in own)
            continue
        clauses += _clause(parts)
        exact = None
        parts = own if own is not None else frozenset([""])
    if exact is None:
        return None, [*clauses, *_clause(parts)]
    return parts, clauses


def _node(op, value) -> tuple[frozenset[str] | None, list[frozenset[bytes]]]:
    if op is C.LITERAL:
        return frozenset([chr(value)]), []
    if op is C.SUBPATTERN:
        return _walk(value[3])
    if op is C.BRANCH:
        sides = [_walk(x) for x in value[1]]
        if all(exact is not None and not clauses for exact, clauses in sides):
            return frozenset().union(*(exact for exact, _ in sides)), []
        each = [[*_clause(exact), *clauses][:1] for exact, clauses in sides]
        return None, [frozenset().union(*(x[0] for x in each))] if all(each) else []
    if op in (C.MAX_REPEAT, C.MIN_REPEAT):
        least, most, inner = value
        exact, clauses = _walk(inner)
        if (least, most) == (0, 1) and exact is not None and not clauses:
            return exact | {""}, []
        if least == 0:
            return None, []
        if least == most and exact is not None and len(exact) == 1:
            return frozenset([next(iter(exact)) * least]), clauses
        return None, [*clauses, *_clause(exact)]
    if op is C.IN and all(kind is C.LITERAL for kind, _ in value):
        return frozenset(chr(x) for _, x in value), []
    if op is C.AT:
        return frozenset([""]), []
    return None, []


def _codes(literal: bytes) -> list[int]:
    return [literal[i] << 16 | literal[i + 1] << 8 | literal[i + 2] for i in range(len(literal) - 2)]


class TrigramIndex:
    """Candidates of a fixed set of patterns within the segments of a text column.

    Per segment (some megabytes of whole texts) the postings of every trigram that
    some query needs are built in one pass: trigram -> ascending text numbers. Queries
    intersect and join postings; patterns without a mandatory trigram get every text.
    """

    def __init__(self, patterns: dict[str, str]):
        self.queries = {name: trigram_query(p) for name, p in patterns.items()}
        needed = sorted({c for q in self.queries.values() for x in q for s in x for c in _codes(s)})
        self.number = {c: i + 1 for i, c in enumerate(needed)}
        self.lookup = np.zeros(1 << 24, np.uint16)
        self.lookup[needed] = np.arange(1, len(needed) + 1)

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, np.ndarray]:
        if len(data) < 3:
            return {}
        folded = LOWER[data].astype(np.uint32)
        found = self.lookup[(folded[:-2] << 16) | (folded[1:-1] << 8) | folded[2:]]
        at = np.flatnonzero(found)
        text = np.searchsorted(offsets, at, "right") - 1
        inside = at + 3 <= offsets[text + 1]
        pairs = np.unique(found[at[inside]].astype(np.int64) << 40 | text[inside])
        trigram, text = pairs >> 40, pairs & ((1 << 40) - 1)
        cuts = np.flatnonzero(np.diff(trigram)) + 1
        return {int(t[0]): d for t, d in zip(np.split(trigram, cuts), np.split(text, cuts), strict=True) if len(t)}

    def candidates(self, name: str, postings: dict[int, np.ndarray], n: int) -> np.ndarray:
        """Ascending numbers of the texts that may match a pattern."""
        none, out = np.zeros(0, np.int64), None
        for clause in self.queries[name]:
            either = none
            for literal in clause:
                texts = None
                for code in _codes(literal):
                    own = postings.get(self.number[code], none)
                    texts = own if texts is None else np.intersect1d(texts, own, assume_unique=True)
                either = np.union1d(either, texts)
            out = either if out is None else np.intersect1d(out, either, assume_unique=True)
        return np.arange(n) if out is None else out

    def segments(self, column: pa.Array):
        """(rows, candidates by pattern) of each segment."""
        for rows, data, offsets in text_chunks(column):
            postings = self.postings(data, offsets)
            yield rows, {name: self.candidates(name, postings, len(offsets) - 1) for name in self.queries}


def compiled(patterns: dict[str, str]) -> dict[str, re.Pattern[str]]:
    return {name: re.compile(p) for name, p in patterns.items()}
