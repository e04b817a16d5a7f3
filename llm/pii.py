"""Personal data in text: fixed patterns, and a conditional random field for what they miss."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import crf
from llm.byteops import text_chunks, word_bounds
from llm.pii_examples import KINDS, labelled_sentences
from llm.secret_scan import joined
from llm.shipping import ship
from llm.text_stats import counts_between

LABELS = ("O", *(f"{edge}-{kind}" for kind in KINDS for edge in "BI"))
FOUND = tuple(f"{kind}_crf" for kind in KINDS)
ORDER = {kind: i for i, kind in enumerate((*KINDS, *FOUND))}

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never starts inside a run of digits: were it possible, it would start at the run's first.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_TRIM_LEFT, _TRIM_RIGHT = b"(<[\"'", b".,:;!?)>]\"'"
_DIGIT = np.zeros(256, bool)
_DIGIT[list(b"0123456789")] = True


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int, str]]:
    """Leftmost non-overlapping matches, found from each @ outwards, so long words cost no retries."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            out.append((begin, domain.end(), "email"))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return out


def ips(text: str) -> list[tuple[int, int, str]]:
    # A number of over three digits without leading zeros is above 255; int() is not asked for huge ones.
    small = lambda n: len(n.lstrip("0")) <= 3 and int(n.lstrip("0") or 0) <= 255
    return [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(map(small, m[0].split(".")))]


def cards(text: str) -> list[tuple[int, int, str]]:
    out = []
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    return out


def phones(text: str) -> list[tuple[int, int, str]]:
    return [
        (m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15
    ]


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def possible(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Numbers of the texts that have what each kind of match cannot do without."""
    digit = _DIGIT[data]
    next_digit = np.append(digit[1:], False)
    inner_dot = (data == ord(".")) & next_digit & np.concatenate([[False], digit[:-1]]) if len(data) else digit
    return {
        "email": np.flatnonzero(counts_between(data == ord("@"), offsets)),
        "ip": np.flatnonzero(counts_between(inner_dot, offsets) >= 3),
        "card": np.flatnonzero(counts_between(digit, offsets) >= 14),
        "phone": np.flatnonzero(counts_between((data == ord("+")) & next_digit, offsets)),
    }


def line_sequences(data: np.ndarray, starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First words of the lines of a chunk's texts (with a last entry); a line is a sequence."""
    breaks = np.unique(np.concatenate([offsets, np.flatnonzero(data == 0x0A) + 1]))
    return np.unique(np.concatenate([[0], np.searchsorted(starts, breaks), [len(starts)]]))


@cache
def model() -> crf.Field:
    """The field trained on the labelled table; the same each time, so trained once a process."""
    features, first, labels = [], [0], []
    for text, spans in labelled_sentences():
        data = np.frombuffer(text.encode(), np.uint8)
        starts, ends, _ = word_bounds(data, np.array([0, len(data)]))
        place = np.cumsum(np.concatenate([[0], (data & 0xC0) != 0x80]))
        tags = np.zeros(len(starts), np.int64)
        for begin, end, kind in spans:
            inside = np.flatnonzero((place[starts] < end) & (place[ends] > begin))
            tags[inside] = 2 + 2 * KINDS.index(kind)
            tags[inside[0]] -= 1
        features.append(crf.word_features(data, starts, ends))
        labels.append(tags)
        first.append(first[-1] + len(starts))
    return crf.train(np.concatenate(features), np.array(first), np.concatenate(labels), len(LABELS))


def entities(labels: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
    """(first word, last word, kind number) of labelled runs; a run ends with its line."""
    out = []
    at = np.flatnonzero(labels)
    starts_line = np.zeros(len(labels) + 1, bool)
    starts_line[first] = True
    for i in at.tolist():
        kind, inside = (labels[i] - 1) // 2, labels[i] % 2 == 0
        if inside and out and out[-1][1] == i - 1 and out[-1][2] == kind and not starts_line[i]:
            out[-1] = (out[-1][0], i, kind)
        else:
            out.append((i, i, kind))
    return out


def _trimmed(data: bytes, start: int, end: int) -> tuple[int, int]:
    while start < end and data[start] in _TRIM_LEFT and not (data[start] == 0x28 and b")" in data[start:end]):
        start += 1
    while end > start and data[end - 1] in _TRIM_RIGHT and not (data[end - 1] == 0x29 and b"(" in data[start:end]):
        end -= 1
    return start, end


def _chunk_spans(field: crf.Field, data: np.ndarray, offsets: np.ndarray, texts: pa.Array) -> list[list[tuple[int, int, str]]]:
    spans: list[list[tuple[int, int, str]]] = [[] for _ in range(len(offsets) - 1)]
    for kind, numbers in possible(data, offsets).items():
        for i, text in zip(numbers.tolist(), texts.take(pa.array(numbers)), strict=True):
            spans[i] += FINDERS[kind](text.as_py())
    starts, ends, _ = word_bounds(data, offsets)
    if not len(starts):
        return spans
    first = line_sequences(data, starts, offsets)
    labels = field.tag(crf.word_features(data, starts, ends), first)
    found = entities(labels, first)
    if not found:
        return spans
    buffer = data.tobytes()
    place = np.cumsum(np.concatenate([[0], (data & 0xC0) != 0x80]))
    base = [sorted(s) for s in spans]
    for a, b, kind in found:
        start, end = _trimmed(buffer, int(starts[a]), int(ends[b]))
        if start >= end:
            continue
        text = int(np.searchsorted(offsets, start, "right")) - 1
        begin, stop = int(place[start] - place[offsets[text]]), int(place[end] - place[offsets[text]])
        if all(stop <= s or e <= begin for s, e, _ in base[text]):
            spans[text].append((begin, stop, FOUND[kind]))
    return spans


def _scan(batches: Iterator[pa.RecordBatch], field: crf.Field) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").fill_null("")
        for rows, data, offsets in text_chunks(texts):
            size = rows.stop - rows.start
            found = _chunk_spans(field, data, offsets, texts.slice(rows.start, size))
            base = [[s for s in spans if s[2] in KINDS] for spans in found]
            out = [batch.column("doc_id").slice(rows.start, size)]
            out += [pa.array([sum(s[2] == kind for s in spans) for spans in base], pa.int64()) for kind in KINDS]
            digests = [hashlib.sha256(joined(spans, ORDER).encode()).hexdigest() for spans in base]
            out += [pa.array(digests, pa.string()), pa.array([joined(s, ORDER) for s in found], pa.string())]
            names = ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"]
            yield pa.record_batch(out, names=names)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Fixed patterns give the base spans. A linear-chain conditional random field over
    word shapes, trained on a small labelled table at the start, labels the words of
    every line (Viterbi over all lines of some megabytes of text at once) and adds
    spans ``<kind>_crf`` where no base span overlaps: spelled-out addresses, numbers
    without a country code and the like. ``spans`` lists kind:start:end (code points)
    by start and kind; ``base_sha256`` is the digest of the base kinds' list.

    Lines in which no labelling can beat "all outside" are told by a bound on the
    weights and skip the decoding, with the same result. Null and empty texts have no
    spans. Rows are independent: ids may be null or repeat, other columns do not
    matter, an empty table gives an empty result. There is no shuffle.
    """
    ship(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    field = model()
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return own.mapInArrow(lambda it: _scan(it, field), f"doc_id long, {counts}, base_sha256 string, spans string")
