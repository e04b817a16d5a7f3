"""Secrets in text, found through a trigram index."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.rows import as_rows, from_rows
from llm.shipping import ship
from llm.trigrams import TrigramIndex, compiled

BASE = ("assign", "access", "hex")
# A private key from its BEGIN to its END line, whatever stands between them but another such
# line. Without an END line: header lines, or headers and more on one line up to a long base64
# word; then long base64 words (quoted, indented or parted by escaped line ends as well), and
# whole lines of shorter ones or a padded end. No look-around, so that SQL engines take the rule.
_SEP = r"""(?:[\x20\t\r\n>|#*"'+,;]|\\[nrt])"""
_EOL = r"(?:\r?\n|\\r\\n|\\n)"
_NAME = r"[\x20\t>|#*]*[A-Z][A-Za-z0-9-]*:\x20"
# A line end inside one quoted string, and the start of the next.
_QUOTED = r"""(?:\\r)?\\n["'][\x20\t+.]*\r?\n[\x20\t]*["']"""
_KEY = (
    r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
    r"(?:[^-]*(?:-{1,4}[^-]+)*-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
    rf"|(?:\r?\n{_NAME}[^\r\n]*|(?:\\r)?\\n{_NAME}[^\\\r\n]*|{_QUOTED}{_NAME}[^\\\r\n]*)*"
    r"(?:(?:\\[nrt]|[^A-Za-z0-9-])*[A-Z][A-Za-z-]*:\x20(?:[^-\r\n]|-[^-\r\n])*?[^A-Za-z0-9+/=-][A-Za-z0-9+/=]{40,})?"
    rf"(?:{_SEP}*[A-Za-z0-9+/=]{{24,}})*"
    rf"(?:{_SEP}+(?:[A-Za-z0-9+/]+={{1,2}}|=[A-Za-z0-9+/]{{4}})){{0,2}}"
    rf"(?:(?:{_EOL}[\x20\t>|#*]*[A-Za-z0-9+/=]+)+(?:{_EOL}|$))?)"
)
# The kinds, their patterns and the least length of the secret part
# (group 2 of assign, else the whole match). Base kinds first.
RULES = {
    "assign": (r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    "access": (r"AKIA[A-Z0-9]+", 20),
    "hex": (r"[0-9a-f]+", 24),
    "private_key": (_KEY, 27),
    "code_host": (r"gh[opsur]_[A-Za-z0-9]+", 40),
    "chat": (r"xox[abprs]-[A-Za-z0-9-]+", 20),
    "maps": (r"AIza[A-Za-z0-9_-]+", 39),
    "payment": (r"[rs]k_live_[A-Za-z0-9]+", 24),
    "web_token": (r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    "bearer": (r"[Bb]earer [A-Za-z0-9._~+/=-]+", 27),
}
PATTERNS = {kind: pattern for kind, (pattern, _) in RULES.items()}
ORDER = {kind: i for i, kind in enumerate(RULES)}
REDACTED = "[SECRET]"
_cache: dict[str, object] = {}


def _tools():
    if not _cache:
        # A run of the class is one match, so the least length can stand in the pattern that scans fully.
        quick = {**PATTERNS, "hex": r"[0-9a-f]{24,}"}
        _cache.update(index=TrigramIndex(PATTERNS), patterns=compiled(quick))
    return _cache["index"], _cache["patterns"]


def spans_of(kind: str, pattern, text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the matches that are long enough, in code points."""
    least = RULES[kind][1]
    group = 2 if kind == "assign" else 0
    return [(m.start(), m.end(), kind) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]


def joined(spans: list[tuple[int, int, str]], order: dict[str, int]) -> str:
    spans = sorted(spans, key=lambda s: (s[0], order[s[2]]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index, patterns = _tools()
    for batch in batches:
        texts = batch.column("text").fill_null("")
        for rows, candidates in index.segments(texts):
            found: list[list] = [[] for _ in range(rows.stop - rows.start)]
            own = texts.slice(rows.start, rows.stop - rows.start)
            for kind, numbers in candidates.items():
                picked = own if len(numbers) == len(own) else own.take(pa.array(numbers))
                for i, text in zip(numbers, picked, strict=True):
                    found[i] += spans_of(kind, patterns[kind], text.as_py())
            base = [[s for s in spans if s[2] in BASE] for spans in found]
            out = [batch.column("doc_id").slice(rows.start, rows.stop - rows.start)]
            out += [pa.array([sum(s[2] == kind for s in spans) for spans in base], pa.int64()) for kind in BASE]
            digests = [hashlib.sha256(joined(spans, ORDER).encode()).hexdigest() for spans in base]
            out += [pa.array(digests, pa.string()), pa.array([joined(s, ORDER) for s in found], pa.string())]
            out += [pa.array([[k for _, _, k in sorted(s)] for s in found], pa.list_(pa.string()))]
            yield pa.record_batch(
                out, names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "kinds"]
            )


def _redact_batches(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    """Rows, and the new text of those that change."""
    index, patterns = _tools()
    for batch in batches:
        texts = batch.column("row").field(text_at).cast(pa.string())
        found: dict[int, list[tuple[int, int, str]]] = {}
        for rows, candidates in index.segments(texts):
            for kind, numbers in candidates.items():
                for i in (numbers + rows.start).tolist():
                    spans = spans_of(kind, patterns[kind], texts[i].as_py() or "")
                    if spans:
                        found.setdefault(i, []).extend(spans)
        out: list[str | None] = [None] * len(texts)
        for i, spans in found.items():
            out[i] = redacted(texts[i].as_py(), spans)
        yield pa.record_batch([batch.column("row"), pa.array(out, pa.string())], names=["row", "text"])


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each run of overlapping spans replaced by a mark."""
    parts, at = [], 0
    for start, end, _ in sorted(spans):
        if start >= at:
            parts += [text[at:start], REDACTED]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact_secrets(docs: DataFrame, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns of ``docs``, secrets in the text replaced by ``[SECRET]``.

    ``size_col``, where given, becomes the new text's code points. Rows without
    secrets, null texts too, stay as they are. An empty table gives an empty result;
    columns of any name pass, whatever the operator's own are called.
    """
    ship(docs.sparkSession)
    rows = as_rows(docs)
    kind, text_at = rows.schema["row"].dataType.simpleString(), docs.columns.index(text_col)
    done = rows.mapInArrow(lambda it: _redact_batches(it, text_at), f"row {kind}, changed string")
    done = done.withColumn("text", F.coalesce("changed", F.col(f"row.c{text_at}").cast("string")))
    if size_col is None:
        return from_rows(done, docs, **{text_col: "text"})
    old = F.col(f"row.c{docs.columns.index(size_col)}")
    done = done.withColumn("n", F.coalesce(F.char_length("changed").cast("long"), old))
    return from_rows(done, docs, **{text_col: "text", size_col: "n"})


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets of every row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, kinds.

    Each pattern's mandatory trigrams give a Boolean query; postings of each segment of
    texts are intersected, and only candidates are verified by the pattern. ``hex`` has
    no mandatory trigram and scans fully. ``spans`` lists kind:start:end (code points)
    by start and kind; ``base_sha256`` is the digest of the base kinds' list. A private
    key's span holds the key itself, to its END line or to the end of its base64 lines.

    Null and empty texts have no spans. Rows are independent: ids may be null or
    repeat, other columns do not matter, an empty table gives an empty result. There
    is no shuffle; a task holds a segment of about 1 MB, or one longer text.
    """
    ship(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(
        _scan,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, kinds array<string>",
    )
