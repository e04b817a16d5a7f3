"""Pack tokenized documents into sequences, neighbours along a Hilbert curve together."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.sinks.staging import Staging
from llm.batches import small_batches
from llm.byteops import LOWER, ranges, span_hashes, text_chunks, word_bounds
from llm.shipping import ship
from llm.tokenizer_files import tokenizer_path

SEQUENCE = 2048
END_ID = 1
ID_BYTES = 4
DIMENSIONS = 4
BITS = 10
# Mean coordinates lie near zero; the factor spreads them over the curve's cube.
SPREAD = 8.0
# Words given to the tokenizer at once, divided by a special token.
ENCODE_WORDS = 4096
SEPARATOR = "<|endoftext|>"
REMEMBERED = 150_000
_encoders: dict[str, object] = {}


class _Encoder:
    """Ids of words by one tokenizer, remembered between batches of a worker.

    Words of Latin letters alone are one unit to the tokenizer, so many are encoded as
    one text and told apart by the tokens that end a word. Others are divided by a
    special token, which is never merged with its neighbours; words that hold such a
    string go alone. Beyond REMEMBERED words the memory begins anew; the one before is
    kept until the next time, so words that come often are not encoded again.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.split = vocabulary[SEPARATOR]
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[int, bytes] = {}
        self.before: dict[int, bytes] = {}

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2")

    def encode(self, hashes: list[int], words: Callable[[list[int]], list[str]]) -> list[bytes]:
        """Ids (two bytes each) of the words with these hashes; ``words`` spells out those at some places."""
        known, before = self.known, self.before
        out = [known.get(h) or before.get(h, b"") for h in hashes]
        missing = [i for i, x in enumerate(out) if not x]
        if missing:
            for i, x in zip(missing, self._new(words(missing)), strict=True):
                out[i] = x
        known.update(zip(hashes, out, strict=True))
        if len(known) > REMEMBERED:
            self.known, self.before = {}, known
        return out

    def _new(self, words: list[str]) -> list[bytes]:
        out = [b""] * len(words)
        plain = [i for i, w in enumerate(words) if w.isalpha() and max(w) < "\u0100"]
        for part in _parts(plain):
            ids = self.ids(" ".join([words[i] for i in part]))
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(part):
                raise ValueError("the tokenizer does not end each word with a closing token")
            _spread(out, part, ids, np.concatenate([[0], ends[:-1]]), ends)
        known = set(plain)
        for part in _parts([i for i, w in enumerate(words) if i not in known and "<|" not in w]):
            ids = self.ids(SEPARATOR.join([words[i] for i in part]) + SEPARATOR)
            ends = np.flatnonzero(ids == self.split)
            _spread(out, part, ids, np.concatenate([[0], ends[:-1] + 1]), ends)
        for i, word in enumerate(words):
            if "<|" in word:
                out[i] = self.ids(word).tobytes()
        return out


def _parts(numbers: list[int]) -> Iterator[list[int]]:
    return (numbers[i : i + ENCODE_WORDS] for i in range(0, len(numbers), ENCODE_WORDS))


def _spread(out: list[bytes], part: list[int], ids: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
    data = ids.tobytes()
    for i, b, e in zip(part, (2 * begin).tolist(), (2 * end).tolist(), strict=True):
        out[i] = data[b:e]


def _encoder(path: str) -> _Encoder:
    if path not in _encoders:
        _encoders[path] = _Encoder(path)
    return _encoders[path]


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places of integer points (n, dimensions) along a Hilbert curve of 2**bits cells a side."""
    x = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
        q >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (((x[i] ^ t) >> b) & 1)
    return key


def curve_keys(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents: the mean of their words' hashed vectors, in a cube."""
    count = np.maximum(np.diff(first), 1)
    cells = []
    for k in range(DIMENSIONS):
        value = ((words >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.float64) / 32767.5 - 1
        sums = np.concatenate([[0.0], np.cumsum(value)])
        mean = (sums[first[1:]] - sums[first[:-1]]) / count
        cells.append(((np.tanh(SPREAD * mean) + 1) / 2 * (2**BITS - 1)).astype(np.int64))
    return hilbert_key(np.stack(cells, axis=1))


_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!#$%&()*+,-./:;=?@[]_{}~")] = True


def units(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray):
    """(bytes, starts, ends, first) of the parts of words that a tokenizer encodes one by one.

    The tokenizer folds case and never joins a letter and a punctuation mark, so words
    are folded (A-Z) and cut between an ASCII letter, or a two-byte Latin one, and an
    ASCII mark: fewer different strings, the same ids. Apostrophes may stand for a
    contraction and are left alone; texts with ``<|`` may hold a special token, and a
    chunk with one is left as it is.
    """
    if b"<|" in data.tobytes():
        return data, starts, ends, first
    letter = _LETTER[data]
    latin = (data[1:] >= 0x80) & (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    after = letter.copy()
    after[1:] |= latin
    mark = _MARK[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (after[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
    cut[starts] = False
    cuts = np.flatnonzero(cut)
    new_starts = np.sort(np.concatenate([starts, cuts]))
    new_ends = np.sort(np.concatenate([ends, cuts]))
    bounds = np.append(starts, len(data) + 1)[first]
    return LOWER[data], new_starts, new_ends, np.searchsorted(new_starts, bounds)


def _token_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """doc_id, n_tokens, place, tokens (ID_BYTES an id, little-endian) of each text.

    Each different unit of some megabytes of text is encoded once. No token crosses
    units, so the ids of a text are its units' ids in order.
    """
    encoder = _encoder(tokenizer_path(path))
    for batch in batches:
        for rows, data, offsets in text_chunks(batch.column("text")):
            n_tokens, place, tokens = _chunk_tokens(encoder, data, offsets, end_id)
            doc_id = batch.column("doc_id").slice(rows.start, rows.stop - rows.start)
            yield pa.record_batch([doc_id, n_tokens, place, tokens], names=["doc_id", "n_tokens", "place", "tokens"])
            del n_tokens, place, tokens, doc_id
            pa.default_memory_pool().release_unused()


def _chunk_tokens(encoder: _Encoder, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[pa.Array, ...]:
    """Number of tokens, curve key and tokens of the texts of a chunk."""
    data, starts, ends, first = units(data, *word_bounds(data, offsets))
    hashes = span_hashes(data, starts, ends)
    place = pa.array(curve_keys(hashes, first))
    different, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    buffer, begin, end = data.tobytes(), starts[index], ends[index]
    del data, starts, ends, hashes

    def words(at: list[int]) -> list[str]:
        return [buffer[s:e].decode() for s, e in zip(begin[at].tolist(), end[at].tolist(), strict=True)]

    parts = [*encoder.encode(different.tolist(), words), np.array([end_id], "<u2").tobytes()]
    at = np.concatenate([[0], np.cumsum([len(x) // 2 for x in parts])])
    ids = np.frombuffer(b"".join(parts), "<u2").astype("<u4")
    # The end id stands after the last unit of each text.
    own = np.insert(inverse, first[1:], len(different))
    del parts, inverse, buffer, begin, end
    length = at[own + 1] - at[own]
    flat = ids[ranges(at[own], length)]
    sums = np.concatenate([[0], np.cumsum(length)])[first + np.arange(len(first))]
    buffers = [None, pa.py_buffer(sums * ID_BYTES), pa.py_buffer(flat)]
    return pa.array(np.diff(sums)), place, pa.Array.from_buffers(pa.large_binary(), len(sums) - 1, buffers).cast(pa.binary())


def _pieces(rows: DataFrame, length: int) -> DataFrame:
    """Cut each document at multiples of the sequence length of its place in the stream.

    A document's pieces are made as one array, so that its tokens are not copied with
    each piece.
    """
    piece = (
        "transform(sequence(stream_start div {n}, (stream_start + doc_tokens - 1) div {n}), s -> named_struct("
        "'sequence_id', s, 'begin', greatest(s * {n}, stream_start), "
        "'tokens', substring(tokens, cast((greatest(s * {n}, stream_start) - stream_start) * {w} + 1 as int), "
        "cast((least((s + 1) * {n}, stream_start + doc_tokens) - greatest(s * {n}, stream_start)) * {w} as int))))"
    )
    cut = rows.select("doc_id", "doc_tokens", "stream_start", F.explode(F.expr(piece.format(n=length, w=ID_BYTES))).alias("p"))
    return cut.select(
        "doc_id",
        (F.col("p.begin") - F.col("stream_start")).alias("start"),
        (F.octet_length("p.tokens") / ID_BYTES).cast("long").alias("length"),
        "p.tokens",
        "doc_tokens",
        "p.sequence_id",
        (F.col("p.begin") % length).alias("offset"),
    )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = SEQUENCE,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of all documents in sequences of ``length`` tokens.

    Returns doc_id, start, length, tokens (little-endian 32-bit ids), doc_tokens,
    sequence_id, offset. A document is its ids and ``end_id``. Documents are ordered
    along a Hilbert curve through the cube of their hashed word vectors and laid end to
    end; each multiple of ``length`` ends a sequence. Only the very last is short.

    Tokens are staged once. The order is made from narrow rows: range-sorted by curve
    key and row, summed within ranges, and the ranges' sums added from a table of one
    row a range. Many documents with one key are split over ranges by row. Rows with
    null or repeated ids are documents of their own; a null or empty text is its end id
    alone. Other columns do not matter; an empty table gives an empty result. The
    tokenizer must have fewer than 65,536 ids and know ``<|endoftext|>``.
    """
    ship(docs.sparkSession)
    stage = Staging(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tokens = own.mapInArrow(
        lambda it: _token_batches(it, tokenizer_path, end_id),
        "doc_id long, n_tokens long, place long, tokens binary",
    )
    with small_batches(docs.sparkSession):
        tokens = stage(tokens.withColumn("row", F.monotonically_increasing_id()), "tokens")
    starts = _stream_starts(tokens.select("row", "place", "n_tokens"), stage)
    tokens = tokens.select("row", "doc_id", F.col("n_tokens").alias("doc_tokens"), "tokens")
    return _pieces(tokens.join(starts, "row"), length)


def _stream_starts(rows: DataFrame, stage: Staging) -> DataFrame:
    """(row, stream_start): the sum of n_tokens of all rows before, by place and row."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, "place", "row").withColumn("part", F.spark_partition_id())
    ranged = stage(ranged, "curve")
    sums = ranged.groupBy("part").agg(F.sum("n_tokens").alias("own"))
    sums = sums.select(
        "part", F.expr("sum(own) over (order by part rows between unbounded preceding and current row) - own").alias("base")
    )
    within = "sum(n_tokens) over (partition by part order by place, row rows between unbounded preceding and current row)"
    return (
        ranged.select("row", "part", F.expr(f"{within} - n_tokens").alias("inside"))
        .join(sums, "part")
        .select("row", (F.col("inside") + F.col("base")).alias("stream_start"))
    )
