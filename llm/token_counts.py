"""Token counts of texts through a cache of content digests."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.sinks.files import path_exists
from lakeops.sinks.staging import Staging
from llm.batches import small_batches
from llm.byteops import span_hashes, text_chunks, word_bounds
from llm.packing import SEPARATOR, _encoder, units
from llm.rows import broadcast_bytes as _broadcast_bytes
from llm.shipping import ship
from llm.tokenizer_files import library_of, tokenizer_path, version_digest

TOKEN_LIMIT = 2048
# Bytes of one digest in a list of misses that is sent to all tasks.
DIGEST_BYTES = 40
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CACHE_SCHEMA = "digest binary, n_tokens long, version string"


@lru_cache(8)
def divides_words(name: str) -> bool:
    """Whether a tokenizer drops white space and case and never joins two words.

    Read from its file: white space becomes single spaces, all is lower case, the rest
    is parted by a pattern without white space, and the last token of a word is marked.
    """
    if library_of(name) != "tokenizers":
        return False
    with open(tokenizer_path(name), encoding="utf-8") as file:
        made = json.load(file)
    steps = (made["normalizer"] or {}).get("normalizers") or []
    spaces = any(s["type"] == "Replace" and s["pattern"] == {"Regex": "\\s+"} and s["content"] == " " for s in steps)
    parts = (made["pre_tokenizer"] or {}).get("pretokenizers") or []
    drops = any(p["type"] == "Split" and p["behavior"] == "Removed" and p["invert"] for p in parts)
    lower = any(s["type"] == "Lowercase" for s in steps)
    known = any(t["content"] == SEPARATOR for t in made["added_tokens"])
    return spaces and lower and drops and known and made["model"].get("end_of_word_suffix") == "</w>"


def normalised(text: Column, words: bool) -> Column:
    """The content that decides a text's count; null is empty.

    For a tokenizer that divides words, runs of blanks and line ends are one space, and
    A-Z are lower case where the text is ASCII alone and can hold no special token: the
    tokenizer does both itself. Otherwise the text as it is.
    """
    text = F.coalesce(text, F.lit(""))
    if not words:
        return text
    even = F.trim(F.regexp_replace(text, "[ \\t\\n\\r]+", " "))
    plain = (F.octet_length(even) == F.char_length(even)) & ~F.contains(even, F.lit("<|"))
    return F.when(plain, F.translate(even, _UPPER, _LOWER)).otherwise(even)


def _word_counter(path: str) -> Callable[[pa.Array], Iterator[tuple[slice, np.ndarray]]]:
    """Counts by the different words of some megabytes of text, each encoded once."""
    encoder = _encoder(path)

    def count(column: pa.Array) -> Iterator[tuple[slice, np.ndarray]]:
        for rows, data, offsets in text_chunks(column):
            data, starts, ends, first = units(data, *word_bounds(data, offsets))
            different, index, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
            buffer, begin, end = data.tobytes(), starts[index], ends[index]

            def words(at: list[int], buffer=buffer, begin=begin, end=end) -> list[str]:
                return [buffer[s:e].decode() for s, e in zip(begin[at].tolist(), end[at].tolist(), strict=True)]

            lengths = np.array([len(x) // 2 for x in encoder.encode(different.tolist(), words)], np.int64)
            sums = np.concatenate([[0], np.cumsum(lengths[inverse])])
            yield rows, np.diff(sums[first])

    return count


def _text_counter(path: str) -> Callable[[pa.Array], Iterator[tuple[slice, np.ndarray]]]:
    """Counts by the tokenizer's library, text by text."""
    if library_of(path) == "sentencepiece":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lambda text: len(model.encode(text))
    else:
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.no_truncation()
        made.no_padding()
        size = lambda text: len(made.encode(text, add_special_tokens=False))
    return lambda column: iter([(slice(0, len(column)), np.array([size(x.as_py()) for x in column], np.int64))])


def _count_batches(batches: Iterator[pa.RecordBatch], name: str, version: str) -> Iterator[pa.RecordBatch]:
    if version_digest(name) != version:
        raise ValueError(f"{name} differs between the driver and a worker")
    path = tokenizer_path(name)
    counter = _word_counter(path) if divides_words(name) else _text_counter(path)
    for batch in batches:
        for rows, counts in counter(batch.column("content")):
            digests = batch.column("digest").slice(rows.start, rows.stop - rows.start)
            yield pa.record_batch([digests, pa.array(counts)], names=["digest", "n_tokens"])


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) that a cache holds for a tokenizer version; other versions' files are not read."""
    if not path_exists(spark, cache):
        return spark.createDataFrame([], CACHE_SCHEMA).drop("version")
    rows = spark.read.schema(CACHE_SCHEMA).option("basePath", cache).parquet(cache)
    return rows.where(F.col("version") == version).drop("version")


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    cache: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = TOKEN_LIMIT,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row's whole text.

    ``tokenizer`` is a public tokenizer's file name or a path. ``cache`` is a folder of
    Parquet files (digest, n_tokens) by tokenizer version; without one, the counts of
    this call are kept with the application's intermediate tables.

    1. Each text's normalised content is digested; narrow rows are staged.
    2. Their distinct digests are joined with the stored counts of this tokenizer: the
       digest of its file, library and library version.
    3. Of the digests that are missing, one content each is encoded, and the counts
       are appended to the cache. Copies collapse before the shuffle of the contents,
       so a text that a third of all rows have is one row a task; where the misses are
       few by their exact number, only their texts are shuffled.
    4. Rows take their counts by digest, both sides from staged tables, so that AQE
       splits a hot digest.

    A run that fails before step 3 ends appends nothing; two runs at once may append a
    count twice, which reading undoes. Null texts are empty and have 0 bytes and tokens.
    No text is cut. Rows are independent: ids may be null or repeat, other columns do
    not matter, an empty table gives an empty result and leaves the cache as it is.
    """
    spark = docs.sparkSession
    ship(spark)
    stage = Staging(spark)
    cache = cache or f"{stage.path}/token-counts"
    version, words = version_digest(tokenizer), divides_words(tokenizer)
    text = F.col(text_col).cast("string")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), normalised(text, words).alias("content"))
    own = own.withColumn("digest", F.unhex(F.sha2(F.col("content").cast("binary"), 256)))
    rows = stage(own.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "digest"), "rows")

    wanted = rows.select("digest").distinct()
    known = stored_counts(spark, cache, version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    joined = stage(wanted.join(known, "digest", "left"), "wanted")
    missing = joined.where("n_tokens is null").select("digest")
    counts = joined.where("n_tokens is not null")
    n_missing = missing.count()
    if n_missing:
        contents = own.select("digest", "content")
        few = n_missing * DIGEST_BYTES <= _broadcast_bytes(spark)
        if few and n_missing < stage.rows["wanted"]:
            contents = contents.join(F.broadcast(missing), "digest", "left_semi")
        contents = contents.groupBy("digest").agg(F.first("content").alias("content"))
        if not few:
            contents = contents.join(missing, "digest", "left_semi")
        with small_batches(spark):
            new = stage(
                contents.mapInArrow(lambda it: _count_batches(it, tokenizer, version), "digest binary, n_tokens long"), "new"
            )
        new.withColumn("version", F.lit(version)).write.mode("append").partitionBy("version").parquet(cache)
        counts = counts.unionByName(new)
    return rows.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

