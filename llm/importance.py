"""Draw the documents most like a target distribution: importance resampling over hashed n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.sinks.staging import Staging
from llm.batches import small_batches
from llm.byteops import text_chunks
from llm.ngram_table import folded_words, intern, ngrams, span_keys
from llm.ordering import numbered
from llm.shipping import ship

BUCKETS = 10_000
NGRAMS = (1, 1)
DRAWN_PERCENT = 10
LEAST_WORDS = 20
SEED = 2024


def _tables(column: pa.Array, orders: tuple[int, int], buckets: int):
    """(rows, words of each text, text of each n-gram, its table) of each chunk."""
    for rows, data, offsets in text_chunks(column):
        data, starts, ends, first = folded_words(data, offsets)
        starts, ends, text = ngrams(starts, ends, first, *orders)
        yield rows, np.diff(first), text, intern(data, starts, ends, span_keys(data, starts, ends), buckets)


def _count_batches(batches: Iterator[pa.RecordBatch], orders: tuple[int, int], buckets: int) -> Iterator[pa.RecordBatch]:
    """A task's occurrences by bucket: one row a bucket at most."""
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        for _, _, _, table in _tables(batch.column("text"), orders, buckets):
            used = np.flatnonzero(table.count)
            np.add.at(total, table.bucket[used], table.count[used])
    found = np.flatnonzero(total)
    yield pa.record_batch([pa.array(found), pa.array(total[found])], names=["bucket", "n"])


def bucket_counts(
    docs: DataFrame, text_col: str = "text", orders: tuple[int, int] = NGRAMS, buckets: int = BUCKETS
) -> np.ndarray:
    """Occurrences of all n-grams by bucket; ``buckets`` rows at most come back, whatever the input."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    counted = texts.mapInArrow(lambda it: _count_batches(it, orders, buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    with small_batches(docs.sparkSession):
        for bucket, n in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
            out[bucket] = n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket: thousandths of the log ratio of its smoothed target and raw shares, rounded down."""
    buckets, s, t = len(raw), int(raw.sum()), int(target.sum())

    def gain(own: int, wanted: int) -> int:
        return math.floor(1000 * math.log((wanted + 1) * float(s + buckets) / ((own + 1) * float(t + buckets))))

    return np.array([gain(own, wanted) for own, wanted in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def _weight_batches(
    batches: Iterator[pa.RecordBatch], gain: np.ndarray, orders: tuple[int, int]
) -> Iterator[pa.RecordBatch]:
    """Words, n-grams and the sum of the n-grams' gains of each text."""
    for batch in batches:
        for rows, words, text, table in _tables(batch.column("text"), orders, len(gain)):
            size = rows.stop - rows.start
            each = gain[table.bucket][table.slot]
            ends = np.cumsum(np.bincount(text, minlength=size))
            # N-grams of several orders follow one another, not their texts.
            sums = np.concatenate([[0], np.cumsum(each[np.argsort(text, kind="stable")])])
            weight = np.diff(sums[np.concatenate([[0], ends])])
            out = [batch.column("doc_id").slice(rows.start, size), pa.array(words.astype(np.int64))]
            out += [pa.array(np.diff(ends, prepend=0)), pa.array(weight)]
            yield pa.record_batch(out, names=["doc_id", "n_words", "n_features", "weight"])


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel number that depends on seed and id alone, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    orders: tuple[int, int] = NGRAMS,
    buckets: int = BUCKETS,
    percent: int = DRAWN_PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank, n_words) of every row; drawn rows have a rank.

    Features are all runs of ``orders[0]`` to ``orders[1]`` consecutive words, hashed to
    buckets. A bucket's gain is the log ratio of its share in the target to its share in
    all documents, both smoothed by one; a document's weight is the sum over its
    features. Adding Gumbel noise of the id and drawing the highest scores samples
    without replacement by the exponentials of the weights. Of the N documents with
    ``least_words`` words, floor(percent * N / 100) are drawn; ties go to the smaller id.

    1. Each task counts its n-grams by bucket in a batch's table and sends one row a
       bucket. The two count tables have ``buckets`` rows, a parameter, so their
       gains go to the tasks.
    2. A second pass gathers gains by the occurrences' slots and stages narrow rows.
    3. The highest scores are numbered over ranges of the scores.

    Null and empty texts have no features and weight 0; a null id is an empty one to the
    noise and comes last of equal scores. Rows are independent: repeated ids share their
    noise, each row is drawn by itself, and of rows alike in id and score the heavier,
    then the longer comes first. A text of any length is one chunk, never parted. An
    empty table gives an empty result, an empty target equal gains for what documents
    have equally often. Other columns do not matter.
    """
    if not 1 <= orders[0] <= orders[1]:
        raise ValueError("n-gram orders must be a range from 1 on")
    ship(docs.sparkSession)
    stage = Staging(docs.sparkSession)
    gain = gains(bucket_counts(docs, text_col, orders, buckets), bucket_counts(target, target_text_col, orders, buckets))
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    weighed = own.mapInArrow(
        lambda it: _weight_batches(it, gain, orders), "doc_id long, n_words long, n_features long, weight long"
    )
    weighed = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    with small_batches(docs.sparkSession):
        weighed = stage(weighed.withColumn("row", F.monotonically_increasing_id()), "weighed")
    able = F.col("n_words") >= least_words
    draws = percent * weighed.where(able).count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.desc("n_words"), F.asc("row")]
    placed = numbered(weighed.where(able), order, stage)
    rank = F.when(F.col("place") < draws, F.col("place") + 1)
    columns = ("doc_id", "n_features", "weight", "score")
    rest = weighed.where(~able).select(*columns, F.lit(None).cast("long").alias("rank"), "n_words")
    return placed.select(*columns, rank.alias("rank"), "n_words").unionByName(rest)
