"""Document quality by a regularised quadratic discriminant over text statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.sinks.staging import Staging
from llm.byteops import LOWER, span_hashes, text_chunks, word_bounds
from llm.shipping import ship
from llm.text_stats import counts_between, repeats, rule_counts

FEATURES = (
    "words", "word_length", "symbols", "bars", "repeated_lines", "repeated_words",
    "capitals", "digits", "marks", "shouts", "line_length", "distinct_words",
)
THRESHOLD = 0.3
# Shares of the pooled covariance and of its mean variance in each class's covariance.
POOLED, SPHERE = 0.3, 0.05
# The least variance of the sphere, in units of the features' own: texts may be all alike.
LEAST_VARIANCE = 0.01
FOLDS, HELD_OUT = 5, 0


def _table(*chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in "".join(chars)]] = True
    return out


_BARS, _DIGITS, _MARKS, _SHOUTS = _table("|"), _table("0123456789"), _table(".,;:?"), _table("!")
_CAPITALS = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTERS = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")


def text_features(column: pa.Array) -> Iterator[tuple[slice, np.ndarray]]:
    """(rows, (texts, FEATURES)): shares as square roots and sizes as logarithms, near symmetric."""
    for (rows, counts), (_, data, offsets) in zip(rule_counts(column), text_chunks(column), strict=True):
        starts, ends, first = word_bounds(data, offsets)
        words = span_hashes(LOWER[data], starts, ends)
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        again, _ = repeats(words, owner)
        n = np.maximum(counts["n_words"], 1)
        chars = np.maximum(counts["word_chars"], 1)
        of = lambda mask: counts_between(mask[data], offsets)
        distinct = counts["n_words"] - np.bincount(owner[again], minlength=len(n))
        yield rows, np.stack(
            [
                np.log1p(counts["n_words"]),
                np.log1p(counts["word_chars"] / n),
                np.sqrt(counts["n_symbols"] / n),
                np.sqrt(of(_BARS) / n),
                np.sqrt(counts["n_dup_lines"] / np.maximum(counts["n_lines"], 1)),
                np.sqrt(counts["n_repeat_words"] / n),
                np.sqrt(of(_CAPITALS) / np.maximum(of(_LETTERS), 1)),
                np.sqrt(of(_DIGITS) / chars),
                np.sqrt(of(_MARKS) / n),
                np.sqrt(of(_SHOUTS) / n),
                np.log1p(counts["n_words"] / np.maximum(counts["n_lines"], 1)),
                # Distinct words grow slower than words: compare logarithms.
                np.log1p(distinct) / np.log1p(n),
            ],
            axis=1,
        )


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, values in text_features(batch.column("text")):
            flat = pa.array(values.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * len(FEATURES)), flat)
            ids = batch.column("doc_id").slice(rows.start, rows.stop - rows.start)
            yield pa.record_batch([ids, lists], names=["doc_id", "features"])


@dataclass(frozen=True)
class Discriminant:
    """Log priors, means and Cholesky factors of the two classes, scaled features."""

    center: np.ndarray
    scale: np.ndarray
    priors: tuple[float, float]
    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1: a sigmoid of the difference of log densities."""
        x = (x - self.center) / self.scale
        density = []
        for prior, mean, factor in zip(self.priors, self.means, self.factors, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            density.append(math.log(prior) - np.log(np.diag(factor)).sum() - (z * z).sum(axis=0) / 2)
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def discriminant(counts: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> Discriminant | float:
    """The model of class counts, feature sums and sums of products; a constant score without both classes."""
    total = counts.sum()
    if not counts.all():
        return float(counts[1] / total) if total else 0.5
    center = sums.sum(axis=0) / total
    scale = np.sqrt(np.maximum(np.diag(squares.sum(axis=0)) / total - center**2, 1e-6))
    means, own = [], []
    for n, s, q in zip(counts, sums, squares, strict=True):
        mean = s / n
        own.append((q / n - np.outer(mean, mean)) / np.outer(scale, scale))
        means.append((mean - center) / scale)
    pooled = (counts[0] * own[0] + counts[1] * own[1]) / total
    sphere = np.eye(len(center)) * max(np.trace(pooled) / len(center), LEAST_VARIANCE)
    covariances = [(1 - POOLED - SPHERE) * c + POOLED * pooled + SPHERE * sphere for c in own]
    factors = tuple(np.linalg.cholesky(c) for c in covariances)
    return Discriminant(center, scale, tuple((counts / total).tolist()), tuple(means), factors)


def _moment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count, sums and sums of products by label of each batch."""
    for batch in batches:
        label = batch.column("label").to_numpy()
        x = np.array(batch.column("features").flatten().to_numpy()).reshape(-1, len(FEATURES))
        for value in (0, 1):
            own = x[label == value]
            if len(own):
                flat = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
                yield pa.record_batch([pa.array([value], pa.int32()), pa.array([flat.tolist()])], names=["label", "moments"])


def train(labelled: DataFrame) -> Discriminant | float:
    """The model of ``labelled`` (features, label 0 or 1): moments are summed in Spark, two rows come back."""
    d = len(FEATURES)
    moments = labelled.mapInArrow(_moment_batches, "label int, moments array<double>")
    flat = moments.select("label", F.posexplode("moments")).groupBy("label", "pos").agg(F.sum("col").alias("value"))
    counts, sums, squares = np.zeros(2), np.zeros((2, d)), np.zeros((2, d * d))
    for label, at, value in flat.collect():
        if at == 0:
            counts[label] = value
        elif at <= d:
            sums[label, at - 1] = value
        else:
            squares[label, at - 1 - d] = value
    return discriminant(counts, sums, squares.reshape(2, d, d))


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def score_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; ``labels`` has ``id_col`` and ``label_col``.

    Statistics of the whole text are taken once and staged. A quadratic discriminant is
    fitted on the labelled rows outside the held-out fold (crc32 of the id modulo 5 is
    0): class means and covariances, each covariance shrunk towards the pooled one and
    a sphere. The score is the sigmoid of the difference of the two log densities from
    Mahalanobis distances through Cholesky factors; ``predicted`` is score >= 0.3.

    Null and empty texts have the statistics of no words and are scored too. Labels
    other than 0 and 1, null labels and labels without a document are not used; a
    document labelled twice counts twice. One row a class, or rows all alike, have the
    sphere alone as covariance. Without labels of both classes every score is
    the share of ones, 0.5 without any. A null id is no label's and its fold that of an
    empty text. Other columns do not matter; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    stage = Staging(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    features = stage(own.mapInArrow(_feature_batches, "doc_id long, features array<double>"), "features")
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & (fold(F.col("doc_id")) != HELD_OUT))
    model = train(features.join(known, "doc_id").select("features", "label"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if isinstance(model, float):
                score = np.full(batch.num_rows, model)
            else:
                score = model.scores(batch.column("features").flatten().to_numpy().reshape(-1, len(FEATURES)))
            yield pa.record_batch([batch.column("doc_id"), pa.array(score, pa.float64())], names=["doc_id", "score"])

    out = features.mapInArrow(scored, "doc_id long, score double")
    return out.select(
        "doc_id",
        (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
