"""Quality rules per document and per host."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.sinks.staging import Staging
from llm.rows import as_rows, from_rows
from llm.shipping import ship
from llm.text_stats import rule_counts

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
# A host is rejected where its shrunk failure rate exceeds this percentage.
MAX_HOST_PERCENT = 50
# The weight, in documents, of the prior where hosts do not differ measurably, and its lower end.
MOST_PRIOR, LEAST_PRIOR = 1000.0, 2.0


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, counts in rule_counts(batch.column("text")):
            part = batch.slice(rows.start, rows.stop - rows.start)
            yield pa.record_batch(
                [part.column("doc_id"), part.column("host"), *(pa.array(counts[c].astype("int64")) for c in COUNTS)],
                names=["doc_id", "host", *COUNTS],
            )


def document_counts(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """(doc_id, host, counts) of every row, in one pass over the text."""
    ship(docs.sparkSession)
    own = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(host_col).cast("string").alias("host"),
        F.col(text_col).cast("string").alias("text"),
    )
    return own.mapInArrow(_count_batches, "doc_id long, host string, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def rule_failed() -> Column:
    """The base rules and those on symbols and repeated lines."""
    symbols = 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("n_words")
    lines = 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")
    return base_failed() | symbols | lines


def host_verdicts(counted: DataFrame, stage: Staging) -> DataFrame:
    """(host, host_documents, host_failures, host_rate, host_rejected).

    The beta prior's mean is the rate over all documents; its weight follows from how
    far the hosts' own rates scatter beyond chance (method of moments). A host's rate
    is its failures and the prior's together, so few documents say little.
    """
    hosts = counted.groupBy("host").agg(
        F.count("*").alias("host_documents"), F.sum(rule_failed().cast("long")).alias("host_failures")
    )
    hosts = stage(hosts, "host-counts")
    n, x = F.col("host_documents"), F.col("host_failures")
    whole = hosts.agg(
        F.sum(x).alias("failures"),
        F.sum(n).alias("documents"),
        F.count("*").alias("hosts"),
        F.sum(n * n).alias("squares"),
        F.sum(x * x / n).alias("within"),
    )
    p = F.col("failures") / F.col("documents")
    # Sum of n (rate - p)^2, its expectation without a spread, and the spread per unit.
    scatter = F.col("within") - F.col("documents") * p * p
    expected = (F.col("hosts") - 1) * p * (1 - p)
    unit = F.col("documents") - F.col("squares") / F.col("documents")
    spread = (scatter - expected) / F.when(unit > 0, unit)
    weight = F.when(spread > 0, p * (1 - p) / spread - 1).otherwise(MOST_PRIOR)
    prior_rate, prior_documents = whole.select(
        F.coalesce(p, F.lit(0.0)), F.least(F.greatest(weight, F.lit(LEAST_PRIOR)), F.lit(MOST_PRIOR))
    ).first()
    rate = (x + prior_rate * prior_documents) / (n + prior_documents)
    return hosts.select(
        "host",
        "host_documents",
        "host_failures",
        rate.alias("host_rate"),
        (100 * rate > MAX_HOST_PERCENT).alias("host_rejected"),
    )


def _verdict_batches(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    """The batch's rows with their counts; the text is a field of the row, not sent twice."""
    for batch in batches:
        for rows, counts in rule_counts(batch.column("row").field(text_at).cast(pa.string())):
            part = batch.column("row").slice(rows.start, rows.stop - rows.start)
            yield pa.record_batch(
                [part, *(pa.array(counts[c].astype("int64")) for c in COUNTS)], names=["row", *COUNTS]
            )


def keep_by_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_rules` keeps, with all their columns.

    Texts are read twice, for the hosts' rates and for the rows, and not shuffled.
    """
    stage = Staging(docs.sparkSession)
    counted = document_counts(docs, id_col, text_col, host_col)
    verdicts = host_verdicts(counted, stage).select(F.col("host").alias("of"), "host_rejected")
    rows = as_rows(docs)
    kind, text_at = rows.schema["row"].dataType.simpleString(), docs.columns.index(text_col)
    counts = rows.mapInArrow(
        lambda it: _verdict_batches(it, text_at), f"row {kind}, " + ", ".join(f"{c} long" for c in COUNTS)
    )
    host = F.col(f"row.c{docs.columns.index(host_col)}").cast("string")
    kept = counts.where(~rule_failed()).join(verdicts, host.eqNullSafe(F.col("of")))
    return from_rows(kept.where("not host_rejected"), docs)


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """Rule counts and verdict of every row.

    Returns doc_id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words, base_failed, failed, host_rejected, kept. Words are
    ``[^\\x20\\x09-\\x0D]+``. ``failed``: fewer than 20 words, over 30 percent of words in
    repeated 8-word windows, over 10 symbols to 100 words, or over 30 percent repeated
    lines. Failures are counted per host (:func:`host_verdicts`); documents of a
    rejected host go with it. ``kept`` is neither failed nor of a rejected host.

    A null or empty text has no words and fails. Null hosts are one host. Repeated rows
    count each; ids may be null or repeat. Other columns do not matter; an empty table
    gives an empty result. Counts are staged once, so texts are read in one pass; hosts
    are aggregated before the shuffle and joined back by their key.
    """
    stage = Staging(docs.sparkSession)
    counted = stage(document_counts(docs, id_col, text_col, host_col), "rule-counts")
    verdicts = host_verdicts(counted, stage).select(F.col("host").alias("of"), "host_rejected")
    joined = counted.join(verdicts, F.col("host").eqNullSafe(F.col("of")), "left")
    return joined.select(
        "doc_id",
        "host",
        *COUNTS,
        base_failed().alias("base_failed"),
        rule_failed().alias("failed"),
        "host_rejected",
        (~rule_failed() & ~F.col("host_rejected")).alias("kept"),
    )
