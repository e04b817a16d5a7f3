"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes whole tables: null and empty texts pass the rules or not by their
counts, have no near copies and no secrets, are taken by no mix and so are packed
nowhere; very long texts are never cut before packing, which parts them over
sequences. Rows that repeat an id are rows of their own; rows alike in id and text are
near copies of which one stays. An empty table gives an empty result. Columns beyond
those of documents pass all stages but the last, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeops.sinks.staging import Staging
from llm.mixing import mixed_documents
from llm.near_dedup import keep_one_each
from llm.packing import pack
from llm.quality_rules import keep_by_quality
from llm.secret_scan import redact_secrets

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and their host's verdict keep."""
    return keep_by_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near copies."""
    return keep_one_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mix of sources takes them."""
    return mixed_documents(docs, whole=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and their place in sequences of 2048 tokens."""
    return pack(docs, TOKENIZER)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("secret_scan", secrets),
    ("mixing", mixing),
    ("packing", packing),
]
# Shingle links, tokens and curve order are not expressible in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents, each written to shared storage and read again."""
    stage = Staging(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
