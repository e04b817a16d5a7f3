"""One query per operator over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.html_text import main_text
from llm.importance import resampled
from llm.merkle import manifest
from llm.mixing import mixture
from llm.near_dedup import near_duplicates
from llm.order_minhash import edited_fingerprints
from llm.packing import pack
from llm.pii import personal_data
from llm.quality_model import score_documents
from llm.quality_rules import quality_rules
from llm.secret_scan import secret_scan
from llm.token_counts import token_counts
from llm.warc import derivatives, responses

TOKENIZER = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), link_percent=85)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(_table(spark, sf_dir, "documents")).drop("kinds")


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(_table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.withColumn("ids_crc32", F.crc32("tokens")).drop("tokens")


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(_table(spark, sf_dir, "documents"))


def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = derivatives(responses(_table(spark, sf_dir, "pages")))
    named = {
        "record_type": "WARC-Type",
        "record_id": "WARC-Record-ID",
        "refers_to": "WARC-Refers-To",
        "target_uri": "WARC-Target-URI",
        "record_date": "WARC-Date",
        "payload_digest": "WARC-Payload-Digest",
        "block_digest": "WARC-Block-Digest",
        "content_type": "Content-Type",
    }
    return derived.select(
        F.col("source_id").alias("page_id"),
        *(F.col("headers")[header].alias(name) for name, header in named.items()),
        F.col("headers")["Content-Length"].cast("long").alias("content_length"),
        "content",
    )


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("n_words")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(_table(spark, sf_dir, "documents")).drop("source")


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), TOKENIZER)


def queries() -> dict[str, Query]:
    named = (
        op1_near_dedup,
        op2_secret_scan,
        op3_order_minhash,
        op4_mixing,
        op5_packing,
        op6_quality_model,
        op7_quality_rules,
        op8_html_text,
        op9_personal_data,
        op10_warc_derivatives,
        op11_importance,
        op12_merkle,
        op13_token_counts,
    )
    return {f.__name__: f for f in named}
