"""Upsert and history capture between tables bucketed alike, without a shuffle.

Both sides carry a hash of their key parts, by which they are bucketed and sorted. The
hash of a NULL part is defined, so keys may match NULL or not, as the caller says, and a
join on the hash still meets rows where they lie; the key parts themselves are compared
within it. A keyed table has few rows a hash, so its buckets are even. Rows that repeat
one key, or have none, share a bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.sinks.tables import write_bucketed

KEY_HASH = "_key_hash"


def write_keyed(
    df: DataFrame, table: str, keys: Sequence[str], buckets: int, location: str | None = None
) -> DataFrame:
    """Write a table bucketed and sorted by its key's hash, and read it back.

    One shuffle, or none where ``df`` comes from such tables with as many buckets.
    """
    keyed = df if KEY_HASH in df.columns else df.withColumn(KEY_HASH, F.xxhash64(*keys))
    write_bucketed(keyed, table, [KEY_HASH], buckets, [KEY_HASH], location)
    return df.sparkSession.table(table)


def without_hash(df: DataFrame) -> DataFrame:
    return df.drop(KEY_HASH)


def _meet(keys: Sequence[str], null_safe: bool) -> Column:
    """The hash joins; a comparison of key parts that is no join key leaves the buckets usable."""
    parts = []
    for k in keys:
        old, new = F.col(f"old.{k}"), F.col(f"new.{k}")
        both = old.isNull() & new.isNull() if null_safe else F.lit(False)
        parts.append(F.coalesce(old == new, both))
    return reduce(and_, parts, F.col(f"old.{KEY_HASH}") == F.col(f"new.{KEY_HASH}"))


def upsert_bucketed(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """:func:`lakeops.operators.merge.upsert` of two tables of :func:`write_keyed`.

    ``staged`` holds one row per key. An empty side gives the other one.
    """
    kept = target.alias("old").join(staged.alias("new").hint("merge"), _meet(keys, null_safe), "left_anti")
    return kept.unionByName(staged)


def history_bucketed(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], stamp: str, flag: str = "is_deleted"
) -> DataFrame:
    """:func:`lakeops.operators.history.history_capture` of two tables of :func:`write_keyed`.

    One row per matching pair; NULL keys match nothing.
    """
    pairs = target.alias("old").join(staged.alias("new").hint("merge"), _meet(keys, False))
    return pairs.select(
        *(F.col(f"old.{c}") for c in target.columns if c != KEY_HASH),
        F.col(f"old.{stamp}").alias("valid_from"),
        F.col(f"new.{stamp}").alias("valid_to"),
        F.lit(False).alias("is_current"),
        F.when(F.col(f"new.{flag}"), "DELETE").otherwise("UPDATE").alias("change_type"),
    )


def buckets_of(spark: SparkSession) -> int:
    """As many buckets as the session has shuffle partitions: a bucket is a task's share."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
