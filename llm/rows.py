"""Carry all columns of a table past an operator as one struct, whatever their names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def as_rows(df: DataFrame, **strings: str) -> DataFrame:
    """``row`` (all columns under names of their own) and the given columns as strings."""
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    own = [F.col(f"c{df.columns.index(name)}").cast("string").alias(alias) for alias, name in strings.items()]
    return plain.select(F.struct("*").alias("row"), *own)


def from_rows(rows: DataFrame, df: DataFrame, **replaced: str) -> DataFrame:
    """The columns of ``df`` again; ``replaced`` names those to take from other columns of ``rows``."""
    columns = []
    for i, field in enumerate(df.schema):
        value = F.col(replaced[field.name]) if field.name in replaced else F.col(f"row.c{i}")
        columns.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*columns)


def broadcast_bytes(spark: SparkSession) -> int:
    """Spark's own limit for a broadcast table; -1 where there is to be none."""
    return spark._jvm.org.apache.spark.sql.internal.SQLConf.get().autoBroadcastJoinThreshold()
