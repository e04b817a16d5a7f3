"""Two-way set difference of two tables in one aggregation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEFT, RIGHT, BOTH = 1, 2, 3


def two_way_difference(
    left: DataFrame,
    right: DataFrame,
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Distinct rows found on one side only, with ``_side`` 1 (left) or 2 (right).

    Same rows as ``left.subtract(right)`` and ``right.subtract(left)`` together
    (NULL equals NULL), but columns are aligned by name and both differences come
    from one shuffle: rows are grouped by all columns and each group remembers the
    sides it was seen on. Copies of a row collapse before the shuffle.

    All columns of ``left`` are compared. With ``carry``, ``right`` may have more
    columns, and the given aggregates over them come along (NULL on the left).
    """
    columns = left.columns
    odd = set(columns) - set(right.columns) if carry else set(columns) ^ set(right.columns)
    if odd:
        raise ValueError(f"not a column of both sides: {sorted(odd)}")
    tagged = left.withColumn("_side", F.lit(LEFT)).unionByName(
        right.withColumn("_side", F.lit(RIGHT)), allowMissingColumns=carry is not None
    )
    extra = [agg.alias(name) for name, agg in (carry or {}).items()]
    return (
        tagged.groupBy(*columns)
        .agg(F.bit_or("_side").alias("_side"), *extra)
        .filter(F.col("_side") != BOTH)
    )


def rows_only_left(left: DataFrame, right: DataFrame) -> DataFrame:
    return two_way_difference(left, right).filter(F.col("_side") == LEFT).drop("_side")


def rows_only_right(left: DataFrame, right: DataFrame) -> DataFrame:
    return two_way_difference(left, right).filter(F.col("_side") == RIGHT).drop("_side")
