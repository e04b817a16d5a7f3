"""Data checks, counts and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.difference import LEFT, RIGHT, two_way_difference


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(column_name, null_rows)`` for all columns, from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_rows")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys found more than once, with their row count; NULL keys are not tested."""
    present = df
    for key in keys:
        present = present.filter(F.col(key).isNotNull())
    return (
        present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    )


def check_model(
    df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = ()
) -> DataFrame:
    """Rows ``(check_name, column_name, failures)``: NULL rows and repeated values.

    Columns tested for NULL alone share one pass; a column tested for repeats has
    its NULLs counted in the same pass, as the group of NULL.
    """
    names = ("check_name", "column_name", "failures")
    results = []
    nulls_only = [c for c in not_null if c not in unique]
    if nulls_only:
        nulls = null_counts(df, nulls_only).select(F.lit("not_null"), "column_name", "null_rows")
        results.append(nulls.toDF(*names))
    for column in unique:
        groups = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        missing = F.col(column).isNull()
        failures = groups.agg(
            F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("not_null"),
            F.count_if(~missing & (F.col("n") > 1)).alias("unique"),
        )
        kinds = ["not_null", "unique"] if column in not_null else ["unique"]
        rows = failures.unpivot([], kinds, "check_name", "failures")
        results.append(rows.select("check_name", F.lit(column), "failures").toDF(*names))
    if not results:
        raise ValueError("no checks given")
    return reduce(DataFrame.union, results)


def profile_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: row count, and the non-NULL count of each given column."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(c).alias(f"n_{c}") for c in columns],
    )


def top_rows(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows in an order (a display, kept as a DataFrame)."""
    return df.orderBy(*order).limit(n)


def reconcile(left: DataFrame, right: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Distinct rows only one extract has, tagged ``side`` = left or right."""
    diff = two_way_difference(left.drop(*ignore), right.drop(*ignore))
    side = F.when(F.col("_side") == LEFT, "left").otherwise("right")
    return diff.withColumn("side", side).drop("_side")


def reconcile_counts(
    left: DataFrame, right: DataFrame, ignore: Sequence[str] = ()
) -> DataFrame:
    """One row: how many distinct rows are only left, only right."""
    diff = two_way_difference(left.drop(*ignore), right.drop(*ignore))
    return diff.agg(
        F.count_if(F.col("_side") == LEFT).alias("only_left"),
        F.count_if(F.col("_side") == RIGHT).alias("only_right"),
    )
