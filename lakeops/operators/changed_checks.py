"""Data checks that cost what changed: only new rows are tested for NULL, only their keys for repeats."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

NAMES = ("check_name", "column_name", "failures")


def observe_nulls(
    df: DataFrame, columns: Sequence[str], where: Column | None = None
) -> tuple[DataFrame, Observation]:
    """``df`` and the counts its next action will have seen: ``rows``, and NULLs by column.

    The counts are taken while the rows are written, so they cost no scan. ``where``
    limits the NULL counts to some rows. An empty table counts zero.
    """
    tested = F.lit(True) if where is None else where
    counted = Observation(f"nulls-{uuid.uuid4().hex}")
    nulls = [F.count_if(F.col(c).isNull() & tested).alias(f"null_{c}") for c in columns]
    return df.observe(counted, F.count(F.lit(1)).alias("rows"), *nulls), counted


def observed_failures(changed: DataFrame, counted: Observation, columns: Sequence[str]) -> DataFrame:
    """The NULL counts of :func:`observe_nulls`, after its action, as rows of checks."""
    seen = counted.get
    rows = [F.struct(F.lit("not_null"), F.lit(c), F.lit(seen[f"null_{c}"]).cast("long")) for c in columns]
    checks = changed.sparkSession.range(1).select(F.inline(F.array(*rows)))
    return checks.toDF(*NAMES)


def repeated_changed_keys(table: DataFrame, changed: DataFrame, column: str) -> DataFrame:
    """Changed values of ``column`` that the table, changes included, holds more than once: (column, n_rows).

    Of the table only that column is read. The list of changed values is distinct and
    broadcast while Spark knows it to be small, and the table's rows are then filtered
    before they are counted. Else the table is dealt by value as counts, one row a value
    and map task, and only values counted more than once meet the list. A value nobody
    changed is not looked at: it was tested when it came. NULLs are not tested; an empty
    change gives an empty result.
    """
    wanted = changed.select(column).dropna().distinct()
    # Spark moves the semi-join below the counts where the list can be broadcast.
    counts = table.select(column).dropna().groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter("n_rows > 1").join(wanted, column, "left_semi")


def check_changed(
    table: DataFrame,
    changed: DataFrame,
    unique: Sequence[str] = (),
    nulls: DataFrame | None = None,
) -> DataFrame:
    """Rows ``(check_name, column_name, failures)`` of an increment.

    ``table`` is the table after the increment, ``changed`` the rows it brought (staged
    or written, they are read once a column), ``nulls`` the rows of
    :func:`observed_failures`.
    """
    results = [] if nulls is None else [nulls]
    for column in unique:
        repeated = repeated_changed_keys(table, changed, column).agg(F.count(F.lit(1)))
        results.append(repeated.select(F.lit("unique"), F.lit(column), "*").toDF(*NAMES))
    if not results:
        raise ValueError("no checks given")
    return reduce(DataFrame.unionByName, results)
