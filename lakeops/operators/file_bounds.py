"""Row counts and bounds of columns from the footers of Parquet files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType

# Read by the source that takes aggregates into the scan.
PUSHED = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}

# What Spark says of a footer without bounds.
NO_BOUNDS = "No min/max found"


def _bounds(columns: Sequence[str]) -> list[Column]:
    """n_rows, and per column the rows with a value, the least and the greatest one."""
    out = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        out += [F.count(c).alias(f"n_{c}"), F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return out


def pushed_bounds(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The bounds by footers alone, planned in a session of its own with that source.

    It fails at run time on a file without a value in a column: its footer has no bounds.
    """
    session = spark.newSession()
    for key, value in PUSHED.items():
        session.conf.set(key, value)
    return session.read.parquet(path).agg(*_bounds(columns))


def file_bounds(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row: n_rows and, per column, n_ (rows with a value), min_ and max_.

    For whole numbers and dates it comes from the footers, which tasks read, however
    large the files are. The columns are scanned, and nothing else, where a file has no
    value in one of them, and for other types: footers have no bounds of timestamps that
    Spark trusts, leave NaN out and cut long texts. An empty table has counts of 0 and
    NULL bounds. The row passes through the driver.
    """
    scanned = spark.read.parquet(path).agg(*_bounds(columns))
    types = [scanned.schema[f"min_{c}"].dataType for c in columns]
    if not all(isinstance(t, IntegralType | DateType) for t in types):
        return scanned
    try:
        row = pushed_bounds(spark, path, columns).first()
    except Exception as error:
        if NO_BOUNDS not in str(error):
            raise
        return scanned
    # Files without any row have no footers to count by.
    return scanned if row["n_rows"] is None else spark.createDataFrame([row], scanned.schema)
