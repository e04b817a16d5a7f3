"""The version watermark: one row per source, the last commit processed."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.columns import stamp_column
from lakeops.operators.changes import VERSION

TABLE, LAST, UPDATED = "table_name", "last_processed_version", "updated_at"


def watermark_seed(
    spark: SparkSession, sources: Sequence[str], run_ts: Column | datetime | None = None
) -> DataFrame:
    """Version 0 for every source."""
    stamp = stamp_column(run_ts)
    rows = [
        spark.range(1).select(
            F.lit(name).alias(TABLE), F.lit(0).cast("long").alias(LAST), stamp.alias(UPDATED)
        )
        for name in sources
    ]
    return reduce(DataFrame.unionByName, rows)


def watermark_lookup(control: DataFrame, source: str) -> DataFrame:
    """One row with a source's last processed version, 0 if it has none."""
    return control.filter(F.col(TABLE) == source).agg(
        F.coalesce(F.max(LAST), F.lit(0)).alias(LAST)
    )


def processed_version(source: str, changes: DataFrame) -> DataFrame:
    """The highest version of a feed, as a watermark row of its source."""
    return changes.agg(F.max(VERSION).alias(LAST)).select(F.lit(source).alias(TABLE), LAST)


def watermark_advance(
    control: DataFrame, processed: DataFrame, run_ts: Column | datetime | None = None
) -> DataFrame:
    """Watermarks raised to the processed versions; they never go back.

    A source whose version does not rise keeps its row and its time.
    """
    processed = processed.filter(F.col(LAST).isNotNull())
    highest = processed.groupBy(TABLE).agg(F.max(LAST).alias("_new"))
    joined = control.join(highest, TABLE, "full")
    raised = F.col(LAST).isNull() | (F.col("_new") > F.col(LAST))
    updated = stamp_column(run_ts).cast(control.schema[UPDATED].dataType)
    return joined.select(
        TABLE,
        F.greatest(LAST, "_new").alias(LAST),
        F.when(raised, updated).otherwise(F.col(UPDATED)).alias(UPDATED),
    )


def start_version(last: int) -> int:
    """Where a run starts after a looked-up watermark.

    The lookup shows 0 for "nothing processed yet" too, so commit 0 is read again. A
    stored table tells the two apart: :func:`processed_upto`.
    """
    return last + 1 if last > 0 else 0


def since_watermark(changes: DataFrame, control: DataFrame, source: str) -> DataFrame:
    """Changes after a source's watermark, which is looked up by the same job.

    The watermark is a scalar subquery: nothing is fetched to plan the run, and on a
    change log partitioned by version Spark prunes the folders once it has the value.
    As in :func:`start_version`, 0 and no watermark start at commit 0.
    """
    last = watermark_lookup(control, source).scalar()
    return changes.filter(F.col(VERSION) >= F.when(last > 0, last + 1).otherwise(0))


def processed_upto(control: DataFrame, source: str) -> int | None:
    """The last commit processed of a source; None, not 0, if it has no watermark."""
    return control.filter(F.col(TABLE) == source).agg(F.max(LAST)).first()[0]


def empty_control(spark: SparkSession) -> DataFrame:
    """The table before any source is processed."""
    return watermark_seed(spark, ["-"], None).limit(0)
