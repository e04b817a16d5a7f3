"""Places of rows in an order that no single task sees whole."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.sinks.staging import Staging


def numbered(
    rows: DataFrame, order: Sequence[Column], stage: Staging, group: Sequence[str] = (), name: str = "order"
) -> DataFrame:
    """``rows`` with ``place``, the number (from 0) of each in its group by ``order``.

    Rows are dealt to ranges of (group, order), numbered within their range, and the
    rows of earlier ranges added from a table of one row a range and group, so a group
    with most rows is spread over ranges. ``order`` must tell rows apart, or rows that
    tie must be alike; null group values are one group. ``rows`` should be a staged,
    narrow table without columns ``part``, ``place`` and ``earlier``.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in group]
    ranged = rows.repartitionByRange(parts, *keys, *order).withColumn("part", F.spark_partition_id())
    ranged = stage(ranged, name)
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("part", *group).agg(F.count("*").alias("own"))
    sizes = sizes.select("part", *group, F.coalesce(F.sum("own").over(before), F.lit(0)).alias("earlier"))
    inside = F.row_number().over(Window.partitionBy("part", *group).orderBy(*order)) - 1
    ranged, sizes = ranged.withColumn("inside", inside).alias("r"), sizes.alias("s")
    match = reduce(and_, [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in group], F.col("r.part") == F.col("s.part"))
    return ranged.join(sizes, match).select(
        *(f"r.{c}" for c in rows.columns), (F.col("inside") + F.col("earlier")).cast("long").alias("place")
    )
