"""The size of the batches that tasks exchange with their Python workers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
RECORDS = 1000


@contextmanager
def small_batches(spark: SparkSession, records: int = RECORDS) -> Iterator[None]:
    """Jobs started within send at most ``records`` rows at once.

    Whole texts make large rows: a batch is held several times over, by the task and by
    its worker. Fewer rows bound that; a smaller setting of the session's stays.
    """
    before = spark.conf.get(SETTING)
    if 0 < int(before) <= records:
        yield
        return
    spark.conf.set(SETTING, str(records))
    try:
        yield
    finally:
        spark.conf.set(SETTING, before)
