"""Intermediate results written once to shared storage."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeops.sinks.files import delete_at_end, delete_path, path_exists


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only a local-mode session falls back to a folder in the warehouse: elsewhere
    someone must name a folder that outlives a machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def application_folder(spark: SparkSession) -> str:
    """This application's own folder for intermediate tables.

    Results are lazy and may read a staged table long after the call that wrote it, so
    what no ``with`` block clears stays until the application ends, which drops the
    folder. A killed application leaves one folder named after it.
    """
    folder = f"{shared_folder(spark)}/staging-{spark.sparkContext.applicationId}"
    if not path_exists(spark, folder):
        delete_at_end(spark, folder)
    return folder


def count_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` and the row count that its next action will have seen (``["rows"]``)."""
    counted = Observation(f"{name}-{uuid.uuid4().hex}")
    return df.observe(counted, F.count(F.lit(1)).alias("rows")), counted


class Staging:
    """A run's own folder for intermediate tables.

    Writing a result that is used twice cuts its lineage with a copy that outlives
    lost executors, and reading it back gives Spark its exact size, on which the
    choice of a broadcast join then rests. As a context manager it drops its folder
    at the end, also after a failure.
    """

    def __init__(self, spark: SparkSession, run_id: str | None = None):
        self.spark = spark
        self.path = f"{application_folder(spark)}/{run_id or uuid.uuid4().hex}"
        self.rows: dict[str, int] = {}
        self._written = 0

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        self.clear()

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return a scan of it; its row count lands in ``rows``.

        Every call has a folder of its own, so a name used again does not replace
        what an earlier result still reads.
        """
        path = f"{self.path}/{self._written}-{name}"
        self._written += 1
        observed, counted = count_rows(df, name)
        observed.write.mode("overwrite").parquet(path)
        self.rows[name] = counted.get["rows"]
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Drop the run's folder once its results are in place."""
        delete_path(self.spark, self.path)
