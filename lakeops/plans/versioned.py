"""Versioned (type-2) gold tables on storage."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.columns import stamp_column
from lakeops.operators.changes import as_first_load
from lakeops.operators.scd2 import (
    ACTIVE,
    active_export,
    snapshot_changes,
    split_changes,
    version_feed,
)
from lakeops.sinks.files import folder_names, path_exists
from lakeops.sinks.staging import Staging
from lakeops.sinks.tables import (
    append_changes,
    current_version,
    export_parquet,
    read_version,
    write_version,
)


# Below the table's root, ended rows are kept apart: ended/c=<version> holds the rows
# that a version ended and is never written again; v=<version> holds the active ones.
ENDED = "ended"


def read_versioned(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A versioned table; a filter on ``ativo`` reads only that part of the files."""
    version = current_version(spark, root) if version is None else version
    active = read_version(spark, root, version).withColumn(ACTIVE, F.col(ACTIVE).cast("boolean"))
    names = folder_names(spark, f"{root}/{ENDED}")
    parts = [n for n in names if path_exists(spark, f"{root}/{ENDED}/{n}/_SUCCESS")]
    paths = [f"{root}/{ENDED}/{n}" for n in parts if int(n[2:]) <= version]
    if not paths:
        return active
    ended = spark.read.schema(active.schema).parquet(*sorted(paths))
    return active.unionByName(ended)


def save_versioned(
    spark: SparkSession,
    current: DataFrame,
    root: str,
    run_ts: Column | datetime | None = None,
    change_log: str | None = None,
) -> int:
    """Bring a versioned table up to ``current`` and return its new version.

    The first load stores the rows as they are; later loads replace the active part
    and add a folder with the rows they end, so rows ended earlier are neither read
    nor written. ``change_log`` gets each version as the commit of its number, written
    before the version counts: a rerun after a failure writes the same commit again.
    """
    last = current_version(spark, root)
    version = 0 if last is None else last + 1
    if last is None:
        rows = current.filter(ACTIVE)
        ended = current.filter(~F.coalesce(F.col(ACTIVE), F.lit(False)))
        feed = as_first_load(current, stamp_column(run_ts))
        _store(ended, rows, feed, root, version, change_log)
        return version
    with Staging(spark) as staging:
        # Active rows only: an ended row is as it was.
        history = read_version(spark, root).withColumn(ACTIVE, F.col(ACTIVE).cast("boolean"))
        changes = staging(snapshot_changes(history, current), "changes")
        ended, rows = split_changes(history, changes, run_ts)
        feed = version_feed(history, changes, version, run_ts)
        _store(ended, rows, feed, root, version, change_log)
    return version


def _store(
    ended: DataFrame,
    active: DataFrame,
    feed: DataFrame,
    root: str,
    version: int,
    change_log: str | None,
) -> None:
    if change_log:
        append_changes(feed, change_log, replace=True, versions=[version])
    ended.write.mode("overwrite").parquet(f"{root}/{ENDED}/c={version}")
    write_version(active.hint("rebalance"), root, partition_by=[ACTIVE])


def export_active(
    spark: SparkSession,
    root: str,
    folder: str,
    name: str | None = None,
    single_file: bool = False,
) -> str | None:
    """Export a table's active rows to ``folder/name`` and return that path.

    The name is the table's own in lower case unless given; None is returned if
    the table does not exist.
    """
    if current_version(spark, root) is None:
        return None
    path = f"{folder}/{name or root.rstrip('/').rsplit('/', 1)[-1].lower()}"
    export_parquet(active_export(read_versioned(spark, root)), path, single_file)
    return path
