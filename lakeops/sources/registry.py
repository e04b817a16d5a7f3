"""Declared sources and the reads on them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.operators.changes import VERSION
from lakeops.sinks.files import folder_names
from lakeops.sinks.tables import marked_commits


@dataclass(frozen=True)
class SourceSpec:
    """A named source. ``location`` may hold ``{tenant}``."""

    name: str
    location: str
    file_format: str = "parquet"

    def path(self, tenant: str) -> str:
        return self.location.format(tenant=tenant)


def read_source(spark: SparkSession, source: SourceSpec, tenant: str = "default") -> DataFrame:
    return spark.read.format(source.file_format).load(source.path(tenant))


def register_sources(
    spark: SparkSession, sources: Iterable[SourceSpec], tenant: str = "default"
) -> list[str]:
    """Make every declared source a view of its name; returns the names."""
    names = []
    for source in sources:
        read_source(spark, source, tenant).createOrReplaceTempView(source.name)
        names.append(source.name)
    return names


def read_changes(
    changes: DataFrame, start_version: int, end_version: int | None = None
) -> DataFrame:
    """Commits ``start_version`` to ``end_version`` of a change feed, both inclusive.

    On a change log (partitioned by version) other commits are not read at all.
    """
    feed = changes.filter(F.col(VERSION) >= start_version)
    if end_version is not None:
        feed = feed.filter(F.col(VERSION) <= end_version)
    return feed


def commit_versions(spark: SparkSession, log: str) -> list[int]:
    """Complete commits of a change log, oldest first; lists marks, reads no data."""
    return marked_commits(spark, log)


def last_commit(
    spark: SparkSession, log: str, start_version: int, file_format: str = "parquet"
) -> int | None:
    """The newest commit from ``start_version`` on; None if there is none."""
    if file_format == "parquet":
        newest = max(commit_versions(spark, log), default=-1)
        return newest if newest >= start_version else None
    changes = open_changes(spark, log, start_version, None, file_format)
    return changes.agg(F.max(VERSION)).first()[0]


def last_in_sequence(
    spark: SparkSession, log: str, after: int | None, file_format: str = "parquet"
) -> int | None:
    """The newest commit up to which none is missing after ``after``; None if there is none.

    A commit may be complete before an older one is. Those beyond the gap wait for it,
    so a watermark set here passes over nothing. Without ``after`` the log's oldest
    commit is the first.
    """
    if file_format != "parquet":
        return last_commit(spark, log, 0 if after is None else after + 1, file_format)
    known = commit_versions(spark, log)
    reached = after
    for version in known:
        if reached is None or version == reached + 1:
            reached = version
    return None if reached == after else reached


def open_changes(
    spark: SparkSession,
    log: str,
    start_version: int,
    end_version: int | None = None,
    file_format: str = "parquet",
    schema: StructType | None = None,
) -> DataFrame:
    """The change feed at a location: a change log, or a Delta table's own feed.

    Of a change log only the folders of the wanted commits are opened, so listing
    files costs what is new and not what the log holds in all. Columns that later
    commits add are NULL in earlier ones; ``schema`` declares them, without it the
    files' schemas are merged.
    """
    if file_format == "delta":
        reader = (
            spark.read.format("delta")
            .option("readChangeFeed", "true")
            .option("startingVersion", start_version)
        )
        if end_version is not None:
            reader = reader.option("endingVersion", end_version)
        return reader.load(log)
    versions = commit_versions(spark, log)
    if not versions:
        raise FileNotFoundError(f"no commits below {log}")
    # a commit that changed nothing has a mark and no folder
    folders = {int(n.split("=")[1]) for n in folder_names(spark, log) if n.startswith(f"{VERSION}=")}
    stored = [v for v in versions if v in folders]
    wanted = [
        v for v in stored if v >= start_version and (end_version is None or v <= end_version)
    ]
    # with nothing wanted, the newest commit still gives the schema
    paths = [f"{log}/{VERSION}={v}" for v in wanted or stored[-1:]]
    reader = spark.read.option("basePath", log)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")
    changes = reader.parquet(*paths)
    changes = changes.withColumn(VERSION, F.col(VERSION).cast("long"))
    return read_changes(changes, start_version, end_version)
