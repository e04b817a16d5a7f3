"""Table folders with versions, catalog tables, compaction and exports."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.operators.changes import VERSION
from lakeops.operators.merge import without_keys
from lakeops.sinks.files import (
    create_file,
    delete_path,
    file_names,
    folder_names,
    path_bytes,
    path_exists,
    rename_path,
)


# Versioned folders. A Parquet table cannot be overwritten by a query that reads
# it, so each write is a new folder: v=<n> holds the whole table, d=<n> only the
# rows a run changed. A version counts once its job has committed (_SUCCESS); an
# unfinished one is invisible and is written again. Version n is the newest whole
# table up to n with the later changes laid over it by key, so a small change costs
# a small write whatever the size of the table, and `compact` folds the changes.

FULL, CHANGES = "v=", "d="
DELETED = "_deleted"
WRITING = "_writing"


class ConcurrentWriteError(RuntimeError):
    """Another run writes the same table, or one died while it did."""


@contextmanager
def one_writer(spark: SparkSession, root: str) -> Iterator[None]:
    """Hold a table's write mark; a second writer fails instead of taking the same version.

    A run that was killed leaves its mark: :func:`release_writer`, once it is known dead.
    """
    if not create_file(spark, f"{root}/{WRITING}"):
        raise ConcurrentWriteError(f"{root}/{WRITING} exists: another run writes this table")
    try:
        yield
    finally:
        release_writer(spark, root)


def release_writer(spark: SparkSession, root: str) -> None:
    delete_path(spark, f"{root}/{WRITING}")


def _finished(spark: SparkSession, root: str, kind: str) -> list[int]:
    """Finished versions of a kind, oldest first."""
    numbers = sorted(int(n[2:]) for n in folder_names(spark, root) if n.startswith(kind))
    return [n for n in numbers if path_exists(spark, f"{root}/{kind}{n}/_SUCCESS")]


def current_version(spark: SparkSession, root: str) -> int | None:
    return max([*_finished(spark, root, FULL), *_finished(spark, root, CHANGES)], default=None)


def _next(spark: SparkSession, root: str) -> int:
    last = current_version(spark, root)
    return 0 if last is None else last + 1


def write_version(
    df: DataFrame, root: str, keep: int | None = None, partition_by: Sequence[str] = ()
) -> int:
    """Write a whole table as the next version and return its number.

    All versions stay unless ``keep`` asks for only that many, the new one included;
    at least 2 lets a query that has started on the version before run to its end.
    """
    spark = df.sparkSession
    with one_writer(spark, root):
        version = _next(spark, root)
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{root}/{FULL}{version}")
    if keep:
        drop_versions_before(spark, root, version - keep + 1)
    return version


def write_changes(
    rows: DataFrame, root: str, keys: Sequence[str], null_safe: bool = False
) -> int:
    """Write changed rows as the next version of a table and return its number.

    Rows replace those of the same key; all rows of a key within one call stay. Rows
    flagged in ``_deleted`` (optional) only remove. The key travels in the columns'
    metadata. The first version of a table must be whole.
    """
    spark = rows.sparkSession
    if DELETED not in rows.columns:
        rows = rows.withColumn(DELETED, F.lit(False))
    for key in keys:
        rows = rows.withMetadata(key, {"key": True, "null_safe": null_safe})
    with one_writer(spark, root):
        version = _next(spark, root)
        if version == 0:
            raise ValueError(f"{root} has no whole table to lay changes over")
        rows.write.mode("overwrite").parquet(f"{root}/{CHANGES}{version}")
    return version


def changed_rows(
    spark: SparkSession, root: str, after: int, upto: int | None = None
) -> DataFrame | None:
    """Newest change per key of the versions after ``after``; None if one of them is whole.

    Reads the changes' folders only.
    """
    upto = current_version(spark, root) if upto is None else upto
    numbers = [n for n in _finished(spark, root, CHANGES) if after < n <= upto]
    if len(numbers) != upto - after:
        return None
    return _newest_changes(spark, root, numbers) if numbers else None


def _newest_changes(spark: SparkSession, root: str, numbers: Sequence[int]) -> DataFrame:
    paths = [f"{root}/{CHANGES}{n}" for n in numbers]
    schema = spark.read.parquet(paths[-1]).schema
    if len(numbers) == 1:
        return spark.read.schema(schema).parquet(paths[0])
    # Columns that only earlier changes have come after those of the last one.
    merged = spark.read.option("mergeSchema", "true").parquet(*paths).schema
    for field in merged:
        if field.name not in schema.names and field.name != CHANGES[0]:
            schema = StructType([*schema.fields, field])
    rows = spark.read.option("basePath", root).schema(schema).parquet(*paths)
    by_key = Window.partitionBy(*_keys(schema)[0]).orderBy(F.desc(CHANGES[0]))
    # rank, not row_number: a version may hold several rows of a key
    ranked = rows.withColumn("_rank", F.rank().over(by_key)).filter("_rank = 1")
    return ranked.select(*schema.names)


def _keys(schema: StructType) -> tuple[list[str], bool]:
    keyed = [f for f in schema if f.metadata.get("key")]
    return [f.name for f in keyed], any(f.metadata["null_safe"] for f in keyed)


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    if version is None:
        version = current_version(spark, root)
    full = [n for n in _finished(spark, root, FULL) if version is not None and n <= version]
    if not full:
        raise FileNotFoundError(f"no finished version below {root}")
    base = spark.read.parquet(f"{root}/{FULL}{full[-1]}")
    numbers = [n for n in _finished(spark, root, CHANGES) if full[-1] < n <= version]
    if not numbers:
        return base
    changes = _newest_changes(spark, root, numbers)
    keys, null_safe = _keys(changes.schema)
    added = [c for c in changes.columns if c not in base.columns and c != DELETED]
    kept = without_keys(base, changes, keys, null_safe)
    live = changes.filter(~F.col(DELETED)).select(*base.columns, *added)
    return kept.unionByName(live, allowMissingColumns=bool(added))


def drop_versions_before(spark: SparkSession, root: str, version: int) -> None:
    """Delete versions older than ``version``, once no reader uses them.

    Stays are the newest whole table up to ``version`` and what lies over it.
    """
    full = [n for n in _finished(spark, root, FULL) if n <= version]
    first = full[-1] if full else version
    for name in folder_names(spark, root):
        if name[:2] in (FULL, CHANGES) and name[2:].isdigit() and int(name[2:]) < first:
            delete_path(spark, f"{root}/{name}")


# Change log. A commit is a folder _commit_version=<n> and, written last, an empty
# file _commits/<n>: readers see marked commits only, so a commit whose folders
# arrive one by one, or late, is never taken for complete.

MARKS = "_commits"
# Files a task keeps open at once; each may hold a row group in memory.
OPEN_FILES = 8


def append_changes(
    changes: DataFrame,
    log: str,
    replace: bool = False,
    versions: Sequence[int] | None = None,
    spread: bool = True,
) -> None:
    """Write commits to a change log, one folder per ``_commit_version``.

    A commit that is marked already is refused: written in two calls, the second would
    take the place of the first. ``replace`` writes it again, for retries. ``versions``
    names the commits at hand, also one without rows; without it they are looked up
    first, which computes the changes once more. Rows are spread evenly over tasks
    before the write, whatever the share of one commit: a shuffle of all columns.
    Without ``spread`` each task writes the rows it holds, one file a commit, which
    suits few commits that come from a join or a scan of even parts.
    """
    spark = changes.sparkSession
    if versions is None:
        versions = [r[0] for r in changes.select(VERSION).distinct().collect()]
    known = sorted(set(versions) & set(marked_commits(spark, log)))
    if known and not replace:
        raise ValueError(f"commits {known} are in {log} already")
    for version in versions:
        # The mark first; the folder may be a failed attempt's.
        delete_path(spark, f"{log}/{MARKS}/{version}")
        delete_path(spark, f"{log}/{VERSION}={version}")
    rows = changes.hint("rebalance", VERSION) if spread else changes
    with open_files(spark, 0 if spread else OPEN_FILES):
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(VERSION)
            .parquet(log)
        )
    mark_commits(spark, log, versions)


@contextmanager
def open_files(spark: SparkSession, number: int) -> Iterator[None]:
    """Let a task write that many folders at a time instead of sorting its rows by folder.

    Rows of more folders are sorted. With 0 the session's own setting holds.
    """
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    if number:
        spark.conf.set(setting, str(number))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def mark_commits(spark: SparkSession, log: str, versions: Iterable[int]) -> None:
    """Declare commits complete; one without a folder changed nothing."""
    for version in versions:
        create_file(spark, f"{log}/{MARKS}/{version}")


def marked_commits(spark: SparkSession, log: str) -> list[int]:
    names = file_names(spark, f"{log}/{MARKS}")
    return sorted(int(n) for n in names if n.isdigit())


# Compaction


def compact(spark: SparkSession, root: str) -> int:
    """Fold a table's changes into evenly sized files and return the version.

    Changes over a whole table are folded under the same number: the content is the
    same. A whole table is written again as the next version, with its partitioning.
    """
    version = current_version(spark, root)
    full = _finished(spark, root, FULL)
    df = read_version(spark, root, version)
    partitions = partition_columns(spark, f"{root}/{FULL}{full[-1]}")
    target = version + 1 if full[-1] == version else version
    with one_writer(spark, root):
        rows = df.hint("rebalance", *partitions)
        rows.write.mode("overwrite").partitionBy(*partitions).parquet(f"{root}/{FULL}{target}")
    return target


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns a folder is partitioned by, from its folder names."""
    names = [n for n in folder_names(spark, path) if "=" in n]
    if not names:
        return []
    return [names[0].split("=")[0], *partition_columns(spark, f"{path}/{names[0]}")]


# Catalog


def table_exists(spark: SparkSession, table: str) -> bool:
    """Whether a catalog table or a path (one with a slash) exists.

    Other failures, such as missing rights, are raised: taking them for a first
    load would overwrite the table.
    """
    if "/" in table:
        return path_exists(spark, table)
    return spark.catalog.tableExists(table)


def register_table(
    spark: SparkSession, table: str, location: str, file_format: str = "parquet"
) -> None:
    """Make the files at a location a catalog table; its database is created too."""
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING {file_format} LOCATION '{location}'")


def point_table(spark: SparkSession, table: str, location: str) -> None:
    """Move a catalog table to another location, such as a new version."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def drop_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def table_property(spark: SparkSession, table: str, key: str, default: str = "false") -> str:
    """A table property, or the default when the table does not set it."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == key).collect()
    return rows[0]["value"] if rows else default


def write_table(df: DataFrame, table: str, properties: Mapping[str, str] | None = None) -> None:
    """Full rebuild of a catalog table."""
    df.write.mode("overwrite").saveAsTable(table)
    if properties:
        pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        df.sparkSession.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def write_bucketed(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    buckets: int,
    sort_by: Sequence[str] = (),
    location: str | None = None,
) -> None:
    """Full rebuild of a table bucketed by key, so later joins on it skip a shuffle.

    The repartition lines tasks up with buckets: one file per bucket instead of one
    per task and bucket. Keys are expected to be those of a keyed table (unique).
    """
    writer = (
        df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys)
    )
    if sort_by:
        writer = writer.sortBy(*sort_by)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def merge_into(source: DataFrame, table: str, keys: Sequence[str]) -> None:
    """MERGE for tables whose format can (Delta, Iceberg); file tables refuse it.

    For those use ``upsert`` and ``write_version``.
    """
    match = " AND ".join(f"{table}.{k} <=> source.{k}" for k in keys)
    (
        source.alias("source")
        .mergeInto(table, F.expr(match))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


# Export


def export_parquet(df: DataFrame, path: str, single_file: bool = False) -> int:
    """Write an extract to ``path`` and return its size in bytes.

    It takes the place of the extract before only once it is complete. ``single_file``
    gives the one file that a consumer of small extracts expects; all rows then pass
    through one task, which is the caller's choice and does not depend on the size.
    """
    spark = df.sparkSession
    new, old = f"{path}.new", f"{path}.old"
    rows = df.coalesce(1) if single_file else df.hint("rebalance")
    rows.write.mode("overwrite").parquet(new)
    delete_path(spark, old)
    if path_exists(spark, path):
        rename_path(spark, path, old)
    rename_path(spark, new, path)
    delete_path(spark, old)
    return path_bytes(spark, path)


def read_export(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
