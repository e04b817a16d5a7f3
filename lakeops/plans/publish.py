"""Publishing increments of gold tables to keyed target tables."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from string import Template

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lakeops.functions.types import cast_columns, check_lengths, declared_schema
from lakeops.operators.history import history_capture
from lakeops.operators.latest import latest_by_key
from lakeops.operators.merge import publish_with_deletes
from lakeops.plans.specs import PublishSpec
from lakeops.sinks.staging import Staging
from lakeops.sinks.tables import (
    DELETED,
    changed_rows,
    current_version,
    read_version,
    write_changes,
    write_version,
)

# Fixed value: where an empty target starts. A target published by commit version
# starts before version 0.
FIRST_STAMP = "1900-01-01"
FIRST_VERSION = -1
# The folder below a target that holds the gold version it was published up to.
PROGRESS = "published"


def load_publish_config(
    text: str, environment: Mapping[str, str] | None = None
) -> list[tuple[PublishSpec, str]]:
    """Publish specs and their gold paths from a JSON config.

    ``tables`` lists name, gold_path, redshift_table, primary_keys,
    incremental_column, columns and, if wanted, redshift_schema. ``${VAR}`` is replaced from the environment;
    a name that is not there stays as it is.
    """
    filled = Template(text).safe_substitute(os.environ if environment is None else environment)
    return [
        (
            PublishSpec(
                table["name"],
                table["redshift_table"],
                tuple(table["primary_keys"]),
                table["columns"],
                table["incremental_column"],
                schema=table.get("redshift_schema", ""),
            ),
            table["gold_path"],
        )
        for table in json.loads(filled)["tables"]
    ]


def target_high_water(
    target: DataFrame, column: str, default: str | int | None = None
) -> DataFrame:
    """One row with the target's highest stamp (or version), or the default if empty."""
    dtype = target.schema[column].dataType
    if default is None:
        default = FIRST_VERSION if isinstance(dtype, NumericType) else FIRST_STAMP
    return target.agg(F.coalesce(F.max(column), F.lit(default).cast(dtype)).alias(column))


def incremental_since(
    df: DataFrame, column: str, since: Column | object, inclusive: bool = False
) -> DataFrame:
    """Rows stamped after ``since``.

    Rows that share the last stamp but arrived later are skipped by the strict
    comparison; ``inclusive`` reads them again, which is safe with an upsert.
    """
    since = since if isinstance(since, Column) else F.lit(since)
    stamp = F.col(column)
    return df.filter(stamp >= since if inclusive else stamp > since)


@dataclass(frozen=True)
class Published:
    """Outcome of one table: rows staged, and the error that stopped it, if any."""

    name: str
    rows: int
    status: str
    error: str | None = None


def publish(
    spark: SparkSession,
    spec: PublishSpec,
    gold: DataFrame,
    target_root: str,
    inclusive: bool = False,
    on_error: str = "raise",
    lengths: bool = False,
) -> Published:
    """Publish one table by its increment column: casts, staging, next version's changes.

    ``lengths`` makes a value longer than its declared VARCHAR fail the job. A first publish takes every row. Later ones take rows stamped after the target's
    newest and rows without a stamp, whose time is not known, each time. Stamps come
    from two clocks (run time of a full load, commit time of an increment) and so may
    skip rows: where gold is a folder of versions, :func:`publish_versions` does not.
    """
    first = current_version(spark, target_root) is None
    target = open_target(spark, spec, target_root)
    increment = gold
    if not first:
        since = target_high_water(target, spec.increment).first()[0]
        later = incremental_since(gold, spec.increment, since, inclusive)
        increment = later.unionByName(gold.filter(F.col(spec.increment).isNull()))
    rows = _write_published(spark, spec, increment, target_root, first, on_error, lengths)
    return Published(spec.name, rows, "published" if rows else "nothing new")


def _write_published(
    spark: SparkSession,
    spec: PublishSpec,
    rows: DataFrame,
    target_root: str,
    whole: bool,
    on_error: str,
    lengths: bool,
) -> int:
    """Write typed rows as a whole table or as changes; no version if there are none."""
    deleted = [DELETED] if DELETED in rows.columns else []
    declared = {**spec.columns, **dict.fromkeys(deleted, "BOOLEAN")}
    typed = cast_columns(rows, declared, on_error)
    if lengths:
        typed = check_lengths(typed, spec.columns)
    with Staging(spark) as staging:
        staged = staging(typed, spec.table)
        count = staging.rows[spec.table]
        if count and whole:
            write_version(staged, target_root)
        elif count:
            write_changes(staged, target_root, spec.keys, spec.null_safe)
    return count


def publish_versions(
    spark: SparkSession,
    spec: PublishSpec,
    gold_root: str,
    target_root: str,
    on_error: str = "raise",
    lengths: bool = True,
) -> Published:
    """Publish what gold's versions changed since the last publish, deletes included.

    No stamp decides, so nothing is skipped, and only the changed rows are read and
    written. The gold version reached is stored beside the target, after it: a run that
    fails between the two is repeated, with the same result. If gold was written whole
    in between, the target is too.
    """
    upto = current_version(spark, gold_root)
    if upto is None:
        return Published(spec.name, 0, "nothing new")
    progress = f"{target_root}/{PROGRESS}"
    stored = current_version(spark, progress)
    after = None if stored is None else read_version(spark, progress).first()[0]
    if after == upto:
        return Published(spec.name, 0, "nothing new")
    changes = None if after is None else changed_rows(spark, gold_root, after, upto)
    whole = changes is None
    rows = read_version(spark, gold_root, upto) if whole else changes
    count = _write_published(spark, spec, rows, target_root, whole, on_error, lengths)
    reached = spark.range(1).select(F.lit(upto).cast("long").alias("gold_version"))
    write_version(reached, progress)
    return Published(spec.name, count, "published" if count else "nothing new")


def publish_all(
    spark: SparkSession,
    jobs: Iterable[tuple[PublishSpec, DataFrame | str, str]],
    inclusive: bool = False,
    lengths: bool = False,
) -> list[Published]:
    """Publish table after table; a table that fails does not stop the others.

    Gold is a folder of versions (:func:`publish_versions`) or a DataFrame
    (:func:`publish`).
    """
    results = []
    for spec, gold, target_root in jobs:
        try:
            if isinstance(gold, str):
                results.append(publish_versions(spark, spec, gold, target_root, lengths=lengths))
            else:
                results.append(publish(spark, spec, gold, target_root, inclusive, lengths=lengths))
        except Exception as error:  # noqa: BLE001 - reported per table
            results.append(Published(spec.name, 0, "failed", str(error)))
    return results


def publish_config(
    spark: SparkSession,
    text: str,
    published_root: str,
    environment: Mapping[str, str] | None = None,
) -> list[Published]:
    """Publish all tables of a JSON config: ``<published_root>/<schema>/<table>``.

    A gold path with versions is published by version, any other Parquet folder by its
    increment column; declared lengths are checked. A path that cannot be read fails
    its own table only.
    """
    results = []
    for spec, path in load_publish_config(text, environment):
        target = "/".join(filter(None, (published_root, spec.schema, spec.table)))
        try:
            versioned = current_version(spark, path) is not None
            gold = path if versioned else spark.read.parquet(path)
        except Exception as error:  # noqa: BLE001 - reported per table
            results.append(Published(spec.name, 0, "failed", str(error)))
            continue
        results += publish_all(spark, [(spec, gold, target)], lengths=True)
    return results


def publish_with_history(
    spark: SparkSession,
    spec: PublishSpec,
    gold: DataFrame,
    target_root: str,
    history_root: str,
    tiebreak: Sequence[str],
    flag: str = "is_deleted",
) -> Published:
    """Publish with tombstones, archiving the rows that are replaced or deleted.

    ``gold`` carries the flag; a NULL flag counts as not deleted, and the newest
    row of a key counts where it has several. Keys must not be NULL: such a row fails
    the job. The archive is one folder per target version, written first: a rerun after
    a failure writes the same folder again. A first publish takes every row, a later
    one those stamped after the target's newest and those without a stamp.
    """
    first = current_version(spark, target_root) is None
    target = open_target(spark, spec, target_root)
    increment = gold
    if not first:
        since = target_high_water(target, spec.increment).first()[0]
        later = incremental_since(gold, spec.increment, since)
        increment = later.unionByName(gold.filter(F.col(spec.increment).isNull()))
    declared = {**spec.columns, flag: "BOOLEAN"}
    typed = cast_columns(increment, declared).withColumn(flag, F.coalesce(flag, F.lit(False)))
    typed = check_lengths(typed, spec.columns)
    for key in spec.keys:
        missing = F.raise_error(F.lit(f"{spec.table}: key {key} is NULL"))
        typed = typed.withColumn(key, F.coalesce(key, missing.cast(typed.schema[key].dataType)))
    typed = latest_by_key(typed, spec.keys, spec.increment, tiebreak)
    with Staging(spark) as staging:
        staged = staging(typed, spec.table)
        rows = staging.rows[spec.table]
        if rows:
            version = 0 if first else current_version(spark, target_root) + 1
            archived = history_capture(target, staged, spec.keys, spec.increment, flag)
            archived.write.mode("overwrite").parquet(f"{history_root}/target_version={version}")
            if first:
                write_version(publish_with_deletes(target, staged, spec.keys, flag), target_root)
            else:
                changes = staged.withColumnRenamed(flag, DELETED)
                write_changes(changes, target_root, spec.keys)
    return Published(spec.name, rows, "published" if rows else "nothing new")


def open_target(spark: SparkSession, spec: PublishSpec, root: str) -> DataFrame:
    """The published table, empty with its declared columns before the first run."""
    if current_version(spark, root) is None:
        return spark.createDataFrame([], declared_schema(spec.columns))
    return read_version(spark, root)
