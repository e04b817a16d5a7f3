"""The incremental run: change feeds to gold tables, from stored versions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.columns import stamp_column
from lakeops.operators.changes import CHANGE_TYPE, DELETE, VERSION, as_first_load
from lakeops.operators.changed_checks import check_changed, observe_nulls, observed_failures
from lakeops.operators.latest import latest_by_key
from lakeops.operators.quality import check_model
from lakeops.plans.control import (
    LAST,
    TABLE,
    empty_control,
    processed_upto,
    watermark_advance,
)
from lakeops.plans.models import newest_changes, project_changes, with_key
from lakeops.plans.specs import MODELS, ModelSpec
from lakeops.sinks.staging import count_rows
from lakeops.sinks.tables import (
    DELETED,
    changed_rows,
    current_version,
    read_version,
    write_changes,
    write_version,
)
from lakeops.sources.registry import last_in_sequence, open_changes


@dataclass(frozen=True)
class Feed:
    """Where a source's change log is, and what breaks ties within a commit.

    ``table`` is a folder with the source's rows as commit ``table_commit`` left them.
    A model's first load then reads it and goes on after that commit: deleted rows are
    gone from it, and the log need not reach back to its beginning. Without it a first
    load replays the log, from ``first_commit`` on where that is declared: a first run
    then waits for that commit, however late it arrives.
    """

    log: str
    tiebreak: tuple[str, ...]
    file_format: str = "parquet"
    table: str | None = None
    table_commit: int | None = None
    first_commit: int | None = None
    table_format: str = "parquet"


@dataclass(frozen=True)
class ModelRun:
    """Outcome of one model: rows merged, version written, failed checks."""

    name: str
    mode: str
    rows: int
    version: int
    failures: dict[str, int]


def first_load(
    spec: ModelSpec,
    silver: DataFrame,
    tiebreak: Sequence[str],
    run_ts: Column | datetime | None = None,
    commit: int = 0,
) -> DataFrame:
    """A model's rows from its source table: one per key, stamped with the run time."""
    known = with_key(spec, as_first_load(silver, stamp_column(run_ts), commit))
    newest = latest_by_key(known, spec.source_keys, VERSION, tiebreak)
    return project_changes(spec, newest, stamp_column(run_ts))


def run_model(
    spark: SparkSession,
    spec: ModelSpec,
    changes: DataFrame,
    tiebreak: Sequence[str],
    gold_root: str,
    run_ts: Column | datetime | None = None,
    apply_deletes: bool = False,
    checks: bool = True,
    silver: DataFrame | None = None,
    silver_commit: int = 0,
) -> ModelRun:
    """Bring a model's gold table up to its source and check the result.

    A table that does not exist yet is a first load, stamped with the run time: of
    ``silver``, the source as commit ``silver_commit`` left it, or else of the changes.
    Later the newest change per key is written as the next version's changes. The
    table before is not read, let alone rewritten; deleted keys go along as such.
    """
    first = current_version(spark, gold_root) is None
    live = F.col(CHANGE_TYPE) != DELETE
    if first:
        if silver is not None:
            rows = first_load(spec, silver, tiebreak, run_ts, silver_commit)
        else:
            newest = newest_changes(spec, changes, tiebreak, deletes=apply_deletes)
            rows = project_changes(spec, newest.filter(live), stamp_column(run_ts))
        gold, counted = count_rows(rows, spec.name)
        version = write_version(gold, gold_root)
    else:
        newest = newest_changes(spec, changes, tiebreak, deletes=apply_deletes)
        marked = newest.withColumn(DELETED, ~live)
        rows = project_changes(spec, marked, extra=[DELETED])
        gold, counted = observe_nulls(rows, spec.not_null if checks else (), ~F.col(DELETED))
        version = write_changes(gold, gold_root, spec.keys, null_safe=not spec.require_key)
    failures = {}
    if checks and (spec.not_null or spec.unique):
        table = read_version(spark, gold_root, version)
        if first:
            results = check_model(table, spec.not_null, spec.unique)
        else:
            # What the run did not change was tested when it came.
            written = changed_rows(spark, gold_root, version - 1, version).filter(~F.col(DELETED))
            nulls = observed_failures(written, counted, spec.not_null) if spec.not_null else None
            results = check_changed(table, written, spec.unique, nulls)
        failures = {
            f"{row.check_name}:{row.column_name}": row.failures
            for row in results.filter("failures > 0").collect()
        }
    mode = "full" if first else "incremental"
    return ModelRun(spec.name, mode, counted.get["rows"], version, failures)


def run_pipeline(
    spark: SparkSession,
    feeds: Mapping[str, Feed],
    root: str,
    tenant: str = "default",
    models: Sequence[ModelSpec] = tuple(MODELS.values()),
    run_ts: Column | datetime | None = None,
    apply_deletes: bool = False,
    checks: bool = True,
) -> list[ModelRun]:
    """Run the models of every feed and then move the feed's watermark.

    Models of one source read its log independently: each reads only its own few
    columns of the new commits, which costs less than keeping full-width rows in a
    cache. The watermark moves once all models of the source are written, so a
    failed run is repeated from the same version; upserts make that safe. It moves
    over complete commits without a gap, so a commit that arrives late is still read.
    All versions of all tables stay; ``drop_versions_before`` deletes on request.
    """
    base = f"{root}/{tenant}"
    control_root = f"{base}/control"
    results = []
    for source, feed in feeds.items():
        mine = [m for m in models if m.source == source]
        stored = current_version(spark, control_root) is not None
        control = read_version(spark, control_root) if stored else empty_control(spark)
        last = processed_upto(control, source)
        if last is None:
            last = feed.table_commit
        if last is None and feed.first_commit is not None:
            last = feed.first_commit - 1
        newest = last_in_sequence(spark, feed.log, last, feed.file_format)
        reached = last if newest is None else newest
        done = 0
        for spec in mine:
            gold_root = f"{base}/gold/{spec.name}"
            exists = current_version(spark, gold_root) is not None
            steps = []
            if not exists and feed.table is not None:
                silver = spark.read.format(feed.table_format).load(feed.table)
                steps.append((None, silver))
                start = (feed.table_commit or 0) + 1
            elif exists:
                start = 0 if last is None else last + 1
            else:
                start = 0
            if reached is not None and start <= reached:
                changes = open_changes(spark, feed.log, start, reached, feed.file_format)
                steps.append((changes, None))
            for changes, silver in steps:
                results.append(
                    run_model(
                        spark,
                        spec,
                        changes,
                        feed.tiebreak,
                        gold_root,
                        run_ts,
                        apply_deletes,
                        checks,
                        silver,
                        feed.table_commit or 0,
                    )
                )
                done += 1
        if done and reached is not None:
            row = spark.range(1).select(
                F.lit(source).alias(TABLE), F.lit(reached).cast("long").alias(LAST)
            )
            write_version(watermark_advance(control, row, run_ts), control_root)
    return results
