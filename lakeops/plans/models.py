"""Gold models: full and incremental results of a ModelSpec."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.columns import default_code, stamp_column
from lakeops.operators.changes import (
    CHANGE_TYPE,
    COMMIT_TIME,
    PREIMAGE,
    VERSION,
    upserts_only,
)
from lakeops.operators.latest import latest_by_key
from lakeops.plans.specs import STAMP, ModelSpec


def with_key(spec: ModelSpec, df: DataFrame) -> DataFrame:
    """Drop rows without a key, for models that require one."""
    if spec.require_key:
        for key in spec.source_keys:
            df = df.filter(F.col(key).isNotNull())
    return df


def project(
    spec: ModelSpec, df: DataFrame, stamp: Column, extra: Sequence[str] = ()
) -> DataFrame:
    """Rename to gold columns and add the stamp, and columns kept under their name."""

    def gold(name: str, silver: str) -> Column:
        column = F.col(silver)
        return (default_code(column) if name in spec.undefined else column).alias(name)

    return df.select(*[gold(n, s) for n, s in spec.columns.items()], stamp.alias(STAMP), *extra)


def gold_full(
    spec: ModelSpec, silver: DataFrame, run_ts: Column | datetime | None = None
) -> DataFrame:
    """Full load of a model from its source table, stamped with the run time.

    Rows are not reduced to one per key, only made distinct where the model says
    so; ``gold_increment`` from version 0 gives one row per key.
    """
    gold = project(spec, with_key(spec, silver), stamp_column(run_ts))
    return gold.distinct() if spec.distinct_full else gold


def newest_changes(
    spec: ModelSpec, changes: DataFrame, tiebreak: Sequence[str], deletes: bool = False
) -> DataFrame:
    """Newest change per model key, with only the columns the model needs.

    With ``deletes`` a delete counts as a change too, so a key may come back as
    deleted; without, deletes are not looked at.
    """
    kept = (
        changes.filter(F.col(CHANGE_TYPE) != PREIMAGE) if deletes else upserts_only(changes)
    )
    needed = [*spec.source_columns, *tiebreak, CHANGE_TYPE, VERSION, COMMIT_TIME]
    kept = with_key(spec, kept).select(*dict.fromkeys(needed))
    return latest_by_key(kept, spec.source_keys, VERSION, tiebreak)


def project_changes(
    spec: ModelSpec,
    newest: DataFrame,
    stamp: Column | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Gold rows of changes, stamped with their commit time.

    Another stamp takes the commit time's type, so that first loads and later
    increments can be merged. ``extra`` columns are kept under their name.
    """
    time = F.col(COMMIT_TIME)
    if stamp is not None:
        time = stamp.cast(newest.schema[COMMIT_TIME].dataType)
    return project(spec, newest, time, [*([VERSION] if spec.keep_version else []), *extra])


def gold_increment(
    spec: ModelSpec,
    changes: DataFrame,
    tiebreak: Sequence[str],
    stamp: Column | None = None,
) -> DataFrame:
    """One row per key from a change feed, stamped with its commit time."""
    return project_changes(spec, newest_changes(spec, changes, tiebreak), stamp)
