"""Type-2 history: hash_value, data_inicio (start), data_fim (end), ativo (active)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.columns import match_keys, stamp_column
from lakeops.operators.changes import (
    CHANGE_TYPE,
    COMMIT_TIME,
    INSERT,
    POSTIMAGE,
    PREIMAGE,
    VERSION,
)
from lakeops.operators.difference import LEFT, RIGHT, two_way_difference

# The bookkeeping columns of a versioned table.
HASH = "hash_value"
START = "data_inicio"
END = "data_fim"
ACTIVE = "ativo"
STATUS = (START, END, ACTIVE)


def drop_status(df: DataFrame) -> DataFrame:
    return df.drop(*STATUS)


def active_rows(df: DataFrame) -> DataFrame:
    """Active rows of a versioned table; all rows of a table without versions."""
    return df.filter(F.col(ACTIVE)) if ACTIVE in df.columns else df


def active_export(df: DataFrame) -> DataFrame:
    """Active rows without bookkeeping columns."""
    return active_rows(df).drop(*STATUS, HASH)


def snapshot_changes(history: DataFrame, current: DataFrame) -> DataFrame:
    """Rows that left (``_side`` 1) or joined (``_side`` 2) the active set.

    Joined rows carry the start and end of their own status; ``_live`` tells if
    that status is active. The latest start and end are taken where ``current``
    repeats a row, so a repeated row is added once.
    """
    live = F.when((F.col("_side") == RIGHT) & F.col(ACTIVE), F.lit(True))
    columns = [c for c in history.columns if c not in STATUS]
    unknown = sorted(set(current.columns) - set(history.columns) - set(STATUS))
    if unknown:
        raise ValueError(f"the table's history has no columns {unknown}")
    return two_way_difference(
        active_rows(history).select(*columns),
        current,
        carry={
            START: F.max(F.when(live, F.col(START))),
            END: F.max(F.when(live, F.col(END))),
            "_live": F.max(live),
        },
    )


def snapshot_inserts(history: DataFrame, current: DataFrame) -> DataFrame:
    joined = snapshot_changes(history, current).filter(F.col("_side") == RIGHT)
    return joined.drop("_side", "_live", START, END)


def snapshot_deletes(history: DataFrame, current: DataFrame) -> DataFrame:
    left = snapshot_changes(history, current).filter(F.col("_side") == LEFT)
    return left.drop("_side", "_live", START, END)


def change_counts(history: DataFrame, current: DataFrame) -> DataFrame:
    """Rows active before, rows now, rows inserted and deleted, in one pass.

    The difference carries how often each distinct row was seen, so the totals
    need no scans of their own.
    """
    columns = [c for c in history.columns if c not in STATUS]
    tagged = (
        active_rows(history)
        .select(*columns, F.lit(LEFT).alias("_side"))
        .unionByName(current.select(*columns, F.lit(RIGHT).alias("_side")))
    )
    per_row = tagged.groupBy(*columns).agg(
        F.count_if(F.col("_side") == LEFT).alias("_before"),
        F.count_if(F.col("_side") == RIGHT).alias("_now"),
    )
    return per_row.agg(
        F.coalesce(F.sum("_before"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("_now"), F.lit(0)).alias("rows_now"),
        F.count_if(F.col("_before") == 0).alias("rows_inserted"),
        F.count_if(F.col("_now") == 0).alias("rows_deleted"),
    )


def attach_status(rows: DataFrame, current: DataFrame) -> DataFrame:
    """Give rows the status that active ``current`` rows hold for their hash.

    Status is reduced to one per hash first, so a repeated hash multiplies nothing.
    """
    status = (
        current.filter(F.col(ACTIVE))
        .groupBy(HASH)
        .agg(F.max(START).alias(START), F.max(END).alias(END))
        .withColumn(ACTIVE, F.lit(True))
    )
    return rows.join(status, HASH, "inner")


def close_out(
    history: DataFrame,
    deleted: DataFrame,
    run_ts: Column | datetime | None = None,
) -> DataFrame:
    """End the active rows whose hash is among the deleted ones; keep all others.

    Rows closed earlier keep their end even if they share the hash; they take no
    part in the join. The join is null-safe for the reason given at
    ``without_keys``; NULL hashes match nothing.
    """
    gone = deleted.select(HASH).dropna().distinct().withColumn("_gone", F.lit(True))
    end = stamp_column(run_ts).cast(history.schema[END].dataType)
    joined = active_rows(history).alias("history").join(
        gone.alias("gone"), match_keys("history", "gone", [HASH], null_safe=True), "left"
    )
    replaced = {
        END: F.when(F.col("_gone"), end).otherwise(F.col(END)).alias(END),
        ACTIVE: F.col("_gone").isNull().alias(ACTIVE),
    }
    active = joined.select(*[replaced.get(c, F.col(f"history.{c}")) for c in history.columns])
    return active.unionByName(history.filter(~F.col(ACTIVE) | F.col(ACTIVE).isNull()))


def scd2_apply(
    history: DataFrame,
    current: DataFrame,
    run_ts: Column | datetime | None = None,
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """The new history: rows that left are ended, new rows are appended.

    The difference is used twice. ``stage`` writes it once in between, which also
    gives Spark its true size: few changes then reach the history by broadcast and
    the history is not shuffled.
    """
    changes = snapshot_changes(history, current)
    if stage is not None:
        changes = stage(changes, "scd2_changes")
    closed = close_out(history, changes.filter(F.col("_side") == LEFT), run_ts)
    added = (
        changes.filter((F.col("_side") == RIGHT) & F.col("_live"))
        .withColumn(ACTIVE, F.lit(True))
        .select(*history.columns)
    )
    return closed.unionByName(added)


def split_changes(
    history: DataFrame, changes: DataFrame, run_ts: Column | datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows ended now, rows active from now on): what a run changes of a history.

    ``changes`` is :func:`snapshot_changes`. Rows ended earlier take no part, so cost
    follows the active rows and the changes.
    """
    active = active_rows(history)
    touched = close_out(active, changes.filter(F.col("_side") == LEFT), run_ts)
    added = (
        changes.filter((F.col("_side") == RIGHT) & F.col("_live"))
        .withColumn(ACTIVE, F.lit(True))
        .select(*history.columns)
    )
    return touched.filter(~F.col(ACTIVE)), touched.filter(ACTIVE).unionByName(added)


def version_feed(
    history: DataFrame,
    changes: DataFrame,
    version: int,
    run_ts: Column | datetime | None = None,
) -> DataFrame:
    """The change rows of a run: ended rows as pre- and post-image, new rows as inserts."""
    ended, _ = split_changes(history, changes, run_ts)
    before = active_rows(history).join(
        changes.filter(F.col("_side") == LEFT).select(HASH).dropna().distinct(), HASH, "left_semi"
    )
    added = (
        changes.filter((F.col("_side") == RIGHT) & F.col("_live"))
        .withColumn(ACTIVE, F.lit(True))
        .select(*history.columns)
    )
    parts = [(before, PREIMAGE), (ended, POSTIMAGE), (added, INSERT)]
    rows = [df.select(*history.columns, F.lit(kind).alias(CHANGE_TYPE)) for df, kind in parts]
    feed = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return feed.select(
        "*", F.lit(version).cast("long").alias(VERSION), stamp_column(run_ts).alias(COMMIT_TIME)
    )
