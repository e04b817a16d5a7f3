"""Upserts and deletes by key, as whole-table results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.columns import match_keys


def without_keys(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Target rows whose key is not in the source (DELETE ... USING source).

    Source keys are made distinct first, so a repeated key costs one row, unless
    ``unique`` says they are already. A key list that is small (by the size of its
    files, or as measured at run time) is broadcast and the target is not shuffled;
    a large one is joined by sort-merge, where AQE splits a key that is hot in the
    target. It only does so for a join input that comes straight from a shuffle,
    not from an aggregation: the null-safe comparison has join keys of its own and
    so puts a shuffle of the distinct keys in between.
    """
    hits = source.select(*keys)
    if not null_safe:
        hits = hits.dropna()
    if not unique:
        hits, null_safe = hits.distinct(), True
    match = match_keys("target", "hits", keys, null_safe)
    return target.alias("target").join(hits.alias("hits"), match, "left_anti")


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Merge by key: source rows replace target rows of the same key, others stay.

    The source must hold one row per key (``latest_by_key`` first). ``null_safe``
    lets a NULL key part match NULL, which keeps reruns repeatable.
    """
    kept = without_keys(target, source, keys, null_safe, unique=True)
    return kept.unionByName(source)


def delete_insert(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Delete target rows whose key is staged, then insert every staged row.

    Unlike :func:`upsert` the staged rows may repeat a key; all of them survive.
    ``null_safe`` lets a NULL key part match NULL: without, as in plain SQL, rows with
    such a key are inserted again each time they are staged.
    """
    kept = without_keys(target, staged, keys, null_safe)
    return kept.unionByName(staged.select(*target.columns))


def apply_tombstones(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], flag: str = "is_deleted"
) -> DataFrame:
    """Remove target rows with a staged row flagged as deleted (NULL is not)."""
    return without_keys(target, staged.filter(F.col(flag)), keys)


def publish_with_deletes(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], flag: str = "is_deleted"
) -> DataFrame:
    """Apply tombstones, then replace the rows staged as live.

    Both deletes are one anti-join: a staged row with a NULL flag neither deletes
    nor replaces, as in three-valued SQL.
    """
    flagged = staged.filter(F.col(flag).isNotNull())
    live = staged.filter(~F.col(flag)).select(*target.columns)
    return without_keys(target, flagged, keys).unionByName(live)
