"""Archive of replaced rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.columns import match_keys
from lakeops.operators.latest import latest_by_key


def history_capture(
    target: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    stamp: str,
    flag: str = "is_deleted",
    staged_tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Target rows about to be replaced or deleted, with the interval they held.

    One row per matching target/staged pair. Where staging may repeat a key, give
    ``staged_tiebreak``: the newest staged row of a key is then the one that ends
    the interval, and no target row is multiplied.
    """
    ends = staged.select(*keys, stamp, flag, *[c for c in staged_tiebreak or () if c not in keys])
    if staged_tiebreak is not None:
        ends = latest_by_key(ends, keys, stamp, staged_tiebreak)
    pairs = target.alias("old").join(ends.alias("ends"), match_keys("old", "ends", keys), "inner")
    return pairs.select(
        "old.*",
        F.col(f"old.{stamp}").alias("valid_from"),
        F.col(f"ends.{stamp}").alias("valid_to"),
        F.lit(False).alias("is_current"),
        F.when(F.col(f"ends.{flag}"), "DELETE").otherwise("UPDATE").alias("change_type"),
    )


def full_history(history: DataFrame, current: DataFrame, stamp: str) -> DataFrame:
    """Archived rows together with the current ones as open intervals."""
    end: Column = F.lit(None).cast(history.schema["valid_to"].dataType)
    opened = current.select(
        "*",
        F.col(stamp).alias("valid_from"),
        end.alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.lit("INSERT").alias("change_type"),
    )
    return history.unionByName(opened)
