"""Change-feed operators: filters, state at a version, feeds from snapshots."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.columns import match_keys
from lakeops.operators.difference import BOTH, LEFT, RIGHT, two_way_difference
from lakeops.operators.latest import latest_by_key

CHANGE_TYPE = "_change_type"
VERSION = "_commit_version"
COMMIT_TIME = "_commit_timestamp"

# The change types of a feed.
INSERT = "insert"
PREIMAGE = "update_preimage"
POSTIMAGE = "update_postimage"
DELETE = "delete"


def upserts_only(changes: DataFrame) -> DataFrame:
    """Rows that carry a new state: inserts and update post-images."""
    return changes.filter(F.col(CHANGE_TYPE).isin(INSERT, POSTIMAGE))


def snapshot_as_of(
    changes: DataFrame, version: int, keys: Sequence[str], tiebreak: Sequence[str]
) -> DataFrame:
    """Table state after commit ``version``: newest change per key, less deletes."""
    seen = changes.filter((F.col(VERSION) <= version) & (F.col(CHANGE_TYPE) != PREIMAGE))
    newest = latest_by_key(seen, keys, VERSION, tiebreak)
    return newest.filter(F.col(CHANGE_TYPE) != DELETE)


def as_first_load(df: DataFrame, commit_time: Column, version: int = 0) -> DataFrame:
    """The feed of a table's first load: every row an insert of one commit."""
    return df.select(
        "*",
        F.lit(INSERT).alias(CHANGE_TYPE),
        F.lit(version).cast("long").alias(VERSION),
        commit_time.alias(COMMIT_TIME),
    )


def snapshot_diff(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Change rows that turn snapshot ``old`` into ``new``.

    Step one drops unchanged rows with a single aggregation over both snapshots;
    step two looks, among the changed rows only, whether a key is on both sides.
    No pairs are formed, so a repeated or NULL key is safe.

    ``stage`` materializes the changed rows between the steps (see
    :class:`lakeops.sinks.staging.Staging`), so that both uses of them read a
    small table; without it the plan is lazy and evaluates step one twice.
    """
    changed = two_way_difference(old, new)
    if stage is not None:
        changed = stage(changed, "changed_rows")
    sides = changed.groupBy(*keys).agg(F.bit_or("_side").alias("_sides"))
    updated = F.col("_sides") == BOTH
    kind = (
        F.when(updated & (F.col("_side") == LEFT), PREIMAGE)
        .when(updated & (F.col("_side") == RIGHT), POSTIMAGE)
        .when(F.col("_side") == LEFT, DELETE)
        .otherwise(INSERT)
    )
    joined = changed.alias("changed").join(
        sides.alias("sides"), match_keys("changed", "sides", keys, null_safe=True)
    )
    return joined.select(*[F.col(f"changed.{c}") for c in old.columns], kind.alias(CHANGE_TYPE))
