"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the code written for "not defined".
UNDEFINED_CODE = "99999999"


def row_hash(columns: Sequence[str]) -> Column:
    """md5 fingerprint of a row.

    Every value is written as ``<length>:<text>`` and NULL as ``-``, so neither a
    NULL nor a separator inside a value can make two different rows collide.
    """
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts.append(
            F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        )
    return F.md5(F.concat_ws("|", *parts))


def default_code(column: Column, code: str = UNDEFINED_CODE) -> Column:
    return F.coalesce(column, F.lit(code))


def literal_timestamp(text: str) -> Column:
    """A time-zone-free timestamp literal."""
    return F.lit(text).cast("timestamp_ntz")


def stamp_column(run_ts: Column | datetime | None) -> Column:
    """The run-time stamp: the given time, or the current time if none is given."""
    if run_ts is None:
        return F.current_timestamp()
    return run_ts if isinstance(run_ts, Column) else F.lit(run_ts)


def match_keys(left: str, right: str, keys: Sequence[str], null_safe: bool = False) -> Column:
    """Join condition on the key columns of two frames, named by their alias.

    With ``null_safe`` a NULL key part matches NULL; Spark turns it into
    coalesce/isnull hash keys, so the join stays an equi-join.
    """
    pairs = [(F.col(f"{left}.{k}"), F.col(f"{right}.{k}")) for k in keys]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])
