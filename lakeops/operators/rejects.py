"""Bulk loads that keep what does not fit: rows typed as declared, and rejected ones with their reason."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakeops.functions.types import cast_columns, parse_type

REASONS = "_reasons"
_LENGTH = re.compile(r"\s*(?:VAR)?CHAR\s*\(\s*(\d+)\s*\)", re.I)


class TooManyRejects(RuntimeError):
    """More rows than the caller allows do not fit the declared types."""


@dataclass(frozen=True)
class Load:
    """Outcome of a load: typed rows, rejected values, and how many rows are either."""

    rows: DataFrame
    rejects: DataFrame
    loaded: int
    rejected: int


def _reasons(name: str, declared: str, key: bool) -> list[Column]:
    """What may be wrong with a column's value, each NULL where it is not."""
    column, dtype, found = F.col(name), parse_type(declared), []

    def reason(wrong: Column, text: str) -> Column:
        return F.when(wrong, F.struct(F.lit(name).alias("column_name"), F.lit(text).alias("reason"), column.cast("string").alias("value")))

    if key:
        found.append(reason(column.isNull(), "key is null"))
    length = _LENGTH.match(declared)
    if length:
        found.append(reason(F.char_length(column.cast("string")) > int(length[1]), f"longer than {length[1]}"))
    elif dtype is not None:
        found.append(reason(column.isNotNull() & column.try_cast(dtype).isNull(), f"not {declared}"))
    return found


def load_with_rejects(
    df: DataFrame,
    columns: Mapping[str, str],
    stage: Callable[[DataFrame, str], DataFrame],
    keys: Sequence[str] = (),
    limit: int | None = None,
) -> Load:
    """Split ``df`` into rows that fit the declared ``columns`` and values that do not.

    One pass judges every declared column: values that cannot be cast, text longer than
    its declared length and NULL key parts. The judged rows are staged once and counted
    on the way; typed rows and rejects are read from there. A row with a reject is not
    loaded. With more than ``limit`` rejected rows the load fails before anything is
    used of it. ``rejects`` has the keys as text, ``column_name``, ``reason`` and the
    ``value`` as text: a row a reason. Undeclared columns are left out. NULLs fit any
    column but a key; repeated rows are judged each; an empty table loads nothing.
    """
    wrong = [r for name, declared in columns.items() for r in _reasons(name, declared, name in keys)]
    none = "array<struct<column_name: string, reason: string, value: string>>"
    reasons = F.filter(F.array(*wrong), lambda r: r.isNotNull()) if wrong else F.array().cast(none)
    counted = Observation(f"load-{uuid.uuid4().hex}")
    judged = df.select(*columns, reasons.alias(REASONS)).observe(
        counted, F.count(F.lit(1)).alias("rows"), F.count_if(F.size(REASONS) > 0).alias("rejected")
    )
    judged = stage(judged, "judged")
    rejected = counted.get["rejected"]
    if limit is not None and rejected > limit:
        raise TooManyRejects(f"{rejected} rows do not fit the declared columns, {limit} are allowed")
    rows = cast_columns(judged.filter(F.size(REASONS) == 0), columns)
    texts = [F.col(k).cast("string").alias(k) for k in keys]
    rejects = judged.filter(F.size(REASONS) > 0).select(*texts, F.inline(REASONS))
    return Load(rows, rejects, counted.get["rows"] - rejected, rejected)
