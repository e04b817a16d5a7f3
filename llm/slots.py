"""Leave out rows that a join would drop, before they are shuffled for it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS_A_KEY = 32
# 8 MB of bits in a million words of 64: what is broadcast stays bounded for any number of keys.
MOST_SLOTS = 1 << 26


def perhaps_in(rows: DataFrame, key: Sequence[str], wanted: DataFrame, count: int) -> DataFrame:
    """The rows whose key is among the ``count`` keys of ``wanted``, and a few others.

    Each wanted key's hash marks one of 32 slots a key, so one in 32 of the other rows
    passes; beyond MOST_SLOTS more do. The marks are broadcast; what must be exact, a join
    with ``wanted`` does afterwards. The key columns have one name and type on both sides.
    """
    slots = min(max(SLOTS_A_KEY * count, 64), MOST_SLOTS)
    slot = F.pmod(F.xxhash64(*key), F.lit(slots)).alias("_slot")
    marks = wanted.select(slot).select(F.shiftright("_slot", 6).alias("_word"), F.expr("shiftleft(1L, cast(_slot % 64 as int))").alias("_mark"))
    words = marks.groupBy("_word").agg(F.bit_or("_mark").alias("_marks"))
    found = rows.select("*", slot).withColumn("_word", F.shiftright("_slot", 6)).join(F.broadcast(words), "_word")
    return found.where(F.getbit("_marks", (F.col("_slot") % 64).cast("int")) == 1).select(*rows.columns)
