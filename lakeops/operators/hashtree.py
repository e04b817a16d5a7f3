"""Reconciliation of two tables by a tree of hash sums: only parts that differ are compared by row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.quality import reconcile

# Leaves of the tree and children of a node; the table of leaves is at most so many rows a side.
LEAVES, CHILDREN = 1 << 16, 1 << 8
SUMS = ("n", "total", "mixed")


def leaf_of(keys: Sequence[str], leaves: int = LEAVES) -> Column:
    """The leaf a row belongs to, by its key; rows with a NULL key have one too."""
    return F.pmod(F.xxhash64(*keys), F.lit(leaves))


def leaf_sums(df: DataFrame, keys: Sequence[str], leaves: int = LEAVES) -> DataFrame:
    """(leaf, n, total, mixed): order-free sums of the row hashes of each leaf.

    Rows are counted, one hash is summed and another, independent one mixed by
    exclusive or, so rows that trade places do not matter and repeated rows count.
    Sums are partial before the shuffle: each task sends a row a leaf at most.
    """
    columns = [F.col(c) for c in df.columns]
    rows = df.select(
        leaf_of(keys, leaves).alias("leaf"),
        F.xxhash64(*columns).cast("decimal(20,0)").alias("h"),
        F.xxhash64(F.lit(1), *columns).alias("g"),
    )
    return rows.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"), F.sum("h").cast("decimal(38,0)").alias("total"), F.bit_xor("g").alias("mixed")
    )


def _rolled(sums: DataFrame, width: int) -> DataFrame:
    """The sums of nodes that span ``width`` leaves, from those of the leaves."""
    node = F.floor(F.col("leaf") / width)
    return sums.groupBy(node.alias("node")).agg(
        F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"), F.bit_xor("mixed").alias("mixed")
    )


def differing_leaves(left: DataFrame, right: DataFrame, leaves: int = LEAVES) -> DataFrame:
    """(leaf) whose sums differ, or that one side lacks; found from the root down.

    ``left`` and ``right`` are staged :func:`leaf_sums`. A level is compared only below
    the differing nodes of the level above.
    """
    width, wider, above = leaves, leaves, None
    while True:
        sides = []
        for sums in (left, right):
            if above is not None:
                parent = F.floor(F.col("leaf") / wider)
                sums = sums.join(F.broadcast(above), parent == F.col("parent"), "left_semi")
            sides.append(_rolled(sums, width))
        a, b = sides[0].alias("a"), sides[1].alias("b")
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in SUMS]
        found = a.join(b, F.col("a.node") == F.col("b.node"), "full").where(~(same[0] & same[1] & same[2]))
        found = found.select(F.coalesce("a.node", "b.node").alias("parent"))
        if width == 1:
            return found.withColumnRenamed("parent", "leaf")
        above, wider, width = found, width, max(width // CHILDREN, 1)


def reconcile_by_tree(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    stage: Callable[[DataFrame, str], DataFrame],
    ignore: Sequence[str] = (),
    leaves: int = LEAVES,
) -> DataFrame:
    """The rows of :func:`lakeops.operators.quality.reconcile`, most of them never shuffled.

    Both tables are summed by leaf of their key, a row a leaf; the trees over these are
    compared from the root down; only rows of leaves that differ are compared as rows.
    Equal tables cost the two aggregations and no comparison of rows. The list of
    differing leaves has ``leaves`` rows at most and is broadcast. ``keys`` must be
    among the compared columns; a changed row then lies in one leaf on both sides.

    Repeated rows count in the sums, not in the result: a leaf that differs by them
    alone is compared and gives nothing. NULLs equal each other. Empty tables are equal.
    """
    left, right = left.drop(*ignore), right.drop(*ignore)
    right = right.select(*left.columns)
    sums = [stage(leaf_sums(df, keys, leaves), name) for df, name in ((left, "left_sums"), (right, "right_sums"))]
    found = stage(differing_leaves(*sums, leaves), "leaves")
    if found.isEmpty():
        return reconcile(left.limit(0), right.limit(0))
    parts = [df.join(F.broadcast(found), leaf_of(keys, leaves) == F.col("leaf"), "left_semi") for df in (left, right)]
    return reconcile(*parts)
