"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.sinks.staging import Staging


def connected_components(edges: DataFrame, stage: Staging, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node it is connected with.

    Alternating large-star and small-star steps: each hangs neighbours on the
    smallest node seen, until no edge changes. Only minima are aggregated, and staged:
    AQE splits a node with very many neighbours where both sides of a join come
    straight from a shuffle, not from an aggregation.
    Every step is written to shared storage, which cuts the lineage. Edges with a
    null end and loops join nothing; an empty table gives an empty result.
    """
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    edges = (
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), (a.isNull() | b.isNull()).alias("gap"))
        .where("not gap and a <> b")
        .select("a", "b")
        .distinct()
    )
    current, before = stage(edges, f"{name}-edges"), None
    while True:
        current, now = _star_steps(current, stage, name)
        if now == before:
            break
        before = now
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _star_steps(edges: DataFrame, stage: Staging, name: str) -> tuple[DataFrame, tuple]:
    """One large-star and one small-star step; the state that no longer changes at the end."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = stage(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m")), f"{name}-nearest")
    large = (
        both.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )
    large = stage(large, f"{name}-large")
    smallest = stage(large.groupBy("a").agg(F.min("b").alias("m")), f"{name}-least")
    small = large.join(smallest, "a").select(
        F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
    )
    small = stage(small.select("e.*").where("a <> b").distinct(), f"{name}-small")
    return small, small.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
