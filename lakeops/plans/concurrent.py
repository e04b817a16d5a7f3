"""Publishing several tables at a time."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from lakeops.plans.publish import Published, publish_all
from lakeops.plans.specs import PublishSpec

POOL = "spark.scheduler.pool"


def publish_together(
    spark: SparkSession,
    jobs: Iterable[tuple[PublishSpec, DataFrame | str, str]],
    at_once: int = 4,
    inclusive: bool = False,
    lengths: bool = False,
) -> list[Published]:
    """:func:`publish_all` with up to ``at_once`` tables under way, results in the order of ``jobs``.

    The driver only waits in its threads; Spark runs their jobs side by side, so small
    tables fill the cores that a large one leaves. Each table has a scheduler pool named
    after it, which shares cores evenly where the session's scheduler is FAIR, and a job
    tag: what a failed table still has running is cancelled by it, other tables go on.
    Two jobs of one target must not be under way together: such are refused. No jobs give
    no results.
    """
    jobs = list(jobs)
    targets = [target for _, _, target in jobs]
    if len(set(targets)) < len(targets):
        raise ValueError("a target is published once at a time")

    def one(job: tuple[PublishSpec, DataFrame | str, str]) -> Published:
        context, tag = spark.sparkContext, f"publish-{uuid.uuid4().hex}"
        context.setLocalProperty(POOL, job[0].name)
        context.addJobTag(tag)
        try:
            (result,) = publish_all(spark, [job], inclusive, lengths)
            if result.status == "failed":
                context.cancelJobsWithTag(tag)
            return result
        finally:
            context.removeJobTag(tag)
            context.setLocalProperty(POOL, None)

    with ThreadPoolExecutor(max(1, at_once)) as threads:
        # Wrapped once a job: what is wrapped together shares its properties, tags too.
        waiting = [threads.submit(inheritable_thread_target(spark)(one), job) for job in jobs]
        return [w.result() for w in waiting]
