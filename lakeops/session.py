"""Session settings the operators are planned for."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

# Everything else stays at Spark's defaults: the vectorized Parquet reader, the
# default codec and AQE's own choice of join strategy.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
}

PARTITION_BYTES = 128 * 1024 * 1024
EVEN_PARTITIONS = 10_000


def shuffle_partitions_for(input_bytes: int) -> int:
    """Shuffle partitions for a job that may shuffle all its input.

    Near 128 MB each up to 10,000 of them. Beyond, their number grows with the square
    root and so does their size: the driver keeps a map of partitions for every map
    task, and sorting a larger partition with some spill is cheaper than that. AQE
    merges partitions that turn out small. 100 TB gives about 90,000 of 1.2 GB.
    """
    even = math.ceil(input_bytes / PARTITION_BYTES)
    if even > EVEN_PARTITIONS:
        even = math.ceil(math.sqrt(even * EVEN_PARTITIONS))
    return max(200, even)


def build_session(
    app_name: str = "lakeops",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with :data:`SETTINGS`; on a cluster ``master`` comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
