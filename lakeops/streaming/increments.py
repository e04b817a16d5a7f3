"""The incremental run as a Structured Streaming query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.operators.changes import CHANGE_TYPE, COMMIT_TIME, DELETE, VERSION
from lakeops.operators.latest import latest_by_key
from lakeops.plans.models import newest_changes, project
from lakeops.plans.specs import ModelSpec
from lakeops.sinks.files import folder_names

BATCH = "_batch"


def start_stream(
    spark: SparkSession,
    log: str,
    schema: T.StructType,
    spec: ModelSpec,
    tiebreak: Sequence[str],
    table_root: str,
    checkpoint: str,
    files_per_trigger: int | None = None,
    apply_deletes: bool = False,
) -> StreamingQuery:
    """Read new files of a change log and add each batch's newest rows to a table.

    A batch writes only its own folder ``_batch=<id>``: its cost follows the batch
    and not the table, and a batch run again after a failure replaces its folder.
    Rows keep their version and tie-break columns, so :func:`read_streamed` finds
    the right winner even if files arrive out of version order. With ``apply_deletes``
    a delete may be that winner, and its key is then not in the table.

    Processes all that is there, then ends (``availableNow``); the checkpoint
    remembers where the next start goes on.
    """
    # A file counts as new however old it is; Spark would skip those a week behind.
    reader = spark.readStream.schema(schema).option("maxFileAge", "36500d")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        newest_changes(spec, batch, tiebreak, deletes=apply_deletes).write.mode("overwrite").parquet(
            f"{table_root}/{BATCH}={batch_id}"
        )

    return (
        reader.parquet(log)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def streamed_rows(
    spark: SparkSession, spec: ModelSpec, tiebreak: Sequence[str], table_root: str
) -> DataFrame:
    """Newest change per key over all batches written so far, deletes included."""
    rows = spark.read.parquet(table_root).drop(BATCH)
    return latest_by_key(rows, spec.source_keys, VERSION, tiebreak)


def read_streamed(
    spark: SparkSession, spec: ModelSpec, tiebreak: Sequence[str], table_root: str
) -> DataFrame:
    """The gold table kept by :func:`start_stream`."""
    rows = streamed_rows(spark, spec, tiebreak, table_root)
    return project(spec, rows.filter(F.col(CHANGE_TYPE) != DELETE), F.col(COMMIT_TIME))


def compact_streamed(
    spark: SparkSession,
    spec: ModelSpec,
    tiebreak: Sequence[str],
    table_root: str,
    new_root: str,
) -> None:
    """Fold all batches into one below ``new_root``, while the stream is stopped.

    The folded batch takes the last batch's number; the stream then goes on with
    ``new_root`` and its next number.
    """
    last = max(int(n.split("=")[1]) for n in folder_names(spark, table_root) if "=" in n)
    streamed_rows(spark, spec, tiebreak, table_root).hint("rebalance").write.mode(
        "overwrite"
    ).parquet(f"{new_root}/{BATCH}={last}")
