"""The incremental run as a streaming aggregation: the newest change per key is the query's state."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.operators.changes import CHANGE_TYPE, COMMIT_TIME, DELETE, PREIMAGE, VERSION, upserts_only
from lakeops.plans.models import project, with_key
from lakeops.plans.specs import ModelSpec

ROW = "row"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# Fixed value: Spark's state store on local disk, which holds more keys than memory does.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def newest_by_key(
    spec: ModelSpec, changes: DataFrame, tiebreak: Sequence[str], deletes: bool = False
) -> DataFrame:
    """(keys, row): per model key the change that ``latest_by_key`` picks, as an aggregation.

    The highest version wins, then the lowest ``tiebreak``, NULLs last in both. The
    aggregation is partial before the shuffle and, in a stream, its result is the state:
    a late change of an old version does not replace a newer one.
    """
    if not tiebreak:
        raise ValueError("newest_by_key needs tie-break columns")
    kept = changes.filter(F.col(CHANGE_TYPE) != PREIMAGE) if deletes else upserts_only(changes)
    kept = with_key(spec, kept)
    columns = dict.fromkeys([*spec.source_columns, CHANGE_TYPE, VERSION, COMMIT_TIME])
    order = [F.col(VERSION).isNull(), -F.col(VERSION)]
    for c in tiebreak:
        order += [F.col(c).isNull(), F.col(c)]
    rank = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)))
    return kept.groupBy(*spec.source_keys).agg(F.min_by(F.struct(*columns), rank).alias(ROW))


def start_state_stream(
    spark: SparkSession,
    log: str,
    schema: T.StructType,
    spec: ModelSpec,
    tiebreak: Sequence[str],
    checkpoint: str,
    on_changes: Callable[[DataFrame], None] | None = None,
    files_per_trigger: int | None = None,
    apply_deletes: bool = False,
) -> StreamingQuery:
    """Fold new files of a change log into the newest change per key, kept in the state store.

    A batch costs its own rows and the state of their keys; nothing ranks earlier
    batches again. Files may arrive in any order of versions. ``on_changes`` gets the
    gold rows of keys whose newest change a batch looked at (update mode), deleted ones
    with their change type, for a merge into a table; it may get a batch again after a
    failure. Processes all that is there, then ends; the next start goes on from the
    checkpoint. With ``apply_deletes`` a delete may be the newest change.

    The state has one row a key, in RocksDB on the executors' disks with its change log
    at the checkpoint, so a lost executor's part is rebuilt elsewhere. The number of
    shuffle partitions of the first start stays that of the state.
    """
    # A file counts as new however old it is; Spark would skip those a week behind.
    reader = spark.readStream.schema(schema).option("maxFileAge", "36500d")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    newest = newest_by_key(spec, reader.parquet(log), tiebreak, apply_deletes)

    def write(batch: DataFrame, _: int) -> None:
        if on_changes is not None:
            on_changes(gold_rows(spec, batch, with_deleted=True))
        else:
            batch.write.format("noop").mode("overwrite").save()

    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return (
            newest.writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(PROVIDER, before)


def gold_rows(spec: ModelSpec, newest: DataFrame, with_deleted: bool = False) -> DataFrame:
    """Gold rows of (row); those whose newest change is a delete are gone, or flagged by its type."""
    rows = newest.select(f"{ROW}.*")
    if with_deleted:
        return project(spec, rows, F.col(COMMIT_TIME), [CHANGE_TYPE])
    return project(spec, rows.filter(F.col(CHANGE_TYPE) != DELETE), F.col(COMMIT_TIME))


def read_state(spark: SparkSession, spec: ModelSpec, checkpoint: str) -> DataFrame:
    """The gold table as the stream's last batch left it, read from its state store.

    One row a key, found by a scan of the state; nothing is ranked or merged.
    """
    state = spark.read.format("statestore").load(checkpoint)
    value = state.schema["value"].dataType
    row = next(f.name for f in value if isinstance(f.dataType, T.StructType) and CHANGE_TYPE in f.dataType.names)
    return gold_rows(spec, state.select(F.col("value")[row].alias(ROW)))
