"""The streamed run gives the rows of the batch run."""

import pytest
from pyspark.sql import functions as F

from lakeops import fixtures as fx
from lakeops.operators.changes import VERSION, snapshot_as_of
from lakeops.plans import specs
from lakeops.plans.models import gold_increment
from lakeops.plans.specs import ModelSpec
from lakeops.sinks.files import folder_names
from lakeops.sinks.tables import append_changes
from lakeops.sources.registry import read_changes
from lakeops.streaming.increments import compact_streamed, read_streamed, start_stream

USERS = ModelSpec(
    name="users", source="events", keys=("user",), columns={"user": "user_id", "last": "value"}
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def run(spark, feed, spec, tiebreak, root, files=None, log="log", table="table"):
    query = start_stream(
        spark, f"{root}/{log}", feed.schema, spec, tiebreak, f"{root}/{table}", f"{root}/checkpoint", files
    )
    query.awaitTermination()
    assert query.exception() is None


@pytest.mark.parametrize("files", [None, 7])
def test_stream_equals_batch(spark, sf_dir, root, files):
    feed = fx.event_feed(spark, sf_dir)
    append_changes(feed, f"{root}/log")
    run(spark, feed, USERS, fx.EVENT_TIEBREAK, root, files)
    batches = folder_names(spark, f"{root}/table")
    assert len(batches) == 1 if files is None else len(batches) > 3
    streamed = read_streamed(spark, USERS, fx.EVENT_TIEBREAK, f"{root}/table")
    assert rows(streamed) == rows(gold_increment(USERS, feed, fx.EVENT_TIEBREAK))


def test_stream_goes_on_after_a_stop_and_a_compaction(spark, sf_dir, root):
    feed = fx.event_feed(spark, sf_dir)
    expected = rows(gold_increment(USERS, feed, fx.EVENT_TIEBREAK))
    # later commits arrive first
    append_changes(read_changes(feed, 16), f"{root}/log")
    run(spark, feed, USERS, fx.EVENT_TIEBREAK, root)
    append_changes(read_changes(feed, 0, 15), f"{root}/log")
    compact_streamed(spark, USERS, fx.EVENT_TIEBREAK, f"{root}/table", f"{root}/folded")
    run(spark, feed, USERS, fx.EVENT_TIEBREAK, root, table="folded")
    assert folder_names(spark, f"{root}/folded") and len(folder_names(spark, f"{root}/folded")) == 2
    assert rows(read_streamed(spark, USERS, fx.EVENT_TIEBREAK, f"{root}/folded")) == expected
    run(spark, feed, USERS, fx.EVENT_TIEBREAK, root, table="folded")
    assert rows(read_streamed(spark, USERS, fx.EVENT_TIEBREAK, f"{root}/folded")) == expected


def test_a_repeated_batch_replaces_its_folder(spark, sf_dir, root):
    feed = fx.event_feed(spark, sf_dir)
    append_changes(feed, f"{root}/log")
    run(spark, feed, USERS, fx.EVENT_TIEBREAK, root)
    before = rows(spark.read.parquet(f"{root}/table"))
    # a new checkpoint numbers from 0 again, as a retry after a lost commit does
    query = start_stream(
        spark, f"{root}/log", feed.schema, USERS, fx.EVENT_TIEBREAK, f"{root}/table", f"{root}/checkpoint2"
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(f"{root}/table")) == before


def test_invoices_streamed_to_a_dimension(spark, sf_dir, root):
    spec = specs.DIM_PRODUTO
    feed = fx.invoice_feed(spark, sf_dir, spec.source_columns)
    append_changes(feed, f"{root}/log")
    run(spark, feed, spec, fx.INVOICE_TIEBREAK, root, files=2)
    streamed = read_streamed(spark, spec, fx.INVOICE_TIEBREAK, f"{root}/table")
    assert rows(streamed) == rows(gold_increment(spec, feed, fx.INVOICE_TIEBREAK))
    assert streamed.filter(F.col("ProdutoCodigo").isNull()).count() == 0
    assert VERSION in spark.read.parquet(f"{root}/table").columns


@pytest.mark.parametrize("fold", [False, True])
def test_streamed_deletes(spark, sf_dir, root, fold):
    """The later half arrives first; a delete wins over older rows that come after it."""
    feed = fx.event_feed(spark, sf_dir)
    table = f"{root}/table"
    for part in (read_changes(feed, 16), read_changes(feed, 0, 15)):
        append_changes(part, f"{root}/log")
        query = start_stream(
            spark, f"{root}/log", feed.schema, USERS, fx.EVENT_TIEBREAK, table, f"{root}/checkpoint", None, True
        )
        query.awaitTermination()
        if fold:
            compact_streamed(spark, USERS, fx.EVENT_TIEBREAK, table, f"{table}-folded")
            table = f"{table}-folded"
    expected = snapshot_as_of(feed.filter("user_id is not null"), 99, ["user_id"], fx.EVENT_TIEBREAK)
    streamed = read_streamed(spark, USERS, fx.EVENT_TIEBREAK, table)
    assert rows(streamed.select("user", "last")) == rows(expected.select("user_id", "value"))
    assert streamed.count() < feed.select("user_id").distinct().count()
