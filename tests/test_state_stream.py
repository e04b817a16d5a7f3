"""The stateful stream gives the rows of the batch run."""

import pytest
from pyspark.sql import functions as F

from lakeops import fixtures as fx
from lakeops.operators.changes import DELETE, VERSION, snapshot_as_of
from lakeops.plans import specs
from lakeops.plans.models import gold_increment
from lakeops.plans.specs import ModelSpec
from lakeops.streaming.state import gold_rows, newest_by_key, read_state, start_state_stream

USERS = ModelSpec(
    name="users", source="events", keys=("user",), columns={"user": "user_id", "last": "value"}
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def run(spark, feed, root, **more):
    query = start_state_stream(
        spark, f"{root}/log", feed.schema, USERS, fx.EVENT_TIEBREAK, f"{root}/checkpoint", **more
    )
    query.awaitTermination()
    assert query.exception() is None


def arrive(feed, root, low, high):
    feed.filter(F.col(VERSION).between(low, high)).coalesce(2).write.mode("append").parquet(f"{root}/log")


@pytest.mark.parametrize("deletes", [False, True])
def test_batch_form_picks_the_same_rows(spark, sf_dir, deletes):
    feed = fx.stock_feed(spark, sf_dir)
    spec = specs.MODELS["fato_estoque"]
    got = gold_rows(spec, newest_by_key(spec, feed, fx.STOCK_TIEBREAK, deletes))
    if not deletes:
        assert rows(got) == rows(gold_increment(spec, feed, fx.STOCK_TIEBREAK))
    else:
        last = feed.agg(F.max(VERSION)).first()[0]
        kept = snapshot_as_of(feed, last, spec.source_keys, fx.STOCK_TIEBREAK)
        assert got.count() == kept.count()


def test_stream_equals_batch_after_a_stop_with_late_files_and_deletes(spark, sf_dir, root):
    feed = fx.event_feed(spark, sf_dir)
    last = feed.agg(F.max(VERSION)).first()[0]
    expected = snapshot_as_of(feed, last, ["user_id"], fx.EVENT_TIEBREAK)
    expected = rows(expected.select("user_id", "value", "_commit_timestamp"))
    seen = []
    arrive(feed, root, 16, 99)  # the newest commits arrive first
    run(spark, feed, root, apply_deletes=True, on_changes=lambda df: seen.extend(df.collect()))
    arrive(feed, root, 0, 8)
    arrive(feed, root, 9, 15)
    run(spark, feed, root, apply_deletes=True, files_per_trigger=2, on_changes=lambda df: seen.extend(df.collect()))
    assert rows(read_state(spark, USERS, f"{root}/checkpoint")) == expected
    assert any(r["_change_type"] == DELETE for r in seen)
    run(spark, feed, root, apply_deletes=True)  # nothing new
    assert rows(read_state(spark, USERS, f"{root}/checkpoint")) == expected


def test_reading_the_state_ranks_nothing(spark, sf_dir, root):
    feed = fx.event_feed(spark, sf_dir)
    arrive(feed, root, 0, 99)
    run(spark, feed, root)
    table = read_state(spark, USERS, f"{root}/checkpoint")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan and "Aggregate" not in plan
    assert rows(table) == rows(gold_increment(USERS, feed, fx.EVENT_TIEBREAK))


def test_tie_breaks_are_required(spark, sf_dir):
    with pytest.raises(ValueError):
        newest_by_key(USERS, fx.event_feed(spark, sf_dir), [])
