"""Laws of the operators on random tables, against plain Python."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeops.operators import quality, scd2
from lakeops.operators.changes import snapshot_as_of, snapshot_diff, upserts_only
from lakeops.operators.latest import latest_by_key
from lakeops.operators.merge import publish_with_deletes, upsert, without_keys
from lakeops.sources.registry import read_changes

KINDS = ["insert", "update_preimage", "update_postimage", "delete"]
FEED = "k string, part int, id int, v int, _change_type string, _commit_version long"
KEYS = ["k", "part"]
RUN = datetime(2024, 2, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_feed(seed):
    """Changes of few keys, so that versions tie; one key holds a third of them."""
    rng = random.Random(seed)
    feed = []
    for i in range(600):
        hot = rng.random() < 1 / 3
        key = ("hot", 0) if hot else (rng.choice([None, *"abcdefgh"]), rng.choice([None, 1, 2]))
        feed.append((*key, i, rng.randrange(5), rng.choice(KINDS), rng.randrange(8)))
    return feed


def newest(feed, kinds):
    best = {}
    for row in feed:
        if row[4] in kinds:
            held = best.get(row[:2])
            if held is None or (-row[5], row[2]) < (-held[5], held[2]):
                best[row[:2]] = row
    return best


@pytest.fixture(params=[1, 2, 3])
def feed(request, spark):
    data = random_feed(request.param)
    return data, spark.createDataFrame(data, FEED)


def test_latest_and_as_of(feed):
    data, df = feed
    expected = newest(data, ("insert", "update_postimage")).values()
    found = latest_by_key(upserts_only(df), KEYS, "_commit_version", ["id"])
    assert rows(found) == sorted(expected, key=repr)
    for version in (0, 3, 9):
        seen = [r for r in data if r[5] <= version]
        state = newest(seen, ("insert", "update_postimage", "delete")).values()
        expected = sorted((r for r in state if r[4] != "delete"), key=repr)
        assert rows(snapshot_as_of(df, version, KEYS, ["id"])) == expected


def test_resume_is_replay_and_a_rerun_changes_nothing(feed):
    _, df = feed

    def state(changes):
        return latest_by_key(upserts_only(changes), KEYS, "_commit_version", ["id"])

    early, late = state(read_changes(df, 0, 3)), state(read_changes(df, 4))
    resumed = upsert(early, late, KEYS, null_safe=True)
    assert rows(resumed) == rows(state(df))
    assert rows(upsert(resumed, late, KEYS, null_safe=True)) == rows(resumed)
    repeats = quality.repeated_keys(resumed.withColumn("part", F.coalesce("part", F.lit(-1))), KEYS)
    assert repeats.count() == 0


def test_diff_moves_one_snapshot_to_the_next(feed):
    _, df = feed
    old = snapshot_as_of(df, 3, KEYS, ["id"]).select("k", "part", "v")
    new = snapshot_as_of(df, 7, KEYS, ["id"]).select("k", "part", "v")
    diff = snapshot_diff(old, new, KEYS)
    gone = diff.filter(F.col("_change_type").isin("delete", "update_preimage"))
    come = diff.filter(F.col("_change_type").isin("insert", "update_postimage"))
    moved = without_keys(old, gone, KEYS, null_safe=True).unionByName(come.drop("_change_type"))
    assert rows(moved) == rows(new)
    images = diff.groupBy("_change_type").count()
    counts = {r._change_type: r["count"] for r in images.collect()}
    assert counts.get("update_preimage", 0) == counts.get("update_postimage", 0)


def test_publish_against_row_by_row(feed, spark):
    data, _ = feed
    rng = random.Random(len(data))
    target = [(i, rng.randrange(9)) for i in range(60)]
    staged = [(i, rng.randrange(9), rng.choice([True, False, None])) for i in range(30, 90)]
    flags = {k: f for k, _, f in staged}
    expected = [r for r in target if flags.get(r[0]) is None]
    expected += [(k, v) for k, v, f in staged if f is False]
    result = publish_with_deletes(
        spark.createDataFrame(target, "k int, v int"),
        spark.createDataFrame(staged, "k int, v int, is_deleted boolean"),
        ["k"],
    )
    assert rows(result) == sorted(expected, key=repr)


def test_type_2_history_over_many_loads(feed, spark):
    """After each load the active rows are the loaded ones, and what was closed once
    stays as it is."""
    data, _ = feed
    schema = (
        "k string, v int, hash_value string, data_inicio timestamp_ntz, "
        "data_fim timestamp_ntz, ativo boolean"
    )
    history = spark.createDataFrame([], schema)
    closed = set()
    for load in range(4):
        day = datetime(2024, 1, load + 1)
        loaded = {(str(r[0]), r[3]) for r in data if r[5] % 4 == load}
        current = spark.createDataFrame(
            [(k, v, f"{k}/{v}", day, None, True) for k, v in loaded], schema
        )
        result = rows(scd2.scd2_apply(history, current, day))
        assert sorted((r[0], r[1]) for r in result if r[5]) == sorted(loaded)
        now_closed = {r for r in result if not r[5]}
        assert closed <= now_closed and all(r[4] is not None for r in now_closed)
        assert all(r[4] == day for r in now_closed - closed)
        closed = now_closed
        history = spark.createDataFrame(result, schema)
    assert closed
