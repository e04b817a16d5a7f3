"""Edge cases of the operators on small frames."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeops.functions.columns import default_code, row_hash
from lakeops.operators import quality, scd2
from lakeops.operators.changes import snapshot_as_of, snapshot_diff, upserts_only
from lakeops.operators.difference import rows_only_left, rows_only_right, two_way_difference
from lakeops.operators.history import full_history, history_capture
from lakeops.operators.latest import latest_by_key
from lakeops.operators.merge import (
    apply_tombstones,
    delete_insert,
    publish_with_deletes,
    upsert,
    without_keys,
)
from lakeops.sinks.staging import Staging

FEED = "k string, v int, _change_type string, _commit_version long"
RUN = datetime(2024, 2, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_latest_needs_a_tiebreak(spark):
    with pytest.raises(ValueError):
        latest_by_key(spark.range(3), ["id"], "id", [])


def test_latest_breaks_version_ties_and_groups_null_keys(spark):
    df = spark.createDataFrame(
        [("a", 2, "insert", 1), ("a", 1, "insert", 1), ("a", 9, "insert", 0),
         (None, 5, "insert", 0), (None, 6, "insert", 3)],
        FEED,
    )
    assert rows(latest_by_key(df, ["k"], "_commit_version", ["v"]).select("k", "v")) == [
        ("a", 1), (None, 6)
    ]


def test_upserts_only_keeps_new_states(spark):
    kinds = ["insert", "update_preimage", "update_postimage", "delete"]
    df = spark.createDataFrame([("a", i, kind, 0) for i, kind in enumerate(kinds)], FEED)
    assert [r.v for r in upserts_only(df).orderBy("v").collect()] == [0, 2]


def test_empty_feed(spark):
    empty = spark.createDataFrame([], FEED)
    assert latest_by_key(upserts_only(empty), ["k"], "_commit_version", ["v"]).count() == 0
    state = spark.createDataFrame([("a", 1, "insert", 0)], FEED)
    assert rows(upsert(state, empty, ["k"])) == rows(state)


def test_snapshot_as_of_drops_deleted_keys(spark):
    df = spark.createDataFrame(
        [("a", 1, "insert", 0), ("a", 1, "delete", 1), ("b", 1, "insert", 0),
         ("b", 1, "update_preimage", 1), ("b", 2, "update_postimage", 1), ("a", 3, "insert", 2)],
        FEED,
    )
    state = [snapshot_as_of(df, v, ["k"], ["v"]).select("k", "v") for v in (0, 1, 2)]
    assert [rows(s) for s in state] == [[("a", 1), ("b", 1)], [("b", 2)], [("a", 3), ("b", 2)]]


@pytest.mark.parametrize("null_safe, expected", [
    (True, [("x", None, 2), ("y", "1", 3)]),
    (False, [("x", None, 1), ("x", None, 2), ("y", "1", 3)]),
])
def test_upsert_of_null_key_parts(spark, null_safe, expected):
    schema = "a string, b string, v int"
    target = spark.createDataFrame([("x", None, 1), ("y", "1", 1)], schema)
    source = spark.createDataFrame([("x", None, 2), ("y", "1", 3)], schema)
    assert rows(upsert(target, source, ["a", "b"], null_safe)) == sorted(expected, key=repr)


def test_upsert_twice_is_upsert_once(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = upsert(target, source, ["k"])
    assert rows(upsert(once, source, ["k"])) == rows(once) == [(1, "a"), (2, "B"), (3, "c")]


def test_upsert_aligns_columns_by_name(spark):
    target = spark.createDataFrame([(1, 10)], "k int, v int")
    source = spark.createDataFrame([(20, 2)], "v int, k int")
    assert rows(upsert(target, source, ["k"])) == [(1, 10), (2, 20)]


def test_delete_insert_keeps_repeated_staged_rows(spark):
    target = spark.createDataFrame([(1, "old"), (2, "stays")], "k int, v string")
    staged = spark.createDataFrame([(1, "n1"), (1, "n2")], "k int, v string")
    assert rows(delete_insert(target, staged, ["k"])) == [(1, "n1"), (1, "n2"), (2, "stays")]


def test_null_keys_are_not_deleted(spark):
    schema = "k int, v string"
    target = spark.createDataFrame([(None, "a"), (1, "b")], schema)
    staged = spark.createDataFrame([(None, "x"), (1, "y")], schema)
    assert rows(without_keys(target, staged, ["k"])) == [(None, "a")]
    assert rows(without_keys(target, staged, ["k"], unique=True)) == [(None, "a")]
    assert rows(without_keys(target, staged, ["k"], null_safe=True)) == []


def test_flags_follow_three_valued_logic(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "k int, v string")
    staged = spark.createDataFrame(
        [(1, "A", True), (2, "B", False), (3, "C", None), (5, "E", False), (6, "F", True)],
        "k int, v string, is_deleted boolean",
    )
    assert rows(apply_tombstones(target, staged, ["k"])) == [(2, "b"), (3, "c"), (4, "d")]
    assert rows(publish_with_deletes(target, staged, ["k"])) == [
        (2, "B"), (3, "c"), (4, "d"), (5, "E")
    ]
    target_ts = target.withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    staged_ts = staged.withColumn("ts", F.lit("2024-01-02").cast("timestamp_ntz"))
    captured = history_capture(target_ts, staged_ts, ["k"], "ts")
    assert rows(captured.select("k", "v", "is_current", "change_type")) == [
        (1, "a", False, "DELETE"), (2, "b", False, "UPDATE"), (3, "c", False, "UPDATE")
    ]
    both = full_history(captured, target_ts, "ts")
    assert both.count() == 7 and both.filter("is_current and valid_to is null").count() == 4


def test_history_with_a_repeated_staged_key(spark):
    target = spark.createDataFrame([(1, "a", 10)], "k int, v string, ts int")
    staged = spark.createDataFrame(
        [(1, "x", 11, False), (1, "y", 12, True)], "k int, v string, ts int, is_deleted boolean"
    )
    assert history_capture(target, staged, ["k"], "ts").count() == 2
    one = history_capture(target, staged, ["k"], "ts", staged_tiebreak=["v"])
    assert rows(one.select("k", "valid_from", "valid_to", "change_type")) == [(1, 10, 12, "DELETE")]


def test_difference_is_distinct_null_safe_and_by_name(spark):
    left = spark.createDataFrame([(1, 2), (1, 2), (None, 3), (4, 4)], "a int, b int")
    right = spark.createDataFrame([(2, 1), (3, None), (9, 9), (9, 9)], "b int, a int")
    assert rows(rows_only_left(left, right)) == [(4, 4)]
    assert rows(rows_only_right(left, right)) == [(9, 9)]
    assert rows(rows_only_left(left, right)) == rows(left.subtract(right.select("a", "b")))


def test_difference_refuses_other_columns(spark):
    with pytest.raises(ValueError, match="b"):
        two_way_difference(spark.range(1), spark.range(1).withColumn("b", F.lit(1)))


def apply_changes(old, diff, keys):
    gone = diff.filter(F.col("_change_type").isin("delete", "update_preimage"))
    come = diff.filter(F.col("_change_type").isin("insert", "update_postimage"))
    return without_keys(old, gone, keys, null_safe=True).unionByName(come.drop("_change_type"))


@pytest.mark.parametrize("staged", [False, True])
def test_snapshot_diff_turns_old_into_new(spark, staged):
    schema = "k string, v int"
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", None), (None, 4), ("e", 5)], schema)
    new = spark.createDataFrame([("a", 1), ("b", 3), ("c", 7), (None, 5), ("f", 6)], schema)
    diff = snapshot_diff(old, new, ["k"], Staging(spark) if staged else None)
    assert rows(apply_changes(old, diff, ["k"])) == rows(new)
    kinds = {(r.k, r.v): r._change_type for r in diff.collect()}
    assert kinds == {
        ("b", 2): "update_preimage", ("b", 3): "update_postimage",
        ("c", None): "update_preimage", ("c", 7): "update_postimage",
        (None, 4): "update_preimage", (None, 5): "update_postimage",
        ("e", 5): "delete", ("f", 6): "insert",
    }
    assert snapshot_diff(new, new, ["k"]).count() == 0


def test_row_hash_keeps_rows_apart(spark):
    df = spark.createDataFrame(
        [("a|b", "c"), ("a", "b|c"), (None, "-"), ("-", None), ("", None), (None, "")],
        "a string, b string",
    )
    assert df.select(row_hash(["a", "b"]).alias("h")).distinct().count() == 6


def test_default_code(spark):
    df = spark.createDataFrame([("7",), (None,)], "c string")
    assert sorted(r[0] for r in df.select(default_code(F.col("c"))).collect()) == ["7", "99999999"]


# type-2 history

HISTORY = "v string, hash_value string, data_inicio timestamp_ntz, data_fim timestamp_ntz, ativo boolean"
D1, D2, D3 = datetime(2023, 1, 1), datetime(2023, 2, 1), datetime(2023, 3, 1)


def history(spark):
    return spark.createDataFrame(
        [("a", "ha", D1, None, True), ("b", "hb", D1, None, True), ("b", "hb", D1, D2, False)],
        HISTORY,
    )


@pytest.mark.parametrize("staged", [False, True])
def test_scd2_ends_and_appends(spark, staged):
    current = spark.createDataFrame(
        [("a", "ha", D3, None, True), ("c", "hc", D3, None, True), ("c", "hc", D3, None, True)],
        HISTORY,
    )
    result = scd2.scd2_apply(history(spark), current, RUN, Staging(spark) if staged else None)
    assert rows(result) == sorted(
        [("a", "ha", D1, None, True), ("b", "hb", D1, RUN, False), ("b", "hb", D1, D2, False),
         ("c", "hc", D3, None, True)],
        key=repr,
    )
    again = scd2.scd2_apply(result, current, RUN)
    assert rows(again) == rows(result)


def test_scd2_adds_only_rows_with_an_active_status(spark):
    current = spark.createDataFrame(
        [("a", "ha", D3, None, True), ("b", "hb", D3, None, True), ("c", "hc", D3, D3, False)],
        HISTORY,
    )
    assert rows(scd2.scd2_apply(history(spark), current, RUN)) == rows(history(spark))


def test_scd2_counts(spark):
    current = spark.createDataFrame([("a", "ha", D3, None, True), ("c", "hc", D3, None, True)], HISTORY)
    assert tuple(scd2.change_counts(history(spark), current).first()) == (2, 2, 1, 1)
    empty = spark.createDataFrame([], HISTORY)
    assert tuple(scd2.change_counts(empty, empty).first()) == (0, 0, 0, 0)


def test_attach_status_does_not_multiply(spark):
    current = spark.createDataFrame(
        [("x", "h", D1, None, True), ("y", "h", D2, None, True), ("z", "h", D3, None, False)], HISTORY
    )
    inserts = current.select("v", "hash_value").filter("v = 'x'")
    assert rows(scd2.attach_status(inserts, current)) == [("h", "x", D2, None, True)]


def test_active_export(spark):
    assert rows(scd2.active_export(history(spark))) == [("a",), ("b",)]
    plain = spark.createDataFrame([("p", "h")], "v string, hash_value string")
    assert rows(scd2.active_export(plain)) == [("p",)]


# checks

def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, None), (None, "b")], "k int, v string")
    assert rows(quality.null_counts(df, ["k", "v"])) == [("k", 2), ("v", 2)]
    assert rows(quality.repeated_keys(df, ["k"])) == [(1, 2)]
    assert rows(quality.check_model(df, ["k"], ["k", "v"])) == [
        ("not_null", "k", 2), ("unique", "k", 1), ("unique", "v", 0)
    ]
    with pytest.raises(ValueError):
        quality.check_model(df)
    assert tuple(quality.profile_counts(df, ["k", "v"]).first()) == (4, 2, 2)
    assert rows(quality.top_rows(df.filter("v is not null"), [F.desc("v")], 1)) == [(None, "b")]


def test_reconcile(spark):
    left = spark.createDataFrame([(1, "a", 0.1), (2, "b", 0.2)], "k int, v string, noise double")
    right = spark.createDataFrame([("a", 1), ("c", 3)], "v string, k int")
    tagged = quality.reconcile(left, right, ignore=["noise"])
    assert rows(tagged.select("k", "v", "side")) == [(2, "b", "left"), (3, "c", "right")]
    assert tuple(quality.reconcile_counts(left, right, ["noise"]).first()) == (1, 1)
