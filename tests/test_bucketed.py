"""Bucketed merges, bounds from footers, tables published at a time."""

import os
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lakeops.operators.bucketed import KEY_HASH, history_bucketed, upsert_bucketed, without_hash, write_keyed
from lakeops.operators.file_bounds import file_bounds, pushed_bounds
from lakeops.operators.history import history_capture
from lakeops.operators.merge import upsert
from lakeops.plans.concurrent import publish_together
from lakeops.plans.specs import PublishSpec
from lakeops.sinks.tables import read_version

SCHEMA = "a int, b string, t long, is_deleted boolean"


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def keyed(spark, root):
    made = []

    def write(df, name, buckets=4):
        made.append(name)
        return write_keyed(df, name, ["a", "b"], buckets, f"{root}/{name}")

    yield write
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


OLD = [(1, "x", 1, False), (2, None, 1, False), (None, "y", 1, False), (None, None, 1, False), (4, "z", 1, None)]
NEW = [(1, "x", 2, True), (2, None, 2, False), (None, "y", 2, None), (5, "n", 2, False), (None, "2", 2, False)]


@pytest.mark.parametrize("null_safe", [True, False])
def test_bucketed_upsert_is_the_upsert(spark, keyed, null_safe):
    old, new = spark.createDataFrame(OLD, SCHEMA), spark.createDataFrame(NEW, SCHEMA)
    target, staged = keyed(old, "up_old"), keyed(new, "up_new")
    got = upsert_bucketed(target, staged, ["a", "b"], null_safe)
    assert rows(without_hash(got)) == rows(upsert(old, new, ["a", "b"], null_safe))
    assert "Exchange" not in plan(got) and "SortMergeJoin" in plan(got)
    for kept, none in ((old, new.limit(0)), (old.limit(0), new)):
        sides = keyed(kept, f"up_{kept.count()}_k{null_safe}"), keyed(none, f"up_{none.count()}_n{null_safe}")
        assert rows(without_hash(upsert_bucketed(*sides, ["a", "b"], null_safe))) == rows(kept.union(none))


def test_next_version_is_written_without_a_shuffle(spark, keyed):
    target = keyed(spark.createDataFrame(OLD, SCHEMA), "next_old")
    staged = keyed(spark.createDataFrame(NEW, SCHEMA), "next_new")
    got = upsert_bucketed(target, staged, ["a", "b"], True)
    assert "Exchange" not in plan(got.repartition(4, KEY_HASH))
    again = keyed(got, "next_out")
    assert rows(again) == rows(got) and rows(upsert_bucketed(again, staged, ["a", "b"], True)) == rows(again)


def test_bucketed_history_is_the_history(spark, keyed):
    old, new = spark.createDataFrame(OLD, SCHEMA), spark.createDataFrame(NEW + NEW[:1], SCHEMA)
    got = history_bucketed(keyed(old, "h_old"), keyed(new, "h_new"), ["a", "b"], "t")
    assert rows(got) == rows(history_capture(old, new, ["a", "b"], "t"))
    assert "Exchange" not in plan(got)


def test_bounds_come_from_footers(spark, root):
    spark.range(0, 1000, 1, 4).selectExpr("id as k", "if(id % 2 = 0, cast(id as int), null) as v").write.parquet(f"{root}/t")
    pushed = plan(pushed_bounds(spark, f"{root}/t", ["k", "v"]))
    assert "PushedAggregation: [COUNT(*)" in pushed and "MAX(v)" in pushed
    assert file_bounds(spark, f"{root}/t", ["k", "v"]).first() == (1000, 1000, 0, 999, 500, 0, 998)


def test_bounds_without_values_files_and_types(spark, root):
    spark.range(10).selectExpr("id as k", "cast(null as int) as v").write.parquet(f"{root}/t")
    spark.range(3).selectExpr("id as k", "cast(id as int) as v").write.mode("append").parquet(f"{root}/t")
    assert file_bounds(spark, f"{root}/t", ["v"]).first() == (13, 3, 0, 2)
    spark.range(0).selectExpr("id as k", "cast(id as int) as v").write.parquet(f"{root}/e")
    assert file_bounds(spark, f"{root}/e", ["k", "v"]).first() == (0, 0, None, None, 0, None, None)
    mixed = "SELECT * FROM VALUES (double('nan'), 'b'), (1D, NULL) AS t(d, s)"
    spark.sql(mixed).write.parquet(f"{root}/m")
    assert str(file_bounds(spark, f"{root}/m", ["d", "s"]).first()[:]) == "(2, 2, 1.0, nan, 1, 'b', 'b')"


SPEC = PublishSpec("one", "one", ("k",), {"k": "BIGINT", "t": "BIGINT"}, "t")


def waiting(spark, folder, mine, other):
    """Rows that come once the other table's task is under way too."""

    def wait(batches):
        open(f"{folder}/{mine}", "w").close()
        end = time.time() + 60
        while not os.path.exists(f"{folder}/{other}"):
            if time.time() > end:
                raise RuntimeError("alone")
            time.sleep(0.05)
        yield from batches

    return spark.range(0, 5, 1, 1).selectExpr("id as k", "id as t").mapInPandas(wait, "k long, t long")


def test_tables_are_published_side_by_side(spark, root, tmp_path):
    jobs = [
        (replace(SPEC, name=mine), waiting(spark, str(tmp_path), mine, other), f"{root}/out/{mine}")
        for mine, other in (("a", "b"), ("b", "a"))
    ]
    assert [(r.name, r.rows, r.status) for r in publish_together(spark, jobs, 2)] == [
        ("a", 5, "published"),
        ("b", 5, "published"),
    ]


def test_a_failing_table_leaves_the_others(spark, root):
    good = spark.range(5).selectExpr("id as k", "id as t")
    bad = good.withColumn("t", F.raise_error(F.lit("broken")).cast("long"))
    jobs = [(replace(SPEC, name=n), df, f"{root}/{n}") for n, df in (("a", good), ("b", bad), ("c", good))]
    results = publish_together(spark, jobs, 3)
    assert [(r.name, r.status) for r in results] == [("a", "published"), ("b", "failed"), ("c", "published")]
    assert "broken" in results[1].error
    assert all(read_version(spark, f"{root}/{n}").count() == 5 for n in "ac")
    assert publish_together(spark, []) == []
    with pytest.raises(ValueError, match="once at a time"):
        publish_together(spark, [jobs[0], jobs[0]])
