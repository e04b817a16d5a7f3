"""Checks, reconciliation, loads and runs whose cost follows what changed."""

import re

import pytest
from pyspark.sql import functions as F

from lakeops import fixtures as fx
from lakeops.operators.changed_checks import check_changed, observe_nulls, observed_failures, repeated_changed_keys
from lakeops.operators.changes import VERSION
from lakeops.operators.hashtree import differing_leaves, leaf_sums, reconcile_by_tree
from lakeops.operators.quality import reconcile
from lakeops.operators.rejects import TooManyRejects, load_with_rejects
from lakeops.plans import control
from lakeops.plans.models import gold_increment
from lakeops.plans.pipeline import Feed, run_pipeline
from lakeops.plans.specs import FATO_FATURAMENTO, INVOICES, MODELS
from lakeops.plans.sql_feeds import create_feed_function, increment_sql
from lakeops.sinks.staging import Staging
from lakeops.sinks.tables import append_changes, read_version
from lakeops.sources.registry import open_changes, read_changes


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def schemas(text):
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


# checks


def test_only_changed_rows_and_keys_are_tested(spark):
    base = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (3, "c"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (4, None), (4, "y"), (None, "z"), (5, "q")], "k int, v string")
    seen, counted = observe_nulls(new, ["k", "v"])
    written = Staging(spark)(seen, "new")
    nulls = observed_failures(written, counted, ["k", "v"])
    got = rows(check_changed(base.union(written), written, ["k"], nulls))
    # 3 is repeated too, but nobody changed it
    assert got == [("not_null", "k", 1), ("not_null", "v", 1), ("unique", "k", 2)]
    none, counted = observe_nulls(new.limit(0), ["k"])
    empty = Staging(spark)(none, "none")
    assert rows(check_changed(base, empty, ["k"], observed_failures(empty, counted, ["k"]))) == [
        ("not_null", "k", 0),
        ("unique", "k", 0),
    ]


def test_a_table_is_read_for_its_key_alone(spark, root):
    spark.range(5000).selectExpr("id % 4000 as k", "id as a", "uuid() as b").write.parquet(f"{root}/table")
    spark.range(10).selectExpr("id as k", "id as a", "'x' as b").write.parquet(f"{root}/new")
    table, new = spark.read.parquet(f"{root}/table"), spark.read.parquet(f"{root}/new")
    found = repeated_changed_keys(table, new, "k")
    assert set(schemas(plan(found))) == {"k:bigint"}
    assert "BroadcastHashJoin" in plan(found) and found.count() == 10
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert set(schemas(plan(repeated_changed_keys(table, new, "k")))) == {"k:bigint"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# hash tree


def test_tree_gives_the_rows_of_a_full_comparison(spark):
    left = spark.range(3000).selectExpr("id", "if(id % 50 = 0, null, id % 7) as v", "cast(id as string) as s")
    kinds = "id long, v long, s string"
    left = left.union(spark.createDataFrame([(None, 1, "null key"), (5, 5, "twice"), (5, 5, "twice")], kinds))
    changed = left.withColumn("v", F.when(F.col("id") == 77, 100).otherwise(F.col("v"))).filter("id is null or id <> 78")
    changed = changed.union(spark.createDataFrame([(9999, 1, "new"), (12, None, "12")], kinds))
    for right in (changed, left, left.distinct(), left.limit(0)):
        for leaves in (1, 300, 1 << 16) if right is changed else (300,):
            got = reconcile_by_tree(left, right, ["id"], Staging(spark), leaves=leaves)
            assert rows(got) == rows(reconcile(left, right))
    assert reconcile_by_tree(left.limit(0), left.limit(0), ["id"], Staging(spark)).count() == 0
    assert rows(reconcile_by_tree(left, changed, ["id"], Staging(spark), ignore=["v"])) == rows(
        reconcile(left, changed, ignore=["v"])
    )


def test_equal_tables_are_summed_and_not_compared(spark):
    left = spark.range(2000).selectExpr("id", "id % 7 as v")
    stage = Staging(spark)
    out = reconcile_by_tree(left, left.repartition(5), ["id"], stage)
    assert stage.rows["left_sums"] <= 2000 and stage.rows["leaves"] == 0
    assert "Range" not in plan(out) and out.count() == 0


def test_few_changes_leave_few_leaves(spark):
    left = spark.range(20000).selectExpr("id", "id % 7 as v")
    right = left.withColumn("v", F.when(F.col("id") < 3, -1).otherwise(F.col("v")))
    sums = [Staging(spark)(leaf_sums(df, ["id"]), "s") for df in (left, right)]
    assert 1 <= differing_leaves(*sums).count() <= 3


# loads with rejects

DECLARED = {"id": "BIGINT", "amount": "DECIMAL(6,2)", "name": "VARCHAR(3)", "day": "DATE", "flag": "BOOLEAN"}


def test_values_that_do_not_fit_are_told_apart(spark):
    given = [
        ("1", "12.34", "abc", "2024-02-29", "true"),
        ("x", "12.34", "abcd", "2024-02-30", "maybe"),
        (None, "99999.99", "abc", None, None),
        ("2", None, None, None, None),
        ("2", None, None, None, None),
    ]
    df = spark.createDataFrame(given, "id string, amount string, name string, day string, flag string")
    load = load_with_rejects(df.withColumn("other", F.lit(1)), DECLARED, Staging(spark), ["id"])
    assert (load.loaded, load.rejected) == (3, 2)
    assert [f.dataType.simpleString() for f in load.rows.schema] == ["bigint", "decimal(6,2)", "string", "date", "boolean"]
    assert sorted((r.id, r.name) for r in load.rows.collect() if r.name) == [(1, "abc")]
    assert rows(load.rejects) == sorted(
        [
            ("x", "id", "not BIGINT", "x"),
            ("x", "name", "longer than 3", "abcd"),
            ("x", "day", "not DATE", "2024-02-30"),
            ("x", "flag", "not BOOLEAN", "maybe"),
            (None, "id", "key is null", None),
            (None, "amount", "not DECIMAL(6,2)", "99999.99"),
        ],
        key=repr,
    )


def test_a_limit_fails_the_load(spark):
    df = spark.createDataFrame([("1",), ("x",), ("y",)], "id string")
    with pytest.raises(TooManyRejects, match="2 rows"):
        load_with_rejects(df, {"id": "BIGINT"}, Staging(spark), limit=1)
    assert load_with_rejects(df, {"id": "BIGINT"}, Staging(spark), limit=2).rows.count() == 1
    empty = load_with_rejects(df.limit(0), {"id": "BIGINT"}, Staging(spark), limit=0)
    assert (empty.loaded, empty.rejected, empty.rows.count()) == (0, 0, 0)


# feeds in SQL


@pytest.fixture(scope="module")
def log(spark, sf_dir, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('feed')}/log"
    feed = fx.invoice_feed(spark, sf_dir)
    append_changes(feed, path, versions=list(range(7)))
    return path


def test_a_sql_feed_is_pruned(spark, log):
    function = create_feed_function(spark, "changes_of_log", open_changes(spark, log, 0))
    spec = MODELS["dim_cliente"]
    df = spark.sql(increment_sql(spec, function, "5", fx.INVOICE_TIEBREAK))
    text = plan(df)
    assert re.search(r"PartitionFilters: \[[^\]]*_commit_version[^\]]*>= 5", text) and "Python" not in text
    (schema,) = set(schemas(text))
    assert "NOME_CLIEFOR" in schema and "VALOR_TOTAL" not in schema
    feed = read_changes(open_changes(spark, log, 0), 5)
    assert rows(df) == rows(gold_increment(spec, feed, fx.INVOICE_TIEBREAK))
    assert spark.sql(f"SELECT * FROM {function}(NULL)").count() == 0


def test_the_watermark_is_a_subquery_that_prunes(spark, log):
    feed = open_changes(spark, log, 0)
    table = control.watermark_seed(spark, [INVOICES], fx.run_time()).withColumn(control.LAST, F.lit(4).cast("long"))
    table = Staging(spark)(table, "control")
    since = control.since_watermark(feed, table, INVOICES)
    assert re.search(r"PartitionFilters: \[[^\]]*ubquery", plan(since))
    assert {r[0] for r in since.select(VERSION).distinct().collect()} == {5, 6}
    nothing = control.since_watermark(feed, table.limit(0), INVOICES)
    assert nothing.count() == feed.count()


def test_a_first_run_waits_for_the_declared_first_commit(spark, sf_dir, root):
    feed = fx.invoice_feed(spark, sf_dir, FATO_FATURAMENTO.source_columns)
    source = {INVOICES: Feed(f"{root}/log", fx.INVOICE_TIEBREAK, first_commit=0)}
    models = [FATO_FATURAMENTO]
    append_changes(read_changes(feed, 1, 2), source[INVOICES].log, versions=[1, 2])
    assert run_pipeline(spark, source, root, models=models, checks=False) == []
    append_changes(read_changes(feed, 0, 0), source[INVOICES].log, versions=[0])
    (run,) = run_pipeline(spark, source, root, models=models, checks=False)
    gold = read_version(spark, f"{root}/default/gold/{FATO_FATURAMENTO.name}")
    expected = gold_increment(FATO_FATURAMENTO, read_changes(feed, 0, 2), fx.INVOICE_TIEBREAK)
    assert run.rows == gold.count() and rows(gold.drop("data_atualizacao")) == rows(expected.drop("data_atualizacao"))


def test_columns_of_earlier_changes_stay(spark, root):
    from lakeops.sinks.tables import write_changes, write_version

    write_version(spark.createDataFrame([(1, "a")], "k int, v string"), root)
    write_changes(spark.createDataFrame([(2, "b", 7)], "k int, v string, w int"), root, ["k"])
    write_changes(spark.createDataFrame([(3, "c")], "k int, v string"), root, ["k"])
    got = read_version(spark, root)
    assert rows(got.select("k", "v", "w")) == sorted([(1, "a", None), (2, "b", 7), (3, "c", None)], key=repr)
