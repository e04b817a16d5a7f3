"""Plans whose memory and shuffle grow with the input alone."""

import pytest

from lakeops import fixtures as fx
from lakeops.catalog.queries import queries
from lakeops.operators.changed_checks import repeated_changed_keys
from lakeops.plans.specs import FATO_FATURAMENTO
from lakeops.sinks.tables import append_changes
from lakeops.sources.registry import open_changes


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_long_list_of_changed_keys_meets_counts_not_rows(spark, root):
    spark.range(3000).selectExpr("nullif(id % 2000, 7) as k").write.parquet(f"{root}/old")
    spark.range(1500, 2500).selectExpr("nullif(id, 1600) as k").write.parquet(f"{root}/new")
    old, new = spark.read.parquet(f"{root}/old"), spark.read.parquet(f"{root}/new")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = repeated_changed_keys(old.union(new), new, "k")
        # one join, of counts: joined row by row, each part of the table is sorted with the list
        assert plan(found).count("SortMergeJoin") == 1
        assert rows(found) == [(k, 2) for k in range(1500, 2000) if k != 1600]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


ITEM_QUERIES = ["full_history", "history_capture", "publish_with_deletes", "delete_insert", "apply_tombstones"]


@pytest.mark.parametrize("name", ITEM_QUERIES)
def test_items_are_made_once_for_both_sides(name, spark, sf_dir):
    df = queries()[name](spark, sf_dir)
    text = plan(df)
    assert "lineitem" not in text and "orders" not in text
    assert all("-items/" in file for file in df.inputFiles())


def test_a_log_of_few_commits_is_written_without_a_shuffle(spark, root):
    rows_in = spark.range(0, 4000, numPartitions=4).selectExpr("id", "id % 3 as _commit_version")
    append_changes(rows_in, f"{root}/log", versions=[0, 1, 2], spread=False)
    log = open_changes(spark, f"{root}/log", 0)
    # one file a task and commit; spread rows come as one file a commit here
    assert len(log.inputFiles()) == 12
    assert rows(log.select("id", "_commit_version")) == sorted(((i, i % 3) for i in range(4000)), key=repr)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_customers_join_the_orders(spark, sf_dir):
    text = plan(fx.invoice_feed(spark, sf_dir, FATO_FATURAMENTO.source_columns)).split("Initial Plan")[0]
    above, below = text.split("lineitem.parquet")[0], text.split("lineitem.parquet")[1]
    assert "o_custkey" not in "".join(x for x in above.splitlines() if "Join" in x)
    assert "customer.parquet" in below.split("part.parquet")[0]
