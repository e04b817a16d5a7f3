"""Versions, catalog, staging and exports."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakeops.functions.columns import literal_timestamp
from lakeops.operators.changes import as_first_load
from lakeops.plans.versioned import (
    export_active,
    read_versioned,
    save_versioned,
)
from lakeops.sinks import tables
from lakeops.sinks.files import delete_path, folder_names, path_exists
from lakeops.sinks.staging import Staging, shared_folder
from lakeops.sources.registry import (
    SourceSpec,
    commit_versions,
    last_commit,
    open_changes,
    read_source,
    register_sources,
)


def test_versions_move_on_and_old_ones_stay(spark, root):
    assert tables.current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        tables.read_version(spark, root)
    assert tables.write_version(spark.range(3), root) == 0
    doubled = tables.read_version(spark, root).select((F.col("id") * 2).alias("id"))
    assert tables.write_version(doubled, root) == 1
    assert sorted(r.id for r in tables.read_version(spark, root).collect()) == [0, 2, 4]
    assert tables.read_version(spark, root, 0).count() == 3
    tables.drop_versions_before(spark, root, 1)
    assert folder_names(spark, root) == ["v=1"]
    for n in range(3):
        tables.write_version(spark.range(n), root, keep=2)
    assert sorted(folder_names(spark, root)) == ["v=3", "v=4"]


def test_an_unfinished_version_is_not_seen(spark, root):
    tables.write_version(spark.range(3), root)
    tables.write_version(spark.range(9), root)
    delete_path(spark, f"{root}/v=1/_SUCCESS")
    assert tables.read_version(spark, root).count() == 3
    assert tables.write_version(spark.range(5), root) == 1
    assert tables.read_version(spark, root).count() == 5


def test_compaction_writes_fewer_files(spark, root):
    tables.write_version(spark.range(0, 1000, 1, 8), root)
    before = len(tables.read_version(spark, root).inputFiles())
    tables.compact(spark, root)
    after = tables.read_version(spark, root)
    assert before == 8 and len(after.inputFiles()) == 1 and after.count() == 1000


def test_change_log_is_pruned_by_version_and_rewritten_by_commit(spark, root):
    base = spark.range(10).withColumn("_change_type", F.lit("insert"))
    stamped = base.withColumn("_commit_timestamp", literal_timestamp("2024-01-01 00:00:00"))
    for version in (0, 1, 1, 2):
        commit = stamped.withColumn("_commit_version", F.lit(version).cast("long"))
        tables.append_changes(commit, root, replace=True)
    with pytest.raises(ValueError, match=r"commits \[2\]"):
        tables.append_changes(commit, root)
    log = open_changes(spark, root, 1)
    assert log.count() == 20
    assert dict(log.dtypes)["_commit_version"] == "bigint"
    assert open_changes(spark, root, 0, 0).count() == 10
    assert len(log.inputFiles()) < len(open_changes(spark, root, 0).inputFiles())
    assert open_changes(spark, root, 7).count() == 0
    assert commit_versions(spark, root) == [0, 1, 2]
    assert last_commit(spark, root, 1) == 2 and last_commit(spark, root, 3) is None
    with pytest.raises(FileNotFoundError):
        open_changes(spark, f"{root}/missing", 0)
    plan = log._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "_commit_version" in filters and ">= 1" in filters


def test_catalog(spark, root):
    tables.write_version(spark.range(4), root)
    name = "catalog_db.registered"
    assert not tables.table_exists(spark, name)
    tables.register_table(spark, name, f"{root}/v=0")
    tables.register_table(spark, name, f"{root}/v=0")
    assert tables.table_exists(spark, name) and spark.table(name).count() == 4
    assert tables.table_property(spark, name, "feed.enabled") == "false"
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('feed.enabled' = 'true')")
    assert tables.table_property(spark, name, "feed.enabled") == "true"
    tables.write_version(spark.range(7), root)
    tables.point_table(spark, name, f"{root}/v=1")
    assert spark.table(name).count() == 7
    tables.drop_table(spark, name)
    assert not tables.table_exists(spark, name)
    tables.drop_database(spark, "catalog_db")
    assert tables.table_exists(spark, f"{root}/v=0") and not tables.table_exists(spark, f"{root}/v=9")


def test_other_failures_are_not_taken_for_a_missing_table(spark):
    with pytest.raises(Exception):
        tables.table_exists(spark, "nosuchscheme://bucket/table")


def test_full_rebuild_with_properties(spark):
    tables.write_table(spark.range(3), "rebuilt", {"feed.enabled": "true"})
    tables.write_table(spark.range(5), "rebuilt")
    assert spark.table("rebuilt").count() == 5


def test_bucketed_tables_join_without_a_shuffle(spark):
    data = spark.range(1000).withColumn("v", F.col("id") % 7)
    tables.write_bucketed(data, "bucketed_left", ["id"], 4, ["id"])
    tables.write_bucketed(data, "bucketed_right", ["id"], 4, ["id"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed_left").join(spark.table("bucketed_right"), "id", "left_anti")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert len(spark.table("bucketed_left").inputFiles()) <= 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_merge_is_refused_by_file_tables(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("merge_target")
    with pytest.raises(Exception, match="(?i)merge|support"):
        tables.merge_into(spark.range(2), "merge_target", ["id"])


def test_staging_counts_and_is_cleared(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    staging = Staging(spark)
    staged = staging(spark.range(12), "twelve")
    assert staging.rows == {"twelve": 12} and staged.count() == 12
    empty = staging(spark.range(0), "none")
    assert staging.rows["none"] == 0 and empty.count() == 0
    assert Staging(spark).path != staging.path
    staging.clear()
    assert not path_exists(spark, staging.path)
    with pytest.raises(ZeroDivisionError), Staging(spark) as failing:
        failing(spark.range(1), "one")
        1 / 0
    assert not path_exists(spark, failing.path)


def test_export_has_one_path_whatever_its_size_and_files(spark, root):
    for n, single in ((5000, False), (50_000, True), (10, False)):
        tables.export_parquet(spark.range(0, n, 1, 4), f"{root}/x", single_file=single)
        written = tables.read_export(spark, f"{root}/x")
        assert written.count() == n and folder_names(spark, root) == ["x"]
        assert not single or len(written.inputFiles()) == 1
    with pytest.raises(ZeroDivisionError):
        tables.export_parquet(failing(spark), f"{root}/x")
    assert tables.read_export(spark, f"{root}/x").count() == 10
    with pytest.raises(AnalysisException):
        tables.read_export(spark, f"{root}/missing")


def failing(spark):
    """A frame that cannot be made ready for a write."""
    class Frame:
        sparkSession = spark

        def hint(self, *_):
            return 1 / 0

    return Frame()


def test_sources_by_tenant(spark, root):
    spark.range(2).write.parquet(f"{root}/t1/orders")
    spark.range(5).write.parquet(f"{root}/t2/orders")
    spec = SourceSpec("tenant_orders", root + "/{tenant}/orders")
    assert read_source(spark, spec, "t1").count() == 2
    assert register_sources(spark, [spec], "t2") == ["tenant_orders"]
    assert spark.table("tenant_orders").count() == 5


def test_versioned_table_on_storage(spark, root):
    schema = "v string, hash_value string, data_inicio timestamp_ntz, data_fim timestamp_ntz, ativo boolean"
    now = literal_timestamp("2024-02-01 00:00:00")

    def load(*values):
        return spark.createDataFrame([(v, f"h{v}", None, None, True) for v in values], schema)

    table, log = f"{root}/table", f"{root}/log"
    assert save_versioned(spark, load("a", "b"), table, now, log) == 0
    assert open_changes(spark, log, 0).filter("_change_type = 'insert'").count() == 2
    assert save_versioned(spark, load("b", "c"), table, now) == 1
    result = read_versioned(spark, table)
    plan = result.filter("ativo")._jdf.queryExecution().executedPlan().toString()
    assert "ativo" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert sorted((r.v, r.ativo, r.data_fim is None) for r in result.collect()) == [
        ("a", False, False), ("b", True, True), ("c", True, True)
    ]
    path = export_active(spark, table, f"{root}/exports")
    assert path == f"{root}/exports/table"
    assert sorted(r.v for r in tables.read_export(spark, path).collect()) == ["b", "c"]
    assert tables.read_export(spark, path).columns == ["v"]
    assert export_active(spark, f"{root}/nothing", f"{root}/exports") is None
    assert as_first_load(result, now).filter("_commit_version = 0").count() == 3
