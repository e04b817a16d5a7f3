"""What the storage layer promises: nothing lost, nothing twice, small writes for small changes."""

import json
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeops.operators import scd2
from lakeops.operators.changes import CHANGE_TYPE, VERSION
from lakeops.plans import control, specs
from lakeops.plans.pipeline import Feed, run_pipeline
from lakeops.plans.publish import publish, publish_config, publish_versions, publish_with_history
from lakeops.plans.versioned import read_versioned, save_versioned
from lakeops.sinks import tables
from lakeops.sinks.files import delete_path, file_names, folder_names, path_bytes, path_exists
from lakeops.sinks.staging import Staging, application_folder
from lakeops.sources.registry import commit_versions, open_changes, register_sources

NOW = datetime(2024, 2, 1)
LOTS = replace(specs.DIM_LOTE, not_null=(), unique=())
FEED = "LOTE_INTERNO string, _change_type string, _commit_version long, _commit_timestamp timestamp"


def commit(spark, version, *changes):
    """(name, kind) changes of one commit."""
    rows = [(name, kind, version, datetime(2024, 1, 1 + version)) for name, kind in changes]
    return spark.createDataFrame(rows, FEED)


def run(spark, root, log="log", **options):
    feed = options.pop("feed", None) or Feed(f"{root}/{log}", ("LOTE_INTERNO",))
    return run_pipeline(spark, {specs.INVOICES: feed}, root, models=[LOTS], run_ts=NOW, **options)


def lots(spark, root):
    gold = tables.read_version(spark, f"{root}/default/gold/dim_lote")
    return sorted(r.LoteNumero for r in gold.collect())


def watermark(spark, root):
    return control.processed_upto(tables.read_version(spark, f"{root}/default/control"), specs.INVOICES)


# commits


def test_a_late_commit_is_still_read(spark, root):
    tables.append_changes(commit(spark, 0, ("a", "insert")), f"{root}/log")
    run(spark, root)
    tables.append_changes(commit(spark, 2, ("c", "insert")), f"{root}/log")
    assert run(spark, root) == [] and watermark(spark, root) == 0
    tables.append_changes(commit(spark, 1, ("b", "insert")), f"{root}/log")
    assert [r.rows for r in run(spark, root)] == [2]
    assert lots(spark, root) == ["a", "b", "c"] and watermark(spark, root) == 2


def test_a_commit_without_its_mark_is_not_there_yet(spark, root):
    tables.append_changes(commit(spark, 0, ("a", "insert")), f"{root}/log")
    tables.append_changes(commit(spark, 1, ("b", "insert")), f"{root}/log")
    delete_path(spark, f"{root}/log/_commits/1")
    run(spark, root)
    assert commit_versions(spark, f"{root}/log") == [0] and lots(spark, root) == ["a"]
    tables.mark_commits(spark, f"{root}/log", [1, 2])
    run(spark, root)
    assert lots(spark, root) == ["a", "b"] and watermark(spark, root) == 2


def test_idle_runs_write_nothing(spark, root):
    tables.append_changes(commit(spark, 0, ("a", "insert")), f"{root}/log")
    run(spark, root)
    before = folder_names(spark, f"{root}/default/gold/dim_lote"), folder_names(spark, f"{root}/default/control")
    assert run(spark, root) == [] and run(spark, root) == []
    after = folder_names(spark, f"{root}/default/gold/dim_lote"), folder_names(spark, f"{root}/default/control")
    assert before == after and watermark(spark, root) == 0


def test_a_commit_in_two_calls_is_refused(spark, root):
    tables.append_changes(commit(spark, 0, ("a", "insert")), f"{root}/log")
    with pytest.raises(ValueError, match="already"):
        tables.append_changes(commit(spark, 0, ("b", "insert")), f"{root}/log")
    tables.append_changes(commit(spark, 0, ("c", "insert")), f"{root}/log", replace=True)
    assert [r.LOTE_INTERNO for r in open_changes(spark, f"{root}/log", 0).collect()] == ["c"]


def test_columns_of_later_commits_are_read(spark, root):
    tables.append_changes(commit(spark, 0, ("a", "insert")), root)
    tables.append_changes(commit(spark, 1, ("b", "insert")).withColumn("extra", F.lit(7)), root)
    log = open_changes(spark, root, 0)
    assert {(r.LOTE_INTERNO, r.extra) for r in log.collect()} == {("a", None), ("b", 7)}
    declared = open_changes(spark, root, 0, schema=log.schema)
    assert declared.count() == 2 and "extra" in declared.columns


# tables


def test_all_versions_stay(spark, root):
    for n in range(4):
        tables.append_changes(commit(spark, n, (f"l{n}", "insert")), f"{root}/log")
        run(spark, root)
    gold = f"{root}/default/gold/dim_lote"
    assert sorted(folder_names(spark, gold)) == ["d=1", "d=2", "d=3", "v=0"]
    counts = [tables.read_version(spark, gold, n).count() for n in range(4)]
    assert counts == [1, 2, 3, 4]
    tables.compact(spark, gold)
    assert [tables.read_version(spark, gold, n).count() for n in range(4)] == counts
    tables.drop_versions_before(spark, gold, 3)
    assert sorted(folder_names(spark, gold)) == ["d=3", "v=3"]
    assert tables.read_version(spark, gold).count() == 4


@pytest.mark.parametrize("rows", [1_000, 200_000])
def test_bytes_written_follow_the_change(spark, root, rows):
    base = spark.range(rows).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    tables.write_version(base, root)
    small = base.filter("id < 20").withColumn("text", F.lit("new"))
    tables.write_changes(small, root, ["id"])
    assert path_bytes(spark, f"{root}/d=1") < 20_000
    now = tables.read_version(spark, root)
    assert now.count() == rows and now.filter("text = 'new'").count() == 20


def test_changes_lie_over_each_other_by_key(spark, root):
    def frame(*values):
        return spark.createDataFrame(values, "k int, p string, v string, _deleted boolean")

    with pytest.raises(ValueError):
        tables.write_changes(frame((1, "x", "a", False)), root, ["k"])
    tables.write_version(frame((1, "x", "a", False), (2, None, "b", False), (3, "z", "c", False)).drop("_deleted"), root)
    tables.write_changes(frame((1, "x", "a1", False), (2, None, "b1", False), (2, None, "b2", False)), root, ["k", "p"], True)
    tables.write_changes(frame((1, "x", "gone", True), (3, "z", "c3", False), (4, None, "d", False)), root, ["k", "p"], True)
    assert tables.changed_rows(spark, root, 0).count() == 5
    assert tables.changed_rows(spark, root, 2) is None or tables.changed_rows(spark, root, 2).count() == 0

    def values(version=None):
        return sorted(r.v for r in tables.read_version(spark, root, version).collect())

    expected = {0: ["a", "b", "c"], 1: ["a1", "b1", "b2", "c"], 2: ["b1", "b2", "c3", "d"]}
    assert {n: values(n) for n in expected} == expected
    assert tables.compact(spark, root) == 2 and {n: values(n) for n in expected} == expected
    tables.write_changes(frame((2, None, "b9", False)), root, ["k", "p"], True)
    assert values() == ["b9", "c3", "d"]


def test_one_writer_at_a_time(spark, root):
    tables.write_version(spark.range(1), root)
    with tables.one_writer(spark, root):
        with pytest.raises(tables.ConcurrentWriteError):
            tables.write_version(spark.range(2), root)
    assert tables.write_version(spark.range(2), root) == 1
    assert "_writing" not in file_names(spark, root)


def test_compaction_keeps_partitions(spark, root):
    rows = spark.range(100).select("id", (F.col("id") % 2 == 0).alias("ativo"))
    tables.write_version(rows, root, partition_by=["ativo"])
    assert tables.compact(spark, root) == 1
    assert sorted(folder_names(spark, f"{root}/v=1")) == ["ativo=false", "ativo=true"]
    assert tables.read_version(spark, root).filter(F.col("ativo").cast("boolean")).count() == 50


def test_scratch_lies_in_one_folder_of_the_application(spark):
    first, second = Staging(spark), Staging(spark)
    first(spark.range(1), "a")
    folder = application_folder(spark)
    assert first.path.rsplit("/", 1)[0] == second.path.rsplit("/", 1)[0] == folder
    assert spark.sparkContext.applicationId in folder and path_exists(spark, folder)


# first load


def test_first_load_from_the_table_has_no_deleted_rows(spark, root):
    """The log's oldest commits are gone; the table holds what they left."""
    spark.createDataFrame([("b",), ("c",), ("c",)], "LOTE_INTERNO string").write.parquet(f"{root}/silver")
    tables.append_changes(commit(spark, 6, ("c", "delete"), ("d", "insert")), f"{root}/log")
    feed = Feed(f"{root}/log", ("LOTE_INTERNO",), table=f"{root}/silver", table_commit=5)
    runs = run(spark, root, feed=feed, apply_deletes=True)
    assert [(r.mode, r.rows) for r in runs] == [("full", 2), ("incremental", 2)]
    assert lots(spark, root) == ["b", "d"] and watermark(spark, root) == 6
    assert run(spark, root, feed=feed) == []


def test_first_load_without_new_commits(spark, root):
    spark.createDataFrame([("b",)], "LOTE_INTERNO string").write.parquet(f"{root}/silver")
    feed = Feed(f"{root}/log", ("LOTE_INTERNO",), table=f"{root}/silver", table_commit=5)
    assert [r.mode for r in run(spark, root, feed=feed)] == ["full"] and watermark(spark, root) == 5
    tables.append_changes(commit(spark, 6, ("a", "insert")), f"{root}/log")
    run(spark, root, feed=feed)
    assert lots(spark, root) == ["a", "b"]


# publishing


STOCK = specs.PUBLISHED["fato_estoque"]


def stock(spark, *rows):
    schema = "EstoqueFilial string, EstoqueProduto string, EstoqueFabricante string, EstoqueSaldo double"
    return spark.createDataFrame(rows, schema).withColumn(specs.STAMP, F.lit(NOW))


def test_keys_with_null_parts_are_published_once(spark, root):
    publish(spark, STOCK, stock(spark, ("f", "p", None, 1.0), ("f", None, None, 2.0)), root)
    for n in range(2):
        publish(spark, STOCK, stock(spark, ("f", "p", None, 5.0 + n), ("f", None, None, 2.0)), root, inclusive=True)
    assert sorted(float(r.EstoqueSaldo) for r in tables.read_version(spark, root).collect()) == [2.0, 6.0]


def test_a_first_publish_takes_every_row(spark, root):
    old = stock(spark, ("a", "p", "m", 1.0)).withColumn(specs.STAMP, F.lit(datetime(1800, 1, 1)))
    none = stock(spark, ("b", "p", "m", 1.0)).withColumn(specs.STAMP, F.lit(None).cast("timestamp"))
    rows = stock(spark, ("c", "p", "m", 1.0)).unionByName(old).unionByName(none)
    assert publish(spark, STOCK, rows, root).rows == 3
    late = stock(spark, ("d", "p", "m", 1.0)).withColumn(specs.STAMP, F.lit(None).cast("timestamp"))
    assert publish(spark, STOCK, rows.unionByName(late), root).rows == 2
    assert sorted(r.EstoqueFilial for r in tables.read_version(spark, root).collect()) == ["a", "b", "c", "d"]


def test_deletes_and_late_stamps_reach_the_published_table(spark, root):
    spec, gold, target = specs.PUBLISHED["dim_lote"], f"{root}/default/gold/dim_lote", f"{root}/target"
    assert publish_versions(spark, spec, gold, target).status == "nothing new"
    for version, changes in enumerate(
        [[("a", "insert"), ("b", "insert")], [("a", "delete"), ("c", "insert")], [("b", "delete"), ("b", "insert"), ("d", "insert")]]
    ):
        rows = commit(spark, version, *changes[-2:])
        # commit times run backwards: no stamp could be the guide
        tables.append_changes(rows.withColumn("_commit_timestamp", F.lit(datetime(2020 - version, 1, 1))), f"{root}/log")
        run(spark, root, apply_deletes=True)
        publish_versions(spark, spec, gold, target)
        assert publish_versions(spark, spec, gold, target).status == "nothing new"
        published = sorted(r.LoteNumero for r in tables.read_version(spark, target).collect())
        assert published == lots(spark, root)
    assert folder_names(spark, target).count("d=2") == 1
    tables.write_version(tables.read_version(spark, gold).limit(0).unionByName(tables.read_version(spark, gold).limit(1)), gold)
    publish_versions(spark, spec, gold, target)
    assert tables.read_version(spark, target).count() == 1


def test_config_to_published_tables(spark, root):
    tables.append_changes(commit(spark, 0, ("a", "insert")), f"{root}/log")
    run(spark, root)
    spark.createDataFrame([("x" * 200, NOW)], "LoteNumero string, data_atualizacao timestamp").write.parquet(f"{root}/long")
    spark.createDataFrame([("y", NOW)], "LoteNumero string, data_atualizacao timestamp").write.parquet(f"{root}/plain")

    def entry(name, path, schema):
        return {
            "name": name, "gold_path": path, "redshift_table": "lote", "redshift_schema": schema,
            "primary_keys": ["LoteNumero"], "incremental_column": "data_atualizacao",
            "columns": {"LoteNumero": "VARCHAR(100)", "data_atualizacao": "TIMESTAMP"},
        }

    text = json.dumps({"tables": [
        entry("versions", "${ROOT}/default/gold/dim_lote", "one"), entry("too_long", "${ROOT}/long", "two"),
        entry("missing", "${ROOT}/nowhere", "three"), entry("plain", "${ROOT}/plain", "four"),
    ]})
    results = publish_config(spark, text, f"{root}/published", {"ROOT": root})
    assert [(r.name, r.status) for r in results] == [
        ("versions", "published"), ("too_long", "failed"), ("missing", "failed"), ("plain", "published")
    ]
    assert "VARCHAR(100)" in results[1].error
    for schema, name in (("one", "a"), ("four", "y")):
        assert tables.read_version(spark, f"{root}/published/{schema}/lote").first()[0] == name
    again = publish_config(spark, text, f"{root}/published", {"ROOT": root})
    assert [r.status for r in again] == ["nothing new", "failed", "failed", "nothing new"]


def test_orders_without_a_key_are_refused(spark, root):
    rows = spark.createDataFrame([(None, 1, False)], "pedido_id int, item_id int, is_deleted boolean")
    for name, text in specs.ORDER_COLUMNS.items():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(text.replace("VARCHAR(50)", "STRING")))
    with pytest.raises(Exception, match="pedido_id is NULL"):
        publish_with_history(spark, specs.FATO_PEDIDO, rows, f"{root}/t", f"{root}/h", ("status",))


def test_declared_sources(spark, root):
    for source in specs.silver_sources(root):
        spark.range(3).write.parquet(source.path("acme"))
    assert register_sources(spark, specs.silver_sources(root), "acme") == list(specs.SOURCES)
    assert spark.table(specs.STOCK).count() == 3


# type-2 tables


HISTORY = "v string, hash_value string, data_inicio timestamp_ntz, data_fim timestamp_ntz, ativo boolean"


def snapshot(spark, *values):
    return spark.createDataFrame([(v, f"h{v}", None, None, True) for v in values], HISTORY)


def test_the_feed_of_a_type2_table_goes_on(spark, root):
    table, log = f"{root}/table", f"{root}/log"
    states = [("a", "b"), ("b", "c"), ("b", "c"), ("a", "c", "d")]
    for n, values in enumerate(states):
        when = F.lit(datetime(2024, 3, 1 + n)).cast("timestamp_ntz")
        assert save_versioned(spark, snapshot(spark, *values), table, when, log) == n
    assert commit_versions(spark, log) == [0, 1, 2, 3]
    rows = {(r.v, r.data_fim): r.ativo for r in read_versioned(spark, table).collect()}
    # a row that came back is a new one beside the ended one
    assert sorted(v for (v, _), active in rows.items() if active) == ["a", "c", "d"]
    assert sorted(v for (v, _), active in rows.items() if not active) == ["a", "b"]
    feed = open_changes(spark, log, 0)
    images = feed.groupBy(VERSION, CHANGE_TYPE).count().collect()
    counts = {(r[0], r[1]): r[2] for r in images}
    assert counts == {
        (0, "insert"): 2, (1, "update_preimage"): 1, (1, "update_postimage"): 1, (1, "insert"): 1,
        (3, "update_preimage"): 1, (3, "update_postimage"): 1, (3, "insert"): 2,
    }
    assert [read_versioned(spark, table, n).filter("ativo").count() for n in range(4)] == [2, 2, 2, 3]


def test_ended_rows_are_never_written_again(spark, root):
    save_versioned(spark, snapshot(spark, "a", "b"), root, NOW)
    save_versioned(spark, snapshot(spark, "b"), root, NOW)
    before = spark.read.parquet(f"{root}/ended/c=1").inputFiles()
    save_versioned(spark, snapshot(spark, "c"), root, NOW)
    assert spark.read.parquet(f"{root}/ended/c=1").inputFiles() == before
    assert [r.v for r in spark.read.parquet(f"{root}/ended/c=1").collect()] == ["a"]
    assert read_versioned(spark, root).filter("not ativo").count() == 2


def test_unknown_columns_of_a_snapshot_are_refused(spark):
    history, current = snapshot(spark, "a"), snapshot(spark, "a").withColumn("new", F.lit(1))
    with pytest.raises(ValueError, match="new"):
        scd2.scd2_apply(history, current)


# hand-stated names, so that a wrong rename does not hide in its own oracle


@pytest.mark.parametrize(
    "model,gold,silver",
    [
        ("fato_faturamento", "FaturamentoChaveNF", "CHAVE_NFE"),
        ("fato_faturamento", "FaturamentoValorItem", "VALOR_LIQUIDO"),
        ("fato_faturamento", "FaturamentoCFOP", "COD_CFOP"),
        ("fato_faturamento", "FaturamentoOperacao", "COD_CFOP"),
        ("fato_estoque", "EstoqueFilial", "COD_FILIAL"),
        ("fato_estoque", "EstoqueProduto", "COD_PRODUTO"),
        ("fato_estoque", "EstoqueFabricante", "COD_FABRICANTE"),
        ("dim_cliente", "ClienteCPFCNPJ", "CPF_CNPJ_CLIFOR"),
        ("dim_cliente", "ClienteDescricao", "NOME_CLIEFOR"),
        ("dim_vendedor", "VendedorCodigo", "COD_VENDEDOR"),
        ("dim_vendedor", "VendedorCPF", "CPF_VENDEDOR"),
        ("dim_produto", "ProdutoCodigo", "COD_PRODUTO"),
        ("dim_produto", "ProdutoDescricao", "DESC_PRODUTO"),
        ("dim_lote", "LoteNumero", "LOTE_INTERNO"),
        ("dim_tratamento_semente", "TratamentoSementeCodigo", "COD_TRATAMENTO"),
        ("dim_filial", "FilialCodigo", "COD_FILIAL"),
        ("dim_filial", "FilialCNPJ", "CNPJ"),
    ],
)
def test_gold_names_come_from_these_silver_names(model, gold, silver):
    assert specs.MODELS[model].columns[gold] == silver


@pytest.mark.parametrize(
    "model,keys",
    [
        ("fato_faturamento", "FaturamentoChaveNF"),
        ("fato_estoque", "EstoqueFilial EstoqueProduto EstoqueFabricante"),
        ("dim_cliente", "ClienteCPFCNPJ"),
        ("dim_vendedor", "VendedorCodigo"),
        ("dim_produto", "ProdutoCodigo"),
        ("dim_lote", "LoteNumero"),
        ("dim_tratamento_semente", "TratamentoSementeCodigo"),
        ("dim_filial", "FilialCodigo"),
    ],
)
def test_models_have_these_keys(model, keys):
    assert specs.MODELS[model].keys == tuple(keys.split())
