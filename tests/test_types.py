import pytest
from pyspark.errors import ArithmeticException, NumberFormatException
from pyspark.sql import types as T

from lakeops.functions.types import (
    cast_columns,
    create_staging_sql,
    create_table_sql,
    declared_schema,
    parse_type,
)
from lakeops.plans import specs
from lakeops.session import shuffle_partitions_for


@pytest.mark.parametrize("text, expected", [
    ("DECIMAL(18,2)", T.DecimalType(18, 2)),
    ("decimal(10, 4)", T.DecimalType(10, 4)),
    ("DECIMAL(12)", T.DecimalType(12, 0)),
    ("DECIMAL", T.DecimalType(18, 4)),
    ("VARCHAR(50)", T.StringType()),
    ("DATE", T.DateType()),
    ("TIMESTAMP", T.TimestampType()),
    ("int", T.IntegerType()),
    ("BIGINT", T.LongType()),
    ("BOOLEAN", T.BooleanType()),
    ("GEOMETRY", None),
])
def test_parse_type(text, expected):
    assert parse_type(text) == expected


def test_cast_keeps_declared_columns_in_order(spark):
    df = spark.createDataFrame([(1, "2.345", "x", "2024-01-02")], "n int, d string, extra string, day string")
    out = cast_columns(df, {"day": "DATE", "d": "DECIMAL(10,2)", "n": "VARCHAR(5)", "extra": "GEOMETRY"})
    assert out.dtypes == [("day", "date"), ("d", "decimal(10,2)"), ("n", "string"), ("extra", "string")]
    assert str(out.first().d) == "2.35"


def test_cast_errors(spark):
    df = spark.createDataFrame([("abc", "99999999999")], "a string, b string")
    bad = {"a": "DECIMAL(10,2)", "b": "INT"}
    with pytest.raises((NumberFormatException, ArithmeticException)):
        cast_columns(df, bad).collect()
    assert tuple(cast_columns(df, bad, on_error="null").first()) == (None, None)
    with pytest.raises(ValueError):
        cast_columns(df, bad, on_error="skip")


def test_declared_schema_refuses_unknown_types():
    assert declared_schema({"a": "INT"}) == T.StructType([T.StructField("a", T.IntegerType())])
    with pytest.raises(ValueError, match="GEOMETRY"):
        declared_schema({"a": "GEOMETRY"})


@pytest.mark.parametrize("name", list(specs.PUBLISHED))
def test_published_columns_match_the_model(name):
    model, target = specs.MODELS[name], specs.PUBLISHED[name]
    assert list(target.columns) == [*model.columns, specs.STAMP]
    assert target.keys == model.keys


def test_ddl_runs(spark):
    table = "ddl_orders"
    ddl = create_table_sql(
        table, specs.ORDER_COLUMNS, specs.ORDER_KEYS, specs.ORDER_CLUSTER, specs.ORDER_SORT, 4
    )
    spark.sql(ddl)
    spark.sql(ddl)
    spark.sql(create_staging_sql(table, {**specs.ORDER_COLUMNS, "is_deleted": "BOOLEAN"}))
    assert spark.table(table).schema.names == list(specs.ORDER_COLUMNS)
    assert spark.table(f"{table}_staging").schema["is_deleted"].dataType == T.BooleanType()
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    assert described["Num Buckets"] == "4"
    assert described["Bucket Columns"] == "[`pedido_id`]"
    assert described["Sort Columns"] == "[`data_pedido`, `dt_atualizacao`]"
    spark.sql(create_table_sql("ddl_hist", specs.ORDER_HISTORY_COLUMNS, (), ("pedido_id",), specs.ORDER_HISTORY_SORT, 2))
    with pytest.raises(ValueError):
        create_table_sql("x", {"a": "INT"}, cluster_by=["a"])


def test_varchar_length_is_checked_on_write(spark):
    spark.sql(create_table_sql("ddl_short", {"a": "VARCHAR(3)"}))
    with pytest.raises(Exception, match="(?i)limit|length"):
        spark.sql("INSERT INTO ddl_short VALUES ('toolong')")


def test_shuffle_partitions_grow_with_the_input():
    assert shuffle_partitions_for(0) == 200
    assert shuffle_partitions_for(2**40) == 8192
    # 100 TB: larger partitions rather than 800,000 of them
    assert shuffle_partitions_for(100 * 2**40) == 90510
    sizes = [shuffle_partitions_for(n * 2**38) for n in range(1, 400)]
    assert sizes == sorted(sizes)
