"""Views of the test tables shaped like the library's inputs (see FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.columns import literal_timestamp, row_hash
from lakeops.operators.changes import (
    CHANGE_TYPE,
    COMMIT_TIME,
    DELETE,
    INSERT,
    POSTIMAGE,
    PREIMAGE,
    VERSION,
)
from lakeops.operators.scd2 import ACTIVE, END, HASH, START

RUN_TIME = "2024-02-01 00:00:00"
SPLIT_VERSION = 3

INVOICE_TIEBREAK = ("NR_NF", "NR_ITEM", "COD_PRODUTO", "COD_VENDEDOR", "VALOR_LIQUIDO")
STOCK_TIEBREAK = ("NR_NF", "NR_ITEM", "COD_VENDEDOR", "VALOR_LIQUIDO")
BRANCH_TIEBREAK = ("DESC_FILIAL",)
EVENT_TIEBREAK = ("event_id",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_time() -> Column:
    return literal_timestamp(RUN_TIME)


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _invoice_columns() -> dict[str, tuple[Column, tuple[str, ...]]]:
    """Silver column -> its expression and the tables it needs besides lineitem."""
    return {
        "CHAVE_NFE": (
            F.when((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R"), None).otherwise(
                _text("l_orderkey")
            ),
            (),
        ),
        "NR_ITEM": (F.col("l_linenumber"), ()),
        "COD_FILIAL": (_text("s_nationkey"), ("supplier",)),
        "COD_FABRICANTE": (F.col("p_brand"), ("part",)),
        "NR_NF": (_text("l_orderkey"), ()),
        "SERIE_NF": (F.col("o_orderstatus"), ("orders",)),
        "CPF_CNPJ_CLIFOR": (_text("o_custkey"), ("orders",)),
        "NOME_CLIEFOR": (F.col("c_name"), ("orders", "customer")),
        "COD_CFOP": (F.col("o_orderpriority"), ("orders",)),
        "DATA_EMISSAO": (F.col("o_orderdate").cast("date"), ("orders",)),
        "COD_PRODUTO": (_text("l_partkey"), ()),
        "DESC_PRODUTO": (F.col("p_name"), ("part",)),
        "DESC_PRODUTO_PAI": (F.col("p_type"), ("part",)),
        "COD_IBGE": (_text("c_nationkey"), ("orders", "customer")),
        "COD_VENDEDOR": (_text("l_suppkey"), ()),
        "NOME_VENDEDOR": (F.col("s_name"), ("supplier",)),
        "CPF_VENDEDOR": (_text("s_nationkey"), ("supplier",)),
        "VALOR_LIQUIDO": (F.col("l_extendedprice"), ()),
        "QUANTIDADE_LT_KG": (F.col("l_quantity"), ()),
        "VALOR_TOTAL": (F.col("o_totalprice"), ("orders",)),
        "TIPO_NF": (F.col("l_returnflag"), ()),
        "UNIDADE_MEDIDA": (F.col("l_linestatus"), ()),
        "FATOR_CONVERSAO": (F.col("l_tax"), ()),
        "LOTE_INTERNO": (
            F.when(F.col("l_linenumber") == 6, None).otherwise(
                F.concat("p_brand", F.lit("-"), _text("p_size"), F.lit("-"), "l_linestatus")
            ),
            ("part",),
        ),
        "COD_TRATAMENTO": (F.nullif("l_returnflag", F.lit("N")), ()),
        "PESO_KG_SEMENTE": (F.col("l_quantity"), ()),
    }


_JOINS = {
    "orders": ("l_orderkey", "o_orderkey"),
    "part": ("l_partkey", "p_partkey"),
    "supplier": ("l_suppkey", "s_suppkey"),
}


def _lines(spark: SparkSession, sf_dir: str, needed: Iterable[str]) -> DataFrame:
    """lineitem with the needed tables joined.

    The joined tables are unique on their key and joined from the left, so leaving
    one out that no asked-for column needs never changes the rows. Customers join the
    orders, which are fewer than the lines: where customers are too many to broadcast,
    the lines are not shuffled by customer.
    """
    lines = table(spark, sf_dir, "lineitem")
    for name, (left, right) in _JOINS.items():
        if name in needed:
            other = table(spark, sf_dir, name)
            if name == "orders" and "customer" in needed:
                customer = table(spark, sf_dir, "customer")
                other = other.join(customer, other["o_custkey"] == customer["c_custkey"], "left")
            lines = lines.join(other, lines[left] == other[right], "left")
    return lines


def _change_columns() -> list[Column]:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    kind = (
        F.when((flag == "R") & (status == "F"), DELETE)
        .when((flag == "N") & (status == "F"), PREIMAGE)
        .when(flag.isin("A", "R") & (status == "O"), POSTIMAGE)
        .otherwise(INSERT)
    )
    return [
        kind.alias(CHANGE_TYPE),
        (F.year("l_shipdate") - 1995).cast("long").alias(VERSION),
        F.col("l_shipdate").alias(COMMIT_TIME),
    ]


def _pick(columns: Iterable[str] | None) -> tuple[list[Column], set[str]]:
    known = _invoice_columns()
    names = list(known if columns is None else dict.fromkeys(columns))
    needed = {t for name in names for t in known[name][1]}
    return [known[name][0].alias(name) for name in names], needed


def silver_invoices(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None
) -> DataFrame:
    """Invoice items; all columns, or only the ones asked for."""
    picked, needed = _pick(columns)
    return _lines(spark, sf_dir, needed).select(*picked)


def invoice_feed(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None
) -> DataFrame:
    """Change feed of the invoices: one commit per ship year."""
    if columns is not None:
        columns = [*columns, *INVOICE_TIEBREAK]
    picked, needed = _pick(columns)
    return _lines(spark, sf_dir, needed).select(*picked, *_change_columns())


def _stock_columns() -> list[Column]:
    return [
        _text("s_nationkey").alias("COD_FILIAL"),
        _text("l_partkey").alias("COD_PRODUTO"),
        F.when(F.col("p_size") <= 3, None).otherwise(F.col("p_brand")).alias("COD_FABRICANTE"),
        F.col("l_quantity").alias("QTDE_SALDO_EMBALAGEM"),
        _text("l_orderkey").alias("NR_NF"),
        F.col("l_linenumber").alias("NR_ITEM"),
        _text("l_suppkey").alias("COD_VENDEDOR"),
        F.col("l_extendedprice").alias("VALOR_LIQUIDO"),
    ]


def silver_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, ("part", "supplier")).select(*_stock_columns())


def stock_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, ("part", "supplier"))
    return lines.select(*_stock_columns(), *_change_columns())


def silver_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One branch per supplier."""
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            _text("s_suppkey").alias("COD_FILIAL"),
            F.col("s_name").alias("DESC_FILIAL"),
            _text("s_nationkey").alias("CNPJ"),
            F.concat("n_name", F.lit(", "), "r_name").alias("END_COMPLETO"),
            F.col("s_acctbal").alias("SALDO"),
        )
    )


def branch_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version 0 inserts all branches, version 1 renames those with a low balance."""
    branches = silver_branches(spark, sf_dir)

    def commit(rows: DataFrame, kind: str, version: int, time: str) -> DataFrame:
        return rows.select(
            "*",
            F.lit(kind).alias(CHANGE_TYPE),
            F.lit(version).cast("long").alias(VERSION),
            literal_timestamp(time).alias(COMMIT_TIME),
        )

    renamed = branches.filter("SALDO < 1000").withColumn(
        "DESC_FILIAL", F.concat("DESC_FILIAL", F.lit(" *"))
    )
    return commit(branches, INSERT, 0, "2024-01-01 00:00:00").unionByName(
        commit(renamed, POSTIMAGE, 1, "2024-01-02 00:00:00")
    )


# Order snapshots: old ends before 2000-07-01, new starts on 1995-07-01, and in new
# the urgent orders of both have another status.

ORDER_COLUMNS = (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
)


# Days on which the edited snapshot differs.
EDITED_DAY, MISSING_DAY = "1996-02-13", "1997-08-20"


def orders_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    return orders.filter(F.col("o_orderdate") < literal_timestamp("2000-07-01 00:00:00"))


def orders_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return orders.filter(
        F.col("o_orderdate") >= literal_timestamp("1995-07-01 00:00:00")
    ).withColumn("o_orderstatus", F.when(urgent, "X").otherwise(F.col("o_orderstatus")))


def orders_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old snapshot with a few rows changed, and a few gone: those of one day each."""
    old = orders_old(spark, sf_dir)
    day = F.to_date("o_orderdate")
    status = F.when(day == EDITED_DAY, F.lit("X")).otherwise(F.col("o_orderstatus"))
    return old.filter(day != MISSING_DAY).withColumn("o_orderstatus", status)


def orders_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a bulk file has them: all text, with amounts missing their form and keys missing."""
    orders = table(spark, sf_dir, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return orders.select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.when(urgent, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string")).alias("amount"),
        F.col("o_orderpriority").alias("o_orderpriority"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
    )


def _status(df: DataFrame, start: str, end: str | None, active: bool) -> DataFrame:
    stop = F.lit(None).cast("timestamp_ntz") if end is None else literal_timestamp(end)
    return df.select(
        *ORDER_COLUMNS,
        row_hash(ORDER_COLUMNS).alias(HASH),
        literal_timestamp(start).alias(START),
        stop.alias(END),
        F.lit(active).alias(ACTIVE),
    )


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned orders: the old snapshot is active; orders of open status also have
    an earlier, closed stay of the same content."""
    old = orders_old(spark, sf_dir)
    active = _status(old, "2023-06-01 00:00:00", None, True)
    closed = _status(
        old.filter("o_orderstatus = 'O'"), "2023-01-01 00:00:00", "2023-03-01 00:00:00", False
    )
    return active.unionByName(closed)


def order_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status(orders_new(spark, sf_dir), RUN_TIME, None, True)


# Order items, unique on (pedido_id, item_id): the published order table.

ITEM_KEYS = ("pedido_id", "item_id")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("pedido_id"), F.col("l_linenumber").alias("item_id"))
        .agg(
            F.max("l_partkey").alias("produto_id"),
            F.sum("l_quantity").alias("quantidade"),
            F.max("l_extendedprice").alias("preco_unitario"),
            F.max("l_shipdate").alias("dt_atualizacao"),
        )
    )
    orders = table(spark, sf_dir, "orders")
    return items.join(orders, F.col("pedido_id") == F.col("o_orderkey")).select(
        "pedido_id",
        F.col("o_custkey").alias("cliente_id"),
        F.col("o_orderdate").cast("date").alias("data_pedido"),
        F.col("o_totalprice").alias("valor_total"),
        F.col("o_orderstatus").alias("status"),
        "item_id",
        "produto_id",
        "quantidade",
        "preco_unitario",
        "dt_atualizacao",
    )


def published_items(items: DataFrame) -> DataFrame:
    """What is published: items of orders before 2000."""
    return items.filter(F.col("data_pedido") < F.lit("2000-01-01").cast("date"))


def arriving_items(items: DataFrame) -> DataFrame:
    """What is staged: items of orders from 1998 on, a day later and with a new status.

    One item of each order is deleted, and one has no flag.
    """
    return (
        items.filter(F.col("data_pedido") >= F.lit("1998-01-01").cast("date"))
        .withColumn("status", F.lit("S"))
        .withColumn("dt_atualizacao", F.col("dt_atualizacao") + F.expr("INTERVAL 1 DAY"))
        .withColumn(
            "is_deleted",
            F.when(F.col("item_id") == 1, F.lit(None).cast("boolean")).otherwise(
                F.col("item_id") == 2
            ),
        )
    )


# A second feed, from events: one commit per day, keyed by user.


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        "value",
        F.when(kind == "error", DELETE)
        .when(kind == "view", PREIMAGE)
        .when(kind == "purchase", POSTIMAGE)
        .otherwise(INSERT)
        .alias(CHANGE_TYPE),
        F.dayofmonth("ts").cast("long").alias(VERSION),
        F.col("ts").alias(COMMIT_TIME),
    )
