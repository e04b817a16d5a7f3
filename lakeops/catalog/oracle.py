"""The queries' results as plain SQL, for DuckDB over the same tables."""

from __future__ import annotations

from lakeops.catalog.queries import (
    AS_OF_VERSION,
    DQ_COLUMNS,
    EVENT_DAY,
    FEED_OUTPUT,
    HIGH_WATER,
    PREVIEW_ROWS,
    SQL_START,
    TYPED_COLUMNS,
    UNDEFINED_SPEC,
)
from lakeops.fixtures import (
    BRANCH_TIEBREAK,
    EDITED_DAY,
    INVOICE_TIEBREAK,
    MISSING_DAY,
    ORDER_COLUMNS,
    RUN_TIME,
    SPLIT_VERSION,
    STOCK_TIEBREAK,
)
from lakeops.plans.specs import (
    BRANCHES,
    FATO_FATURAMENTO,
    INVOICES,
    MODELS,
    PUBLISHED,
    STOCK,
    ModelSpec,
)

# Fixed values in this module: the column names of the silver and gold tables, and what the
# fixtures put into them.

NOW = f"TIMESTAMP '{RUN_TIME}'"

CHANGE_COLUMNS = """
  CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'delete'
       WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'update_preimage'
       WHEN l_returnflag IN ('A', 'R') AND l_linestatus = 'O' THEN 'update_postimage'
       ELSE 'insert' END AS _change_type,
  CAST(year(l_shipdate) - 1995 AS BIGINT) AS _commit_version,
  l_shipdate AS _commit_timestamp"""

INVOICE = f"""invoice AS (
SELECT
  CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN NULL
       ELSE CAST(l_orderkey AS VARCHAR) END AS CHAVE_NFE,
  l_linenumber AS NR_ITEM,
  CAST(s_nationkey AS VARCHAR) AS COD_FILIAL,
  p_brand AS COD_FABRICANTE,
  CAST(l_orderkey AS VARCHAR) AS NR_NF,
  o_orderstatus AS SERIE_NF,
  CAST(o_custkey AS VARCHAR) AS CPF_CNPJ_CLIFOR,
  c_name AS NOME_CLIEFOR,
  o_orderpriority AS COD_CFOP,
  CAST(o_orderdate AS DATE) AS DATA_EMISSAO,
  CAST(l_partkey AS VARCHAR) AS COD_PRODUTO,
  p_name AS DESC_PRODUTO,
  p_type AS DESC_PRODUTO_PAI,
  CAST(c_nationkey AS VARCHAR) AS COD_IBGE,
  CAST(l_suppkey AS VARCHAR) AS COD_VENDEDOR,
  s_name AS NOME_VENDEDOR,
  CAST(s_nationkey AS VARCHAR) AS CPF_VENDEDOR,
  l_extendedprice AS VALOR_LIQUIDO,
  l_quantity AS QUANTIDADE_LT_KG,
  o_totalprice AS VALOR_TOTAL,
  l_returnflag AS TIPO_NF,
  l_linestatus AS UNIDADE_MEDIDA,
  l_tax AS FATOR_CONVERSAO,
  CASE WHEN l_linenumber = 6 THEN NULL
       ELSE p_brand || '-' || CAST(p_size AS VARCHAR) || '-' || l_linestatus END AS LOTE_INTERNO,
  NULLIF(l_returnflag, 'N') AS COD_TRATAMENTO,
  l_quantity AS PESO_KG_SEMENTE,
  {CHANGE_COLUMNS}
FROM lineitem
LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN part ON l_partkey = p_partkey
LEFT JOIN supplier ON l_suppkey = s_suppkey)"""

STOCK_CTE = f"""stock AS (
SELECT
  CAST(s_nationkey AS VARCHAR) AS COD_FILIAL,
  CAST(l_partkey AS VARCHAR) AS COD_PRODUTO,
  CASE WHEN p_size <= 3 THEN NULL ELSE p_brand END AS COD_FABRICANTE,
  l_quantity AS QTDE_SALDO_EMBALAGEM,
  CAST(l_orderkey AS VARCHAR) AS NR_NF,
  l_linenumber AS NR_ITEM,
  CAST(l_suppkey AS VARCHAR) AS COD_VENDEDOR,
  l_extendedprice AS VALOR_LIQUIDO,
  {CHANGE_COLUMNS}
FROM lineitem
LEFT JOIN part ON l_partkey = p_partkey
LEFT JOIN supplier ON l_suppkey = s_suppkey)"""

BRANCH = """branch0 AS (
SELECT
  CAST(s_suppkey AS VARCHAR) AS COD_FILIAL,
  s_name AS DESC_FILIAL,
  CAST(s_nationkey AS VARCHAR) AS CNPJ,
  n_name || ', ' || r_name AS END_COMPLETO,
  s_acctbal AS SALDO
FROM supplier
LEFT JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey),
branch AS (
SELECT *, 'insert' AS _change_type, CAST(0 AS BIGINT) AS _commit_version,
  TIMESTAMP '2024-01-01 00:00:00' AS _commit_timestamp
FROM branch0
UNION ALL
SELECT COD_FILIAL, DESC_FILIAL || ' *', CNPJ, END_COMPLETO, SALDO, 'update_postimage', 1,
  TIMESTAMP '2024-01-02 00:00:00'
FROM branch0 WHERE SALDO < 1000)"""

FEEDS = {
    INVOICES: ("invoice", INVOICE, INVOICE_TIEBREAK),
    STOCK: ("stock", STOCK_CTE, STOCK_TIEBREAK),
    BRANCHES: ("branch", BRANCH, BRANCH_TIEBREAK),
}

UPSERT_ROWS = "_change_type IN ('insert', 'update_postimage')"
STOCK_KEYS = ("COD_FILIAL", "COD_PRODUTO", "COD_FABRICANTE")
STOCK_OUTPUT = (
    *STOCK_KEYS, "QTDE_SALDO_EMBALAGEM", *STOCK_TIEBREAK, "_change_type", "_commit_version",
    "_commit_timestamp",
)


def names(columns) -> str:
    return ", ".join(columns)


def newest(cte: str, where: str, keys, tiebreak, columns: str) -> str:
    """First row per key by version, newest first, then tie-break."""
    order = ", ".join(f"{c} ASC NULLS LAST" for c in tiebreak)
    return f"""SELECT {columns} FROM (
  SELECT *, row_number() OVER (PARTITION BY {names(keys)}
    ORDER BY _commit_version DESC NULLS LAST, {order}) AS rn
  FROM {cte} WHERE {where}) ranked
WHERE rn = 1"""


def upsert_sql(ctes: str, state: str, rows: str, keys) -> str:
    match = " AND ".join(f"s.{k} IS NOT DISTINCT FROM u.{k}" for k in keys)
    return f"""WITH {ctes},
s AS ({state}),
u AS ({rows})
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM u WHERE {match})
UNION ALL
SELECT * FROM u"""


def key_filter(spec: ModelSpec) -> str:
    if not spec.require_key:
        return "TRUE"
    return " AND ".join(f"{k} IS NOT NULL" for k in spec.source_keys)


def gold_list(spec: ModelSpec, stamp: str) -> str:
    def one(gold: str, silver: str) -> str:
        if gold in spec.undefined:
            return f"coalesce({silver}, '99999999') AS {gold}"
        return f"{silver} AS {gold}"

    return ", ".join([*[one(g, s) for g, s in spec.columns.items()], f"{stamp} AS data_atualizacao"])


def gold_full_body(spec: ModelSpec) -> str:
    cte = {STOCK: "stock", BRANCHES: "branch0"}.get(spec.source, "invoice")
    distinct = "DISTINCT " if spec.distinct_full else ""
    return f"SELECT {distinct}{gold_list(spec, NOW)} FROM {cte} WHERE {key_filter(spec)}"


def gold_full_sql(spec: ModelSpec) -> str:
    return f"WITH {FEEDS[spec.source][1]} {gold_full_body(spec)}"


def gold_incr_body(spec: ModelSpec, where: str = "TRUE") -> str:
    cte, _, tiebreak = FEEDS[spec.source]
    where = f"{UPSERT_ROWS} AND {key_filter(spec)} AND {where}"
    return newest(cte, where, spec.source_keys, tiebreak, gold_list(spec, "_commit_timestamp"))


def gold_incr_sql(spec: ModelSpec) -> str:
    return f"WITH {FEEDS[spec.source][1]} {gold_incr_body(spec)}"


def typed_list() -> str:
    def one(column: str, text: str) -> str:
        text = "TIMESTAMP" if text == "TIMESTAMP_NTZ" else text
        return f"CAST({column} AS {text}) AS {column}"

    return ", ".join(one(c, t) for c, t in TYPED_COLUMNS.items())


def split_upsert(feed: str, cte: str, keys, tiebreak, columns, extra: str) -> str:
    def part(comparison: str) -> str:
        where = f"{UPSERT_ROWS} AND {extra} AND _commit_version {comparison} {SPLIT_VERSION}"
        return newest(feed, where, keys, tiebreak, names(columns))

    return upsert_sql(cte, part("<"), part(">="), keys)


SNAPSHOTS = f"""snap_old AS (
SELECT {names(ORDER_COLUMNS)} FROM orders WHERE o_orderdate < TIMESTAMP '2000-07-01 00:00:00'),
snap_new AS (
SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '1995-07-01 00:00:00')"""

FINGERPRINT = (
    "md5(concat_ws('|', "
    + ", ".join(
        f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
        for c in ORDER_COLUMNS
    )
    + "))"
)

ORDERS = names(ORDER_COLUMNS)
SCD2 = f"""{SNAPSHOTS},
hist AS (
SELECT *, {FINGERPRINT} AS hash_value, TIMESTAMP '2023-06-01 00:00:00' AS data_inicio,
  CAST(NULL AS TIMESTAMP) AS data_fim, TRUE AS ativo FROM snap_old
UNION ALL
SELECT *, {FINGERPRINT}, TIMESTAMP '2023-01-01 00:00:00', TIMESTAMP '2023-03-01 00:00:00', FALSE
FROM snap_old WHERE o_orderstatus = 'O'),
cur AS (
SELECT *, {FINGERPRINT} AS hash_value, {NOW} AS data_inicio,
  CAST(NULL AS TIMESTAMP) AS data_fim, TRUE AS ativo FROM snap_new),
ins AS (
SELECT {ORDERS}, hash_value FROM cur EXCEPT SELECT {ORDERS}, hash_value FROM hist WHERE ativo),
del AS (
SELECT {ORDERS}, hash_value FROM hist WHERE ativo EXCEPT SELECT {ORDERS}, hash_value FROM cur),
closed AS (
SELECT {ORDERS}, hash_value, data_inicio,
  CASE WHEN ativo AND hash_value IN (SELECT hash_value FROM del) THEN {NOW} ELSE data_fim END
    AS data_fim,
  CASE WHEN ativo AND hash_value IN (SELECT hash_value FROM del) THEN FALSE ELSE ativo END AS ativo
FROM hist),
attached AS (
SELECT ins.*, s.data_inicio, s.data_fim, s.ativo FROM ins
JOIN (SELECT DISTINCT hash_value, data_inicio, data_fim, ativo FROM cur WHERE ativo) s
  ON ins.hash_value = s.hash_value),
applied AS (SELECT * FROM closed UNION ALL SELECT * FROM attached)"""

ITEM_COLUMNS = (
    "pedido_id, cliente_id, data_pedido, valor_total, status, item_id, produto_id, quantidade, "
    "preco_unitario, dt_atualizacao"
)
ITEMS = f"""items AS (
SELECT pedido_id, o_custkey AS cliente_id, CAST(o_orderdate AS DATE) AS data_pedido,
  o_totalprice AS valor_total, o_orderstatus AS status, item_id, produto_id, quantidade,
  preco_unitario, dt_atualizacao
FROM (SELECT l_orderkey AS pedido_id, l_linenumber AS item_id, max(l_partkey) AS produto_id,
        sum(l_quantity) AS quantidade, max(l_extendedprice) AS preco_unitario,
        max(l_shipdate) AS dt_atualizacao
      FROM lineitem GROUP BY l_orderkey, l_linenumber) l
JOIN orders ON pedido_id = o_orderkey),
target AS (SELECT * FROM items WHERE data_pedido < DATE '2000-01-01'),
staged AS (
SELECT pedido_id, cliente_id, data_pedido, valor_total, 'S' AS status, item_id, produto_id,
  quantidade, preco_unitario, dt_atualizacao + INTERVAL 1 DAY AS dt_atualizacao,
  CASE WHEN item_id = 1 THEN NULL ELSE item_id = 2 END AS is_deleted
FROM items WHERE data_pedido >= DATE '1998-01-01'),
captured AS (
SELECT t.*, t.dt_atualizacao AS valid_from, s.dt_atualizacao AS valid_to, FALSE AS is_current,
  CASE WHEN s.is_deleted THEN 'DELETE' ELSE 'UPDATE' END AS change_type
FROM target t JOIN staged s ON t.pedido_id = s.pedido_id AND t.item_id = s.item_id),
published AS (
SELECT {ITEM_COLUMNS} FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM staged s WHERE s.pedido_id = t.pedido_id AND s.item_id = t.item_id
    AND (s.is_deleted = TRUE OR s.is_deleted = FALSE))
UNION ALL
SELECT {ITEM_COLUMNS} FROM staged WHERE is_deleted = FALSE)"""

REDUCED = names(c for c in ORDER_COLUMNS if c != "o_totalprice")
RECONCILE = f"""{SNAPSHOTS},
only_l AS (SELECT {REDUCED} FROM snap_old EXCEPT SELECT {REDUCED} FROM snap_new),
only_r AS (SELECT {REDUCED} FROM snap_new EXCEPT SELECT {REDUCED} FROM snap_old),
both_sides AS (
SELECT *, 'left' AS side FROM only_l UNION ALL SELECT *, 'right' AS side FROM only_r)"""

EDITED = f"""{SNAPSHOTS},
edited AS (
SELECT o_orderkey, o_custkey,
  CASE WHEN CAST(o_orderdate AS DATE) = DATE '{EDITED_DAY}' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  o_totalprice, o_orderdate, o_orderpriority
FROM snap_old WHERE CAST(o_orderdate AS DATE) <> DATE '{MISSING_DAY}'),
gone AS (SELECT * FROM snap_old EXCEPT SELECT * FROM edited),
come AS (SELECT * FROM edited EXCEPT SELECT * FROM snap_old)"""

BULK = """bulk AS (
SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey AS VARCHAR) END AS o_orderkey,
  CAST(o_custkey AS VARCHAR) AS o_custkey,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS amount,
  o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
FROM orders)"""

DIFF = f"""WITH {SNAPSHOTS},
gone AS (SELECT * FROM snap_old EXCEPT SELECT * FROM snap_new),
come AS (SELECT * FROM snap_new EXCEPT SELECT * FROM snap_old)
SELECT *, 'insert' AS _change_type FROM come
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM snap_old)
UNION ALL
SELECT *, 'update_postimage' FROM come WHERE o_orderkey IN (SELECT o_orderkey FROM snap_old)
UNION ALL
SELECT *, 'update_preimage' FROM gone WHERE o_orderkey IN (SELECT o_orderkey FROM snap_new)
UNION ALL
SELECT *, 'delete' FROM gone WHERE o_orderkey NOT IN (SELECT o_orderkey FROM snap_new)"""

WATERMARKS = f"""{INVOICE}, {STOCK_CTE}, {BRANCH},
done AS (
SELECT 'silver_invoices' AS table_name, max(_commit_version) AS v FROM invoice
UNION ALL SELECT 'silver_stock', max(_commit_version) FROM stock
UNION ALL SELECT 'silver_branches', max(_commit_version) FROM branch),
control AS (
SELECT table_name, greatest(CAST(0 AS BIGINT), v) AS last_processed_version,
  CASE WHEN v > 0 THEN TIMESTAMP '2024-02-02 00:00:00' ELSE {NOW} END AS updated_at
FROM done)"""

EVENT_FEED = """feed AS (
SELECT user_id, event_id, value,
  CASE event_type WHEN 'error' THEN 'delete' WHEN 'view' THEN 'update_preimage'
    WHEN 'purchase' THEN 'update_postimage' ELSE 'insert' END AS _change_type,
  CAST(dayofmonth(ts) AS BIGINT) AS _commit_version, ts AS _commit_timestamp
FROM events)"""


def bounds_sql(table: str, columns: tuple[str, ...]) -> str:
    each = (f"count({c}) AS n_{c}, min({c}) AS min_{c}, max({c}) AS max_{c}" for c in columns)
    return f"SELECT count(*) AS n_rows, {', '.join(each)} FROM {table}"


def check_sql(spec: ModelSpec) -> list[str]:
    gold = f"({gold_full_body(spec)}) g"
    checks = [
        f"SELECT '{spec.name}' AS model, 'not_null' AS check_name, '{c}' AS column_name, "
        f"count(*) - count({c}) AS failures FROM {gold}"
        for c in spec.not_null
    ]
    checks += [
        f"SELECT '{spec.name}', 'unique', '{c}', count(*) FROM (SELECT {c} FROM {gold} "
        f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) r"
        for c in spec.unique
    ]
    return checks


def without_stamp(sql: str) -> str:
    return f"SELECT * EXCLUDE (data_atualizacao) FROM ({sql}) g"


def first_load_sql() -> str:
    """The newest change per key over all commits, deletes included, if it is no delete."""
    spec = FATO_FATURAMENTO
    where = f"_change_type <> 'update_preimage' AND {key_filter(spec)}"
    rows = newest("invoice", where, spec.source_keys, INVOICE_TIEBREAK, f"_change_type, {gold_list(spec, NOW)}")
    return f"WITH {INVOICE} SELECT * EXCLUDE (data_atualizacao, _change_type) FROM ({rows}) g WHERE _change_type <> 'delete'"


def published_stock_sql() -> str:
    spec = PUBLISHED["fato_estoque"]
    casts = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in spec.columns.items())
    return f"WITH {STOCK_CTE} SELECT {casts} FROM ({gold_incr_body(MODELS['fato_estoque'])}) g"


def oracle_sql() -> dict[str, str]:
    invoice = f"WITH {INVOICE}"
    feed_columns = names(FEED_OUTPUT)
    from_split = f"_commit_version >= {SPLIT_VERSION}"
    keyed = "CHAVE_NFE IS NOT NULL"
    silver = names(
        line.split(" AS ")[-1].strip(" ,")
        for line in INVOICE.split(CHANGE_COLUMNS)[0].splitlines()
        if " AS " in line and line.rstrip().endswith(",")
    )
    sql = {
        "scan_silver": f"{invoice} SELECT {silver} FROM invoice",
        "change_feed_scan": f"{invoice} SELECT {feed_columns} FROM invoice WHERE {from_split}",
        "change_feed_upserts": f"{invoice} SELECT {feed_columns} FROM invoice "
        f"WHERE {from_split} AND {UPSERT_ROWS}",
        "latest_by_key": f"{invoice} "
        + newest(
            "invoice", f"{UPSERT_ROWS} AND {keyed}", ["CHAVE_NFE"], INVOICE_TIEBREAK, feed_columns
        ),
        "latest_by_composite_key": f"WITH {STOCK_CTE} "
        + newest("stock", UPSERT_ROWS, STOCK_KEYS, STOCK_TIEBREAK, names(STOCK_OUTPUT)),
        "snapshot_as_of": f"{invoice} "
        + newest(
            "invoice",
            f"{keyed} AND _commit_version <= {AS_OF_VERSION} AND _change_type <> 'update_preimage'",
            ["CHAVE_NFE"],
            INVOICE_TIEBREAK,
            feed_columns,
        )
        + " AND _change_type <> 'delete'",
        "event_state": f"WITH {EVENT_FEED} "
        + newest(
            "feed",
            f"_commit_version <= {EVENT_DAY} AND _change_type <> 'update_preimage'",
            ["user_id"],
            ["event_id"],
            "user_id, event_id, value, _change_type, _commit_version, _commit_timestamp",
        )
        + " AND _change_type <> 'delete'",
    }
    sql.update({f"gold_full_{name}": gold_full_sql(spec) for name, spec in MODELS.items()})
    sql.update({f"gold_incr_{name}": gold_incr_sql(spec) for name, spec in MODELS.items()})
    for name, spec in MODELS.items():
        body = gold_incr_body(spec, f"_commit_version >= {SQL_START}")
        sql[f"sql_incr_{name}"] = f"WITH {FEEDS[spec.source][1]} {body}"
    sql.update(
        {
            "undefined_code_default": gold_full_sql(UNDEFINED_SPEC),
            "upsert_single_key": split_upsert(
                "invoice", INVOICE, ["CHAVE_NFE"], INVOICE_TIEBREAK, FEED_OUTPUT, keyed
            ),
            "upsert_item_grain": split_upsert(
                "invoice", INVOICE, ["CHAVE_NFE", "NR_ITEM"], INVOICE_TIEBREAK, FEED_OUTPUT, keyed
            ),
            "upsert_composite_key": split_upsert(
                "stock", STOCK_CTE, STOCK_KEYS, STOCK_TIEBREAK, STOCK_OUTPUT, "TRUE"
            ),
            "watermark_advance": f"WITH {WATERMARKS} SELECT * FROM control",
            "watermark_lookup": f"WITH {WATERMARKS} SELECT coalesce(max(last_processed_version), 0) "
            "AS last_processed_version FROM control WHERE table_name = 'silver_invoices'",
            "incremental_run": upsert_sql(
                INVOICE,
                gold_incr_body(FATO_FATURAMENTO, f"_commit_version < {SPLIT_VERSION}"),
                gold_incr_body(
                    FATO_FATURAMENTO,
                    "_commit_version > (SELECT max(_commit_version) FROM invoice "
                    f"WHERE _commit_version < {SPLIT_VERSION})",
                ),
                FATO_FATURAMENTO.keys,
            ),
            "feed_from_first_load": "SELECT *, 'insert' AS _change_type, "
            f"CAST(0 AS BIGINT) AS _commit_version, {NOW} AS _commit_timestamp FROM orders",
            "snapshot_diff_feed": DIFF,
            "snapshot_inserts": f"WITH {SCD2} SELECT * FROM ins",
            "snapshot_deletes": f"WITH {SCD2} SELECT * FROM del",
            "scd2_change_counts": f"WITH {SCD2} SELECT "
            "(SELECT count(*) FROM hist WHERE ativo) AS rows_before, "
            "(SELECT count(*) FROM cur) AS rows_now, "
            "(SELECT count(*) FROM ins) AS rows_inserted, "
            "(SELECT count(*) FROM del) AS rows_deleted",
            "scd2_close_out": f"WITH {SCD2} SELECT * FROM closed",
            "scd2_attach_status": f"WITH {SCD2} SELECT * FROM attached",
            "scd2_apply": f"WITH {SCD2} SELECT * FROM applied",
            "active_export": f"WITH {SCD2} SELECT {ORDERS} FROM applied WHERE ativo",
            "row_fingerprint": f"SELECT o_orderkey, {FINGERPRINT} AS hash_value FROM orders",
            "target_high_water": "SELECT coalesce(max(ts), TIMESTAMP '1900-01-01') AS ts FROM events",
            "incremental_since": f"SELECT * FROM events WHERE ts > TIMESTAMP '{HIGH_WATER}'",
            "declared_schema_cast": f"{invoice} SELECT {typed_list()} "
            f"FROM ({gold_full_body(FATO_FATURAMENTO)}) g",
            "publish_stage": f"{invoice} SELECT {typed_list()} "
            f"FROM ({gold_incr_body(FATO_FATURAMENTO)}) g "
            "WHERE data_atualizacao > TIMESTAMP '1999-06-01 00:00:00'",
            "delete_insert": f"WITH {ITEMS} SELECT {ITEM_COLUMNS} FROM target t WHERE NOT EXISTS "
            "(SELECT 1 FROM staged s WHERE s.pedido_id = t.pedido_id AND s.item_id = t.item_id) "
            f"UNION ALL SELECT {ITEM_COLUMNS} FROM staged",
            "apply_tombstones": f"WITH {ITEMS} SELECT {ITEM_COLUMNS} FROM target t WHERE NOT EXISTS "
            "(SELECT 1 FROM staged s WHERE s.pedido_id = t.pedido_id AND s.item_id = t.item_id "
            "AND s.is_deleted = TRUE)",
            "publish_with_deletes": f"WITH {ITEMS} SELECT * FROM published",
            "history_capture": f"WITH {ITEMS} SELECT * FROM captured",
            "full_history": f"WITH {ITEMS} SELECT * FROM captured UNION ALL "
            "SELECT *, dt_atualizacao, CAST(NULL AS TIMESTAMP), TRUE, 'INSERT' FROM published",
            "dq_not_null": f"{invoice} "
            + " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_rows FROM invoice"
                for c in DQ_COLUMNS
            ),
            "dq_unique": f"{invoice} SELECT CHAVE_NFE, count(*) AS n_rows FROM invoice "
            "WHERE CHAVE_NFE IS NOT NULL GROUP BY CHAVE_NFE HAVING count(*) > 1",
            "dq_models": f"WITH {INVOICE}, {STOCK_CTE}, {BRANCH} "
            + " UNION ALL ".join(c for spec in MODELS.values() for c in check_sql(spec)),
            "reconcile_rows": f"WITH {RECONCILE} SELECT * FROM both_sides",
            "reconcile_counts": f"WITH {RECONCILE} SELECT (SELECT count(*) FROM only_l) AS only_left, "
            "(SELECT count(*) FROM only_r) AS only_right",
            "reconcile_tree": f"WITH {EDITED} SELECT *, 'left' AS side FROM gone UNION ALL SELECT *, 'right' FROM come",
            "dq_increment": f"{invoice} "
            + " UNION ALL ".join(
                f"SELECT 'not_null' AS check_name, '{c}' AS column_name, count(*) - count({c}) AS failures "
                f"FROM invoice WHERE {from_split}"
                for c in DQ_COLUMNS
            )
            + " UNION ALL SELECT 'unique', 'CHAVE_NFE', count(*) FROM (SELECT CHAVE_NFE FROM invoice "
            "WHERE CHAVE_NFE IS NOT NULL GROUP BY CHAVE_NFE "
            f"HAVING count(*) > 1 AND count(*) FILTER ({from_split}) > 0) r",
            "load_rejects": f"WITH {BULK} SELECT o_orderkey, 'o_orderkey' AS column_name, 'key is null' AS reason, "
            "o_orderkey AS value FROM bulk WHERE o_orderkey IS NULL UNION ALL "
            "SELECT o_orderkey, 'amount', 'not DECIMAL(18,2)', amount FROM bulk WHERE amount = 'n/a' UNION ALL "
            "SELECT o_orderkey, 'o_orderpriority', 'longer than 10', o_orderpriority FROM bulk "
            "WHERE length(o_orderpriority) > 10",
            "load_typed": f"WITH {BULK} SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS INT) AS o_custkey, "
            "CAST(amount AS DECIMAL(18,2)) AS amount, o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate "
            "FROM bulk WHERE o_orderkey IS NOT NULL AND amount <> 'n/a' AND length(o_orderpriority) <= 10",
            "reconcile_filtered": f"WITH {RECONCILE} SELECT * FROM both_sides "
            "WHERE o_orderpriority = '1-URGENT'",
            "profile_counts": f"{invoice} SELECT count(*) AS n_rows, "
            + ", ".join(f"count({c}) AS n_{c}" for c in DQ_COLUMNS)
            + " FROM invoice",
            "preview_rows": f"{invoice} SELECT NR_NF, NR_ITEM, COD_PRODUTO, COD_VENDEDOR, "
            "VALOR_LIQUIDO FROM invoice ORDER BY VALOR_LIQUIDO DESC, NR_NF, NR_ITEM, "
            f"COD_PRODUTO, COD_VENDEDOR LIMIT {PREVIEW_ROWS}",
            "resume_with_late_commit": f"WITH {INVOICE} "
            + without_stamp(gold_incr_body(FATO_FATURAMENTO)),
            "first_load_after_deletes": first_load_sql(),
            "publish_stock_rerun": published_stock_sql(),
            "versioned_feed": f"WITH {SCD2} SELECT * FROM applied "
            "WHERE data_fim IS NULL OR data_fim > TIMESTAMP '2023-03-01 00:00:00'",
        }
    )
    changes = newest(
        "feed",
        "_change_type <> 'update_preimage'",
        ["user_id"],
        ["event_id"],
        "user_id, value AS last_value, _commit_timestamp AS data_atualizacao, _change_type",
    )
    sql["streamed_state"] = f"WITH {EVENT_FEED} SELECT * EXCLUDE (_change_type) FROM ({changes}) n WHERE _change_type <> 'delete'"
    sql["incremental_run_scalar"] = sql["incremental_run"]
    sql["upsert_bucketed"] = sql["upsert_composite_key"]
    sql["history_bucketed"] = sql["history_capture"]
    sql["item_bounds"] = bounds_sql("lineitem", ("l_orderkey", "l_partkey", "l_linenumber"))
    sql["event_bounds"] = bounds_sql("events", ("event_id", "ts"))
    sql["published_together"] = f"WITH {INVOICE}, {STOCK_CTE}, {BRANCH} " + " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS n_rows FROM ({gold_incr_body(spec)}) g" for name, spec in MODELS.items()
    )
    return sql
