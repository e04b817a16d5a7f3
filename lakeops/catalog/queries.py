"""One query per operator, over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops import fixtures as fx
from lakeops.functions.columns import row_hash
from lakeops.functions.types import cast_columns
from lakeops.operators import quality, scd2
from lakeops.operators.changes import (
    CHANGE_TYPE,
    COMMIT_TIME,
    VERSION,
    as_first_load,
    snapshot_as_of,
    snapshot_diff,
    upserts_only,
)
from lakeops.operators.bucketed import buckets_of, history_bucketed, upsert_bucketed, without_hash, write_keyed
from lakeops.operators.changed_checks import check_changed, observe_nulls, observed_failures
from lakeops.operators.file_bounds import file_bounds
from lakeops.operators.hashtree import reconcile_by_tree
from lakeops.operators.history import full_history, history_capture
from lakeops.operators.latest import latest_by_key
from lakeops.operators.merge import (
    apply_tombstones,
    delete_insert,
    publish_with_deletes,
    upsert,
)
from lakeops.operators.rejects import load_with_rejects
from lakeops.plans import control
from lakeops.plans.concurrent import publish_together
from lakeops.plans.models import gold_full, gold_increment
from lakeops.plans.pipeline import Feed, run_pipeline
from lakeops.plans.publish import incremental_since, publish, target_high_water
from lakeops.plans.specs import (
    BRANCHES,
    FATO_FATURAMENTO,
    INVOICES,
    MODELS,
    PUBLISHED,
    SOURCES,
    STAMP,
    STOCK,
    ModelSpec,
)
from lakeops.plans.sql_feeds import create_feed_function, increment_sql
from lakeops.plans.versioned import save_versioned
from lakeops.sinks.staging import Staging
from lakeops.sinks.tables import append_changes, read_version
from lakeops.sources.registry import open_changes, read_changes
from lakeops.streaming.state import read_state, start_state_stream

Query = Callable[[SparkSession, str], DataFrame]

# Invoice columns the feed queries show.
FEED_COLUMNS = ("CHAVE_NFE", "NR_ITEM", "CPF_CNPJ_CLIFOR", "COD_PRODUTO", "VALOR_LIQUIDO", "TIPO_NF")
FEED_OUTPUT = (*FEED_COLUMNS, "NR_NF", "COD_VENDEDOR", CHANGE_TYPE, VERSION, COMMIT_TIME)
STOCK_KEYS = ("COD_FILIAL", "COD_PRODUTO", "COD_FABRICANTE")
ITEM_GRAIN = ("CHAVE_NFE", "NR_ITEM")
AS_OF_VERSION = 4
EVENT_DAY = 15
HIGH_WATER = "2024-01-15 12:00:00"
PREVIEW_ROWS = 800
BOUND_COLUMNS = ("l_orderkey", "l_partkey", "l_linenumber")
# First commit of the models' runs as SQL.
SQL_START = 1
LOAD_COLUMNS = {
    "o_orderkey": "BIGINT",
    "o_custkey": "INT",
    "amount": "DECIMAL(18,2)",
    "o_orderpriority": "VARCHAR(10)",
    "o_orderdate": "DATE",
}
TYPED_COLUMNS = {**PUBLISHED["fato_faturamento"].columns, STAMP: "TIMESTAMP_NTZ"}
USERS = ModelSpec(
    name="users", source="events", keys=("user_id",), columns={"user_id": "user_id", "last_value": "value"}
)
UNDEFINED_SPEC = replace(
    FATO_FATURAMENTO, undefined=("FaturamentoLote", "FaturamentoTratamento")
)


def _feed(spark: SparkSession, d: str) -> DataFrame:
    return fx.invoice_feed(spark, d, FEED_COLUMNS).select(*FEED_OUTPUT)


def _source(spec: ModelSpec, spark: SparkSession, d: str) -> DataFrame:
    if spec.source == INVOICES:
        return fx.silver_invoices(spark, d, spec.source_columns)
    return {STOCK: fx.silver_stock, BRANCHES: fx.silver_branches}[spec.source](spark, d)


def _changes(spec: ModelSpec, spark: SparkSession, d: str) -> tuple[DataFrame, tuple[str, ...]]:
    if spec.source == INVOICES:
        return fx.invoice_feed(spark, d, spec.source_columns), fx.INVOICE_TIEBREAK
    if spec.source == STOCK:
        return fx.stock_feed(spark, d), fx.STOCK_TIEBREAK
    return fx.branch_feed(spark, d), fx.BRANCH_TIEBREAK


def _full(spec: ModelSpec) -> Query:
    return lambda spark, d: gold_full(spec, _source(spec, spark, d), fx.run_time())


def _increment(spec: ModelSpec) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        changes, tiebreak = _changes(spec, spark, d)
        return gold_increment(spec, changes, tiebreak)

    return query


def scan_silver(spark: SparkSession, d: str) -> DataFrame:
    return fx.silver_invoices(spark, d)


def change_feed_scan(spark: SparkSession, d: str) -> DataFrame:
    return read_changes(_feed(spark, d), fx.SPLIT_VERSION)


def change_feed_upserts(spark: SparkSession, d: str) -> DataFrame:
    return upserts_only(read_changes(_feed(spark, d), fx.SPLIT_VERSION))


def _keyed_feed(spark: SparkSession, d: str) -> DataFrame:
    return _feed(spark, d).filter(F.col("CHAVE_NFE").isNotNull())


def latest(spark: SparkSession, d: str) -> DataFrame:
    feed = upserts_only(_keyed_feed(spark, d))
    return latest_by_key(feed, ["CHAVE_NFE"], VERSION, fx.INVOICE_TIEBREAK)


def latest_composite(spark: SparkSession, d: str) -> DataFrame:
    feed = upserts_only(fx.stock_feed(spark, d))
    return latest_by_key(feed, STOCK_KEYS, VERSION, fx.STOCK_TIEBREAK)


def as_of(spark: SparkSession, d: str) -> DataFrame:
    return snapshot_as_of(
        _keyed_feed(spark, d), AS_OF_VERSION, ["CHAVE_NFE"], fx.INVOICE_TIEBREAK
    )


def _split(
    feed: DataFrame, keys: tuple[str, ...], tiebreak: tuple[str, ...]
) -> tuple[DataFrame, DataFrame]:
    """Newest rows before the split version, and from it on; those are staged.

    An upsert needs them for their keys and as rows.
    """
    rows = upserts_only(feed)
    before = read_changes(rows, 0, fx.SPLIT_VERSION - 1)
    after = read_changes(rows, fx.SPLIT_VERSION)
    staged = Staging(feed.sparkSession)(latest_by_key(after, keys, VERSION, tiebreak), "rows")
    return latest_by_key(before, keys, VERSION, tiebreak), staged


def upsert_single_key(spark: SparkSession, d: str) -> DataFrame:
    state, rows = _split(_keyed_feed(spark, d), ("CHAVE_NFE",), fx.INVOICE_TIEBREAK)
    return upsert(state, rows, ["CHAVE_NFE"])


def upsert_item_grain(spark: SparkSession, d: str) -> DataFrame:
    state, rows = _split(_keyed_feed(spark, d), ITEM_GRAIN, fx.INVOICE_TIEBREAK)
    return upsert(state, rows, ITEM_GRAIN)


def upsert_composite_key(spark: SparkSession, d: str) -> DataFrame:
    state, rows = _split(fx.stock_feed(spark, d), STOCK_KEYS, fx.STOCK_TIEBREAK)
    return upsert(state, rows, STOCK_KEYS, null_safe=True)


def _feeds(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        INVOICES: fx.invoice_feed(spark, d, ("CHAVE_NFE",)),
        STOCK: fx.stock_feed(spark, d),
        BRANCHES: fx.branch_feed(spark, d),
    }


def watermark_advance(spark: SparkSession, d: str) -> DataFrame:
    seed = control.watermark_seed(spark, SOURCES, fx.run_time())
    done = [control.processed_version(name, feed) for name, feed in _feeds(spark, d).items()]
    later = F.lit("2024-02-02 00:00:00").cast("timestamp_ntz")
    return control.watermark_advance(seed, reduce(DataFrame.unionByName, done), later)


def watermark_lookup(spark: SparkSession, d: str) -> DataFrame:
    return control.watermark_lookup(watermark_advance(spark, d), INVOICES)


def incremental_run(spark: SparkSession, d: str) -> DataFrame:
    """State of the first commits, then a run that resumes after its watermark."""
    feed, tiebreak = _changes(FATO_FATURAMENTO, spark, d)
    processed = read_changes(feed, 0, fx.SPLIT_VERSION - 1)
    table = control.watermark_advance(
        control.watermark_seed(spark, [INVOICES], fx.run_time()),
        control.processed_version(INVOICES, processed),
        fx.run_time(),
    )
    last = control.watermark_lookup(table, INVOICES).first()[control.LAST]
    state = gold_increment(FATO_FATURAMENTO, processed, tiebreak)
    rest = read_changes(feed, control.start_version(last))
    rows = Staging(spark)(gold_increment(FATO_FATURAMENTO, rest, tiebreak), "rows")
    return upsert(state, rows, FATO_FATURAMENTO.keys)


def feed_from_first_load(spark: SparkSession, d: str) -> DataFrame:
    return as_first_load(fx.table(spark, d, "orders"), fx.run_time())


def snapshot_diff_feed(spark: SparkSession, d: str) -> DataFrame:
    return snapshot_diff(
        fx.orders_old(spark, d), fx.orders_new(spark, d), ["o_orderkey"], Staging(spark)
    )


def snapshot_inserts(spark: SparkSession, d: str) -> DataFrame:
    return scd2.snapshot_inserts(fx.order_history(spark, d), fx.order_current(spark, d))


def snapshot_deletes(spark: SparkSession, d: str) -> DataFrame:
    return scd2.snapshot_deletes(fx.order_history(spark, d), fx.order_current(spark, d))


def scd2_change_counts(spark: SparkSession, d: str) -> DataFrame:
    return scd2.change_counts(fx.order_history(spark, d), fx.order_current(spark, d))


def scd2_close_out(spark: SparkSession, d: str) -> DataFrame:
    history = fx.order_history(spark, d)
    deleted = scd2.snapshot_deletes(history, fx.order_current(spark, d))
    return scd2.close_out(history, deleted, fx.run_time())


def scd2_attach_status(spark: SparkSession, d: str) -> DataFrame:
    current = fx.order_current(spark, d)
    return scd2.attach_status(scd2.snapshot_inserts(fx.order_history(spark, d), current), current)


def scd2_apply(spark: SparkSession, d: str) -> DataFrame:
    return scd2.scd2_apply(
        fx.order_history(spark, d), fx.order_current(spark, d), fx.run_time(), Staging(spark)
    )


def active_export(spark: SparkSession, d: str) -> DataFrame:
    return scd2.active_export(scd2_apply(spark, d))


def row_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    orders = fx.table(spark, d, "orders")
    return orders.select("o_orderkey", row_hash(fx.ORDER_COLUMNS).alias(scd2.HASH))


def high_water(spark: SparkSession, d: str) -> DataFrame:
    return target_high_water(fx.table(spark, d, "events"), "ts")


def since_high_water(spark: SparkSession, d: str) -> DataFrame:
    since = F.lit(HIGH_WATER).cast("timestamp_ntz")
    return incremental_since(fx.table(spark, d, "events"), "ts", since)


def declared_schema_cast(spark: SparkSession, d: str) -> DataFrame:
    return cast_columns(_full(FATO_FATURAMENTO)(spark, d), TYPED_COLUMNS)


def publish_stage(spark: SparkSession, d: str) -> DataFrame:
    """The increment of a fact, cast and staged as Parquet, read back."""
    gold = _increment(FATO_FATURAMENTO)(spark, d)
    since = F.lit("1999-06-01 00:00:00").cast("timestamp_ntz")
    return Staging(spark)(
        cast_columns(incremental_since(gold, STAMP, since), TYPED_COLUMNS), "faturamento"
    )


def _items(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The published items and the arriving ones, both read from one table written once.

    Made anew for each use, the items cost two shuffles of the lines every time.
    """
    items = Staging(spark)(fx.order_items(spark, d), "items")
    return fx.published_items(items), fx.arriving_items(items)


def items_delete_insert(spark: SparkSession, d: str) -> DataFrame:
    return delete_insert(*_items(spark, d), fx.ITEM_KEYS)


def items_tombstones(spark: SparkSession, d: str) -> DataFrame:
    return apply_tombstones(*_items(spark, d), fx.ITEM_KEYS)


def items_publish(spark: SparkSession, d: str) -> DataFrame:
    return publish_with_deletes(*_items(spark, d), fx.ITEM_KEYS)


def items_history(spark: SparkSession, d: str) -> DataFrame:
    return history_capture(*_items(spark, d), fx.ITEM_KEYS, "dt_atualizacao")


def items_full_history(spark: SparkSession, d: str) -> DataFrame:
    target, staged = _items(spark, d)
    archive = history_capture(target, staged, fx.ITEM_KEYS, "dt_atualizacao")
    published = publish_with_deletes(target, staged, fx.ITEM_KEYS)
    return full_history(archive, published, "dt_atualizacao")


DQ_COLUMNS = ("CHAVE_NFE", "CPF_CNPJ_CLIFOR", "LOTE_INTERNO", "COD_TRATAMENTO", "NR_NF")


def dq_not_null(spark: SparkSession, d: str) -> DataFrame:
    return quality.null_counts(fx.silver_invoices(spark, d, DQ_COLUMNS), DQ_COLUMNS)


def dq_unique(spark: SparkSession, d: str) -> DataFrame:
    return quality.repeated_keys(fx.silver_invoices(spark, d, ["CHAVE_NFE"]), ["CHAVE_NFE"])


def dq_models(spark: SparkSession, d: str) -> DataFrame:
    """The declared tests of every model, on its full load.

    Models of one source share one staged scan of the columns their tests look at.
    """
    tested = [m for m in MODELS.values() if m.not_null or m.unique]
    stage, results = Staging(spark), []
    needed = {c for m in tested if m.source == INVOICES for c in m.source_columns}
    sources = {INVOICES: stage(fx.silver_invoices(spark, d, sorted(needed)), "invoices")}
    for spec in tested:
        source = sources.setdefault(spec.source, None) or _source(spec, spark, d)
        full = gold_full(spec, source, fx.run_time())
        checks = quality.check_model(full, spec.not_null, spec.unique)
        results.append(checks.select(F.lit(spec.name).alias("model"), "*"))
    return reduce(DataFrame.unionByName, results)


def reconcile_rows(spark: SparkSession, d: str) -> DataFrame:
    return quality.reconcile(
        fx.orders_old(spark, d), fx.orders_new(spark, d), ignore=["o_totalprice"]
    )


def reconcile_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.reconcile_counts(
        fx.orders_old(spark, d), fx.orders_new(spark, d), ignore=["o_totalprice"]
    )


def reconcile_filtered(spark: SparkSession, d: str) -> DataFrame:
    return reconcile_rows(spark, d).filter(F.col("o_orderpriority") == "1-URGENT")


def reconcile_tree(spark: SparkSession, d: str) -> DataFrame:
    """A snapshot against one that differs in few rows."""
    return reconcile_by_tree(fx.orders_old(spark, d), fx.orders_edited(spark, d), ["o_orderkey"], Staging(spark))


def dq_increment(spark: SparkSession, d: str) -> DataFrame:
    """The checks of the commits from the split on, appended to the rows before."""
    feed = fx.invoice_feed(spark, d, DQ_COLUMNS).select(*DQ_COLUMNS, VERSION)
    seen, counted = observe_nulls(read_changes(feed, fx.SPLIT_VERSION), DQ_COLUMNS)
    written = Staging(spark)(seen, "increment")
    nulls = observed_failures(written, counted, DQ_COLUMNS)
    table = read_changes(feed, 0, fx.SPLIT_VERSION - 1).unionByName(written)
    return check_changed(table, written, ["CHAVE_NFE"], nulls)


def load_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Values of a bulk file that its declared columns do not take."""
    return load_with_rejects(fx.orders_as_text(spark, d), LOAD_COLUMNS, Staging(spark), ["o_orderkey"]).rejects


def load_typed(spark: SparkSession, d: str) -> DataFrame:
    """The rows of a bulk file that fit its declared columns."""
    return load_with_rejects(fx.orders_as_text(spark, d), LOAD_COLUMNS, Staging(spark), ["o_orderkey"]).rows


def _sql_increment(spec: ModelSpec) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        changes, tiebreak = _changes(spec, spark, d)
        function = create_feed_function(spark, f"changes_of_{spec.source}", changes)
        return spark.sql(increment_sql(spec, function, str(SQL_START), tiebreak))

    return query


def incremental_run_scalar(spark: SparkSession, d: str) -> DataFrame:
    """The run of ``incremental_run``, its watermark a subquery of the plan."""
    feed, tiebreak = _changes(FATO_FATURAMENTO, spark, d)
    processed = read_changes(feed, 0, fx.SPLIT_VERSION - 1)
    table = control.watermark_advance(
        control.watermark_seed(spark, [INVOICES], fx.run_time()),
        control.processed_version(INVOICES, processed),
        fx.run_time(),
    )
    state = gold_increment(FATO_FATURAMENTO, processed, tiebreak)
    rest = control.since_watermark(feed, table, INVOICES)
    rows = Staging(spark)(gold_increment(FATO_FATURAMENTO, rest, tiebreak), "rows")
    return upsert(state, rows, FATO_FATURAMENTO.keys)


def streamed_state(spark: SparkSession, d: str) -> DataFrame:
    """Users after a stream over the event feed, deletes applied, read from its state."""
    root, feed = _versions(spark), fx.event_feed(spark, d)
    feed.write.parquet(f"{root}/log")
    start_state_stream(
        spark, f"{root}/log", feed.schema, USERS, fx.EVENT_TIEBREAK, f"{root}/checkpoint", apply_deletes=True
    ).awaitTermination()
    return read_state(spark, USERS, f"{root}/checkpoint")


def profile_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.profile_counts(fx.silver_invoices(spark, d, DQ_COLUMNS), DQ_COLUMNS)


def preview_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.silver_invoices(
        spark, d, ("NR_NF", "NR_ITEM", "COD_PRODUTO", "COD_VENDEDOR", "VALOR_LIQUIDO")
    )
    order = [F.desc("VALOR_LIQUIDO"), "NR_NF", "NR_ITEM", "COD_PRODUTO", "COD_VENDEDOR"]
    return quality.top_rows(rows, order, PREVIEW_ROWS)


def event_state(spark: SparkSession, d: str) -> DataFrame:
    return snapshot_as_of(fx.event_feed(spark, d), EVENT_DAY, ["user_id"], fx.EVENT_TIEBREAK)


def _versions(spark: SparkSession) -> str:
    """A new folder for the tables of one call, dropped with the application."""
    return Staging(spark).path


def resume_with_late_commit(spark: SparkSession, d: str) -> DataFrame:
    """Gold after runs over a log whose commits arrive out of order.

    Commits below the split arrive first, then all above it, then the split itself;
    each arrival is followed by a run.
    """
    root = _versions(spark)
    feed = fx.invoice_feed(spark, d, FATO_FATURAMENTO.source_columns)
    arrivals = (
        read_changes(feed, 0, fx.SPLIT_VERSION - 1),
        read_changes(feed, fx.SPLIT_VERSION + 1),
        read_changes(feed, fx.SPLIT_VERSION, fx.SPLIT_VERSION),
    )
    source = Feed(f"{root}/log", fx.INVOICE_TIEBREAK)
    for rows in arrivals:
        append_changes(rows, source.log, spread=False)
        run_pipeline(
            spark, {INVOICES: source}, root, models=[FATO_FATURAMENTO], run_ts=fx.run_time(), checks=False
        )
    gold = read_version(spark, f"{root}/default/gold/{FATO_FATURAMENTO.name}")
    return gold.drop(STAMP)


def first_load_after_deletes(spark: SparkSession, d: str) -> DataFrame:
    """Gold of a first load from the source table, deletes applied, and the commits after it."""
    root = _versions(spark)
    feed = _feed_of(FATO_FATURAMENTO, spark, d)
    before = fx.SPLIT_VERSION - 1
    table = snapshot_as_of(feed, before, ["CHAVE_NFE"], fx.INVOICE_TIEBREAK)
    table.drop(CHANGE_TYPE, VERSION, COMMIT_TIME).write.parquet(f"{root}/silver")
    append_changes(read_changes(feed, fx.SPLIT_VERSION), f"{root}/log", spread=False)
    source = Feed(f"{root}/log", fx.INVOICE_TIEBREAK, table=f"{root}/silver", table_commit=before)
    run_pipeline(
        spark,
        {INVOICES: source},
        root,
        models=[FATO_FATURAMENTO],
        run_ts=fx.run_time(),
        apply_deletes=True,
        checks=False,
    )
    return read_version(spark, f"{root}/default/gold/{FATO_FATURAMENTO.name}").drop(STAMP)


def _feed_of(spec: ModelSpec, spark: SparkSession, d: str) -> DataFrame:
    return fx.invoice_feed(spark, d, spec.source_columns).filter(F.col("CHAVE_NFE").isNotNull())


def publish_stock_rerun(spark: SparkSession, d: str) -> DataFrame:
    """Stock, whose keys have NULL parts, published and published again."""
    root = _versions(spark)
    spec = PUBLISHED["fato_estoque"]
    gold = _increment(MODELS["fato_estoque"])(spark, d)
    for _ in range(2):
        publish(spark, spec, gold, root, inclusive=True)
    return read_version(spark, root)


def versioned_feed(spark: SparkSession, d: str) -> DataFrame:
    """A type-2 table rebuilt from its change log: the first load's commit and the next."""
    root = _versions(spark)
    history = scd2.active_rows(fx.order_history(spark, d))
    save_versioned(spark, history, f"{root}/table", fx.run_time(), f"{root}/log")
    save_versioned(spark, fx.order_current(spark, d), f"{root}/table", fx.run_time(), f"{root}/log")
    changes = open_changes(spark, f"{root}/log", 0)
    key = [*(c for c in history.columns if c not in (scd2.END, scd2.ACTIVE))]
    keyed = changes.withColumn("_row", F.xxhash64(*key))
    return snapshot_as_of(keyed, 1, ["_row", *key], [CHANGE_TYPE]).select(*history.columns)


def _bucketed(df: DataFrame, keys: tuple[str, ...], name: str) -> DataFrame:
    """A table of this call bucketed by key, in a folder dropped with the application."""
    spark = df.sparkSession
    folder = _versions(spark)
    table = f"{name}_{folder.rsplit('/', 1)[-1]}"
    return write_keyed(df, table, keys, buckets_of(spark), f"{folder}/{name}")


def upsert_bucketed_stock(spark: SparkSession, d: str) -> DataFrame:
    state, rows = _split(fx.stock_feed(spark, d), STOCK_KEYS, fx.STOCK_TIEBREAK)
    target, staged = _bucketed(state, STOCK_KEYS, "stock"), _bucketed(rows, STOCK_KEYS, "staged")
    return without_hash(upsert_bucketed(target, staged, STOCK_KEYS, null_safe=True))


def history_bucketed_items(spark: SparkSession, d: str) -> DataFrame:
    published, arriving = _items(spark, d)
    target = _bucketed(published, fx.ITEM_KEYS, "items")
    staged = _bucketed(arriving, fx.ITEM_KEYS, "staged")
    return history_bucketed(target, staged, fx.ITEM_KEYS, "dt_atualizacao")


def item_bounds(spark: SparkSession, d: str) -> DataFrame:
    return file_bounds(spark, f"{d}/lineitem.parquet", BOUND_COLUMNS)


def event_bounds(spark: SparkSession, d: str) -> DataFrame:
    return file_bounds(spark, f"{d}/events.parquet", ["event_id", "ts"])


def published_together(spark: SparkSession, d: str) -> DataFrame:
    """Rows of every model's published table, all published at a time."""
    root = _versions(spark)
    jobs = [(PUBLISHED[name], _increment(spec)(spark, d), f"{root}/{name}") for name, spec in MODELS.items()]
    for outcome in publish_together(spark, jobs):
        if outcome.error:
            raise RuntimeError(f"{outcome.name}: {outcome.error}")
    counts = [
        read_version(spark, target).agg(F.lit(spec.name).alias("name"), F.count("*").alias("n_rows"))
        for spec, _, target in jobs
    ]
    return reduce(DataFrame.unionByName, counts)


def queries() -> dict[str, Query]:
    named: dict[str, Query] = {
        "scan_silver": scan_silver,
        "change_feed_scan": change_feed_scan,
        "change_feed_upserts": change_feed_upserts,
        "latest_by_key": latest,
        "latest_by_composite_key": latest_composite,
        "snapshot_as_of": as_of,
        "event_state": event_state,
    }
    named.update({f"gold_full_{name}": _full(spec) for name, spec in MODELS.items()})
    named.update({f"gold_incr_{name}": _increment(spec) for name, spec in MODELS.items()})
    named.update({f"sql_incr_{name}": _sql_increment(spec) for name, spec in MODELS.items()})
    named.update(
        {
            "undefined_code_default": _full(UNDEFINED_SPEC),
            "upsert_single_key": upsert_single_key,
            "upsert_item_grain": upsert_item_grain,
            "upsert_composite_key": upsert_composite_key,
            "watermark_advance": watermark_advance,
            "watermark_lookup": watermark_lookup,
            "incremental_run": incremental_run,
            "incremental_run_scalar": incremental_run_scalar,
            "feed_from_first_load": feed_from_first_load,
            "snapshot_diff_feed": snapshot_diff_feed,
            "snapshot_inserts": snapshot_inserts,
            "snapshot_deletes": snapshot_deletes,
            "scd2_change_counts": scd2_change_counts,
            "scd2_close_out": scd2_close_out,
            "scd2_attach_status": scd2_attach_status,
            "scd2_apply": scd2_apply,
            "active_export": active_export,
            "row_fingerprint": row_fingerprint,
            "target_high_water": high_water,
            "incremental_since": since_high_water,
            "declared_schema_cast": declared_schema_cast,
            "publish_stage": publish_stage,
            "delete_insert": items_delete_insert,
            "apply_tombstones": items_tombstones,
            "publish_with_deletes": items_publish,
            "history_capture": items_history,
            "full_history": items_full_history,
            "dq_not_null": dq_not_null,
            "dq_unique": dq_unique,
            "dq_models": dq_models,
            "reconcile_rows": reconcile_rows,
            "reconcile_counts": reconcile_counts,
            "reconcile_filtered": reconcile_filtered,
            "reconcile_tree": reconcile_tree,
            "dq_increment": dq_increment,
            "load_rejects": load_rejects,
            "load_typed": load_typed,
            "streamed_state": streamed_state,
            "upsert_bucketed": upsert_bucketed_stock,
            "history_bucketed": history_bucketed_items,
            "item_bounds": item_bounds,
            "event_bounds": event_bounds,
            "published_together": published_together,
            "profile_counts": profile_counts,
            "preview_rows": preview_rows,
            "resume_with_late_commit": resume_with_late_commit,
            "first_load_after_deletes": first_load_after_deletes,
            "publish_stock_rerun": publish_stock_rerun,
            "versioned_feed": versioned_feed,
        }
    )
    return named
