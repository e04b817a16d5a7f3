"""Change feeds as SQL table functions, and the models as SQL text over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lakeops.functions.columns import UNDEFINED_CODE
from lakeops.operators.changes import CHANGE_TYPE, COMMIT_TIME, INSERT, POSTIMAGE, VERSION
from lakeops.plans.specs import STAMP, ModelSpec


def create_feed_function(spark: SparkSession, name: str, changes: DataFrame) -> str:
    """Make a change feed callable in SQL: ``SELECT * FROM name(start)``; returns the name.

    A temporary table function over a temporary view: Spark puts its body in the place
    of each call, so filters, column pruning and partition pruning reach the feed's
    scan and no Python runs. ``start`` is the first commit, as with ``read_changes``;
    a call with NULL gives no rows. A function of that name is replaced, for later calls.
    """
    view = f"{name}_rows"
    changes.createOrReplaceTempView(view)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in changes.schema)
    names = ", ".join(f"`{f.name}`" for f in changes.schema)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(start BIGINT) RETURNS TABLE ({columns}) "
        f"RETURN SELECT {names} FROM {view} WHERE {VERSION} >= {name}.start"
    )
    return name


def increment_sql(spec: ModelSpec, function: str, start: str, tiebreak: Sequence[str]) -> str:
    """A model's incremental run as SQL over a feed function.

    ``start`` is an SQL expression: a number, or a parameter such as ``:start``. The rows
    are those of ``gold_increment`` from that commit on.
    """

    def gold(name: str, silver: str) -> str:
        return f"coalesce(`{silver}`, '{UNDEFINED_CODE}') AS `{name}`" if name in spec.undefined else f"`{silver}` AS `{name}`"

    where = [f"{CHANGE_TYPE} IN ('{INSERT}', '{POSTIMAGE}')"]
    if spec.require_key:
        where += [f"`{key}` IS NOT NULL" for key in spec.source_keys]
    columns = [gold(name, silver) for name, silver in spec.columns.items()]
    columns += [f"{COMMIT_TIME} AS {STAMP}", *([VERSION] if spec.keep_version else [])]
    order = [f"{VERSION} DESC NULLS LAST", *(f"`{c}` ASC NULLS LAST" for c in tiebreak)]
    keys = ", ".join(f"`{key}`" for key in spec.source_keys)
    return (
        f"WITH changed AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {', '.join(order)}) AS rn "
        f"FROM {function}({start}) WHERE {' AND '.join(where)}) "
        f"SELECT {', '.join(columns)} FROM changed WHERE rn = 1"
    )
