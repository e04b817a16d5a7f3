"""Declared column types: parsing, casts and DDL."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DECIMAL = re.compile(r"DECIMAL(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?$")
_PLAIN = {
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "BOOLEAN": T.BooleanType(),
}


def parse_type(text: str) -> T.DataType | None:
    """Spark type of a declared type; None for a type that is passed through.

    A bare DECIMAL is (18,4) and DECIMAL(p) has scale 0. A VARCHAR length is not
    part of the cast, only of the DDL.
    """
    name = text.strip().upper()
    decimal = _DECIMAL.match(name)
    if decimal:
        precision, scale = decimal.groups()
        if precision is None:
            return T.DecimalType(18, 4)
        return T.DecimalType(int(precision), int(scale or 0))
    if name.startswith("VARCHAR"):
        return T.StringType()
    return _PLAIN.get(name)


def declared_schema(columns: Mapping[str, str]) -> T.StructType:
    """Schema of a declared table; a type that is not known is an error here."""
    fields = []
    for name, text in columns.items():
        dtype = parse_type(text)
        if dtype is None:
            raise ValueError(f"column {name}: no Spark type for {text!r}")
        fields.append(T.StructField(name, dtype))
    return T.StructType(fields)


def cast_columns(
    df: DataFrame, columns: Mapping[str, str], on_error: str = "raise"
) -> DataFrame:
    """Keep the declared columns, in declared order, cast to their declared type.

    ``on_error="null"`` turns values that do not fit into NULL; ``"raise"`` fails
    the job on the first one (ANSI casts).
    """
    if on_error not in ("raise", "null"):
        raise ValueError("on_error must be 'raise' or 'null'")

    def typed(name: str, text: str) -> Column:
        dtype = parse_type(text)
        column = F.col(name)
        if dtype is None:
            return column
        cast = column.try_cast(dtype) if on_error == "null" else column.cast(dtype)
        return cast.alias(name)

    return df.select(*[typed(name, text) for name, text in columns.items()])


def check_lengths(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``df`` with its declared VARCHAR(n) and CHAR(n) columns; a longer value fails the job.

    As a warehouse does on write; the check is part of the same pass.
    """

    def checked(name: str) -> Column:
        declared = re.match(r"\s*(?:VAR)?CHAR\s*\(\s*(\d+)\s*\)", columns.get(name, ""), re.I)
        column = F.col(name)
        if declared is None:
            return column
        message = F.concat(F.lit(f"{name} is declared {columns[name]}, a value has "), F.char_length(column).cast("string"))
        too_long = F.char_length(column) > int(declared[1])
        return F.when(too_long, F.raise_error(message)).otherwise(column).alias(name)

    return df.select(*[checked(name) for name in df.columns])


def create_table_sql(
    table: str,
    columns: Mapping[str, str],
    primary_keys: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    buckets: int = 0,
    file_format: str = "parquet",
) -> str:
    """CREATE TABLE statement for a declared table.

    VARCHAR(n) is kept, so Spark checks lengths on write as a warehouse does.
    Primary keys are not enforced by file tables and become a table property;
    ``cluster_by``/``sort_by`` become buckets.
    """
    body = ", ".join(f"`{name}` {text}" for name, text in columns.items())
    sql = f"CREATE TABLE IF NOT EXISTS {table} ({body}) USING {file_format}"
    if cluster_by:
        if buckets < 1:
            raise ValueError("cluster_by needs a number of buckets")
        sql += f" CLUSTERED BY ({', '.join(cluster_by)})"
        if sort_by:
            sql += f" SORTED BY ({', '.join(sort_by)})"
        sql += f" INTO {buckets} BUCKETS"
    if primary_keys:
        sql += f" TBLPROPERTIES ('primary_key' = '{','.join(primary_keys)}')"
    return sql


def create_staging_sql(table: str, columns: Mapping[str, str], file_format: str = "parquet") -> str:
    """The staging twin of a declared table: same columns, no key."""
    return create_table_sql(f"{table}_staging", columns, file_format=file_format)
