from lakeops.functions.columns import (
    literal_timestamp,
    match_keys,
    default_code,
    row_hash,
    stamp_column,
)
from lakeops.functions.types import (
    cast_columns,
    create_table_sql,
    declared_schema,
    parse_type,
)

__all__ = [
    "cast_columns",
    "create_table_sql",
    "declared_schema",
    "default_code",
    "literal_timestamp",
    "match_keys",
    "parse_type",
    "row_hash",
    "stamp_column",
]
