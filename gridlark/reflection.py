"""What tables a connection has, their columns and declared types."""

from __future__ import annotations

from typing import Any

from pyspark.sql import functions as F

from gridlark.errors import BackendOperationError
from gridlark.functions import values as v
from gridlark.sources.catalog import METADATA


def list_tables(connection: Any, include_meta: bool = False) -> list[str]:
    return [t for t in connection.catalog.names() if include_meta or t != METADATA]


def has_table(connection: Any, table: str) -> bool:
    return connection.catalog.find(table) is not None


#: The names of kinds.
_NAMES = {v.INT: "INTEGER", v.REAL: "FLOAT", v.TEXT: "TEXT", v.BOOL: "BOOLEAN", v.DATE: "DATE", v.DATETIME: "DATETIME"}


def get_columns(connection: Any, table: str, sample_size: int | None = 100) -> list[dict[str, Any]]:
    """Columns with their types, and whether the first rows hold nulls; all rows if sample_size is None. A column without
    values there is text."""
    catalog = connection.catalog
    name = catalog.find(table)
    if name is None:
        raise BackendOperationError(f"Table {table!r} not found")
    relation = catalog.resolve(name)
    df = relation.df.orderBy(relation.ordinal) if relation.ordinal else relation.df
    sample = df if sample_size is None else df.limit(sample_size)
    rows, *filled = sample.agg(F.count(F.lit(1)), *[F.count(F.col(f"`{c}`")) for c in relation.columns]).first()
    kinds = {f.name: v.kind_of(f.dataType) for f in relation.df.schema.fields}
    out = []
    for column, n in zip(relation.columns, filled, strict=True):
        kind = _NAMES[kinds[column]] if n else "TEXT"
        out.append({"name": column, "type_name": kind, "type": kind, "nullable": n < rows or not n})
    return out


def read_table_metadata(connection: Any, table: str) -> list[dict[str, Any]] | None:
    return connection.catalog.declared(table)


def write_table_metadata(connection: Any, table: str, columns: list[dict[str, Any]]) -> None:
    connection.catalog.declare(table, columns)


def remove_table_metadata(connection: Any, table: str) -> None:
    if connection.catalog.find(METADATA):
        connection.catalog.declare(table, None)
