"""A PySpark-native engine for a small SQL dialect over workbooks and tables, with operators for training-data pipelines."""

from gridlark.dbapi import (
    BINARY, DATETIME, NUMBER, ROWID, STRING, Binary, Connection, Cursor, Date, DateFromTicks, Time, TimeFromTicks, Timestamp, TimestampFromTicks, apilevel, connect,
    paramstyle, threadsafety,
)
from gridlark.errors import (
    DatabaseError, DataError, Error, IntegrityError, InterfaceError, InternalError, NotSupportedError, OperationalError, ProgrammingError, Warning,
)
from gridlark.plans.session import Engine
from gridlark.reflection import get_columns, has_table, list_tables, read_table_metadata, remove_table_metadata, write_table_metadata
from gridlark.sources.catalog import METADATA
from gridlark.sources.registry import register_engine

__version__ = "0.2.0"

__all__ = [
    "BINARY", "DATETIME", "METADATA", "NUMBER", "ROWID", "STRING", "Binary", "Connection", "Cursor", "DataError", "DatabaseError", "Date", "DateFromTicks", "Engine",
    "Error", "IntegrityError", "InterfaceError", "InternalError", "NotSupportedError", "OperationalError", "ProgrammingError", "Time", "TimeFromTicks", "Timestamp",
    "TimestampFromTicks", "Warning", "__version__", "apilevel", "connect", "get_columns", "has_table", "list_tables", "paramstyle", "read_table_metadata",
    "register_engine", "remove_table_metadata", "threadsafety", "write_table_metadata",
]
