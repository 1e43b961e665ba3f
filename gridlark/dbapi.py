"""PEP 249: connections and cursors over a catalog of tables."""

from __future__ import annotations

import datetime as dt
import itertools
import time
from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import SparkSession

from gridlark import errors as e
from gridlark.functions import values as v
from gridlark.plans.session import Outcome, execute
from gridlark.sources.catalog import Catalog
from gridlark.sources.registry import default_session, store_for
from gridlark.sql import ast as a
from gridlark.sql.parser import parse

#: A result of at most so many rows is held by its cursor; a larger one is counted, and read as it is fetched.
HELD_ROWS = 10_000

apilevel, threadsafety, paramstyle = "2.0", 1, "qmark"

Date, Time, Timestamp = dt.date, dt.time, dt.datetime


def DateFromTicks(ticks: float) -> dt.date:  # noqa: N802
    return dt.date(*time.localtime(ticks)[:3])


def TimeFromTicks(ticks: float) -> dt.time:  # noqa: N802
    return dt.time(*time.localtime(ticks)[3:6])


def TimestampFromTicks(ticks: float) -> dt.datetime:  # noqa: N802
    return dt.datetime(*time.localtime(ticks)[:6])


def Binary(value: Any) -> bytes:  # noqa: N802
    return bytes(value)


class _Type:
    """Equal to the kinds it stands for."""

    def __init__(self, *kinds: str):
        self.kinds = frozenset(kinds)

    def __eq__(self, other: object) -> bool:
        return other in self.kinds if isinstance(other, str) else self is other

    def __hash__(self) -> int:
        return hash(self.kinds)


STRING, BINARY, NUMBER, DATETIME, ROWID = _Type(v.TEXT), _Type("binary"), _Type(v.INT, v.REAL), _Type(v.DATE, v.DATETIME), _Type("rowid")


def connect(location: str, engine: str | None = None, *, autocommit: bool = True, sanitize_formulas: bool = True, spark: SparkSession | None = None, **options: Any) -> Connection:
    """A connection to a workbook or a folder of parquet tables.

    options go to the store: create, data_only, backup, backup_dir, warn_rows, max_rows, max_memory_mb for workbooks.
    """
    return Connection(location, engine, autocommit, sanitize_formulas, spark, options)


def _open(method):
    def checked(self, *args, **kwargs):
        if self.closed:
            raise e.InterfaceError(f"{type(self).__name__} is closed")
        return method(self, *args, **kwargs)

    checked.__name__, checked.__doc__ = method.__name__, method.__doc__
    return checked


class Connection:
    Warning, Error, InterfaceError, DatabaseError, DataError = e.Warning, e.Error, e.InterfaceError, e.DatabaseError, e.DataError
    OperationalError, IntegrityError, InternalError, ProgrammingError, NotSupportedError = (
        e.OperationalError, e.IntegrityError, e.InternalError, e.ProgrammingError, e.NotSupportedError,
    )

    def __init__(self, location: str, engine: str | None, autocommit: bool, sanitize: bool, spark: SparkSession | None, options: dict[str, Any]):
        self.closed = False
        self.location, self.sanitize = location, sanitize
        self.engine_name, self.store = store_for(location, engine, **options)
        self.catalog = Catalog(spark or default_session())
        try:
            self.store.load(self.catalog)
        except e.Error:
            raise
        except Exception as error:
            raise e.mapped(error) from error
        self._autocommit = autocommit
        self._kept = self.catalog.snapshot()

    @property
    def autocommit(self) -> bool:
        return self._autocommit

    @autocommit.setter
    def autocommit(self, on: bool) -> None:
        if on and not self._autocommit:
            self.commit()
        self._autocommit = bool(on)

    @property
    def workbook(self) -> Catalog:
        return self.catalog

    @_open
    def cursor(self) -> Cursor:
        return Cursor(self)

    @_open
    def commit(self) -> None:
        if self.catalog.tables != self._kept:
            try:
                self.store.save(self.catalog)
            except e.Error:
                raise
            except Exception as error:
                raise e.mapped(error) from error
        self._kept = self.catalog.snapshot()

    @_open
    def rollback(self) -> None:
        if self._autocommit:
            raise e.NotSupportedError("rollback() needs autocommit to be off")
        if not self.store.transactions:
            raise e.NotSupportedError(f"Engine {self.engine_name} has no transactions")
        self.catalog.restore(self._kept)

    @_open
    def execute(self, sql: str, params: Sequence[Any] | None = None) -> Cursor:
        cursor = self.cursor()
        cursor.execute(sql, params)
        return cursor

    @_open
    def executemany(self, sql: str, rows: Sequence[Sequence[Any]]) -> Cursor:
        cursor = self.cursor()
        cursor.executemany(sql, rows)
        return cursor

    def _run(self, sql: str, rows: Sequence[Sequence[Any]]) -> list[Outcome]:
        """The statement once for each row of parameters: all of them take effect, or none."""
        before = self.catalog.snapshot()
        try:
            changing = not isinstance(parse(sql)[0], a.QUERIES)
            if changing and not self.store.readonly:
                self.store.before_change()
            out = [execute(self.catalog, sql, tuple(r), sanitize=self.sanitize, readonly=self.store.readonly) for r in rows]
            if changing and self._autocommit:
                self.commit()
            return out
        except Exception as error:
            self.catalog.restore(before)
            raise e.mapped(error) from error

    def close(self) -> None:
        """Without committing."""
        if not self.closed:
            self.store.close()
            self.closed = True

    def __enter__(self) -> Connection:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def __repr__(self) -> str:
        return f"Connection({self.location!r}, engine={self.engine_name!r}{', closed' if self.closed else ''})"


class Cursor:
    arraysize = 1

    def __init__(self, connection: Connection):
        self.connection, self.closed = connection, False
        self._reset()

    def _reset(self) -> None:
        self.description: list[tuple] | None = None
        self.rowcount, self.lastrowid = -1, None
        self.rows: Iterator[tuple] | None = None

    @_open
    def execute(self, sql: str, params: Sequence[Any] | None = None) -> Cursor:
        self._check()
        self._reset()
        self._keep(self.connection._run(sql, [params or ()])[0])
        return self

    @_open
    def executemany(self, sql: str, rows: Sequence[Sequence[Any]]) -> Cursor:
        self._check()
        self._reset()
        if rows and isinstance(parse(sql)[0], a.QUERIES):
            raise e.ProgrammingError("executemany() is for statements that change data")
        done = self.connection._run(sql, rows) if rows else []
        self.rowcount = sum(max(0, o.rowcount) for o in done)
        self.lastrowid = next((o.lastrowid for o in reversed(done) if o.lastrowid is not None), None)
        return self

    def _keep(self, outcome: Outcome) -> None:
        self.rowcount, self.lastrowid = outcome.rowcount, outcome.lastrowid
        if outcome.result is not None:
            df = outcome.result.df
            try:
                first = df.limit(HELD_ROWS + 1).collect()
                self.rowcount = len(first) if len(first) <= HELD_ROWS else df.count()
            except Exception as error:
                raise e.mapped(error) from error
            # a larger result comes partition by partition as it is fetched
            self.rows = map(tuple, first if len(first) <= HELD_ROWS else df.toLocalIterator(prefetchPartitions=True))
            self.description = [(l, x.kind, None, None, None, None, None) for l, x in zip(outcome.result.labels, outcome.result.values, strict=True)]

    def _check(self) -> None:
        if self.connection.closed:
            raise e.InterfaceError("Connection is closed")

    def _fetched(self, size: int | None) -> list[tuple]:
        self._check()
        if self.rows is None:
            raise e.ProgrammingError("There are no rows to fetch")
        try:
            return list(self.rows if size is None else itertools.islice(self.rows, size))
        except Exception as error:
            raise e.mapped(error) from error

    @_open
    def fetchone(self) -> tuple | None:
        return next(iter(self._fetched(1)), None)

    @_open
    def fetchmany(self, size: int | None = None) -> list[tuple]:
        return self._fetched(self.arraysize if size is None else size)

    @_open
    def fetchall(self) -> list[tuple]:
        return self._fetched(None)

    def __iter__(self):
        return iter(self.fetchone, None)

    def setinputsizes(self, sizes: Any) -> None:
        pass

    def setoutputsize(self, size: int, column: int | None = None) -> None:
        pass

    def close(self) -> None:
        self.closed = True

    def __enter__(self) -> Cursor:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()
