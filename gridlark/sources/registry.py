"""Table stores by engine name and by scheme of the connection string."""

from __future__ import annotations

import os
import shutil
import time
import warnings
from collections.abc import Callable
from typing import Any, Protocol

from pyspark.sql import SparkSession

from gridlark.errors import InterfaceError, NotSupportedError, OperationalError
from gridlark.sources import patch
from gridlark.sources.catalog import METADATA, Catalog, parquet_relation, relation_of
from gridlark.sources.remote import SCHEMES, RemoteStore
from gridlark.sources.xlsx import read_workbook, write_workbook


class TableStore(Protocol):
    """Fills a catalog and keeps it."""

    readonly: bool
    transactions: bool

    def load(self, catalog: Catalog) -> None: ...

    def save(self, catalog: Catalog) -> None: ...

    def close(self) -> None: ...


class WorkbookStore:
    """A local .xlsx file. Saving replaces the file at once; a lock file keeps other writers away."""

    readonly, transactions = False, True

    def __init__(self, path: str, *, create: bool = False, data_only: bool = True, backup: bool = False, backup_dir: str | None = None,
                 warn_rows: int | None = None, max_rows: int | None = None, max_memory_mb: float | None = None, **unknown: Any):
        if unknown:
            raise InterfaceError(f"Unknown options: {', '.join(sorted(unknown))}")
        self.path, self.data_only = path, data_only
        self.backup, self.backup_dir, self.backed_up = backup, backup_dir, False
        self.warn_rows = _positive("warn_rows", warn_rows)
        self.max_rows = _positive("max_rows", max_rows)
        self.max_memory_mb = _positive("max_memory_mb", max_memory_mb)
        self.locked = False
        self.saved: dict[str, Any] = {}
        if create and not os.path.exists(path):
            write_workbook(path, [("Sheet", [], iter(()))])
        if not os.path.exists(path):
            raise OperationalError(f"No such workbook: {path}")

    def load(self, catalog: Catalog) -> None:
        for sheet in read_workbook(self.path, cached_values=self.data_only):
            self._guard(sheet.name, sheet.rows)
            catalog.tables[sheet.name] = relation_of(catalog.spark, sheet.headers, sheet.rows)
        self.saved = catalog.snapshot()

    def _guard(self, name: str, rows: list) -> None:
        n = len(rows)
        if self.max_rows is not None and n > self.max_rows:
            raise OperationalError(f"Sheet {name!r} has {n} rows, more than max_rows={self.max_rows}")
        for limit in (self.warn_rows, self.max_rows and int(self.max_rows * 0.8)):
            if limit and n >= limit:
                warnings.warn(f"Sheet {name!r} has {n} rows", UserWarning, stacklevel=4)
                break
        if self.max_memory_mb is not None:
            mb = sum(len(str(x)) + 50 for r in rows for x in r) / 1e6
            if mb > self.max_memory_mb:
                raise OperationalError(f"Sheet {name!r} takes about {mb:.1f} MB, more than max_memory_mb={self.max_memory_mb}")

    def lock(self) -> None:
        """Taken before the first change. A lock of a process that is gone is cleared."""
        if self.locked:
            return
        name = f"{self.path}.lock"
        for _ in range(2):
            try:
                with os.fdopen(os.open(name, os.O_CREAT | os.O_EXCL | os.O_WRONLY), "w") as f:
                    f.write(str(os.getpid()))
                self.locked = True
                return
            except FileExistsError:
                with open(name, encoding="utf-8") as f:
                    holder = f.read().strip()
                if holder.isdigit() and _alive(int(holder)):
                    raise OperationalError(f"{self.path} is locked by process {holder}") from None
                os.unlink(name)
        raise OperationalError(f"{self.path} is locked")

    def before_change(self) -> None:
        self.lock()
        if self.backup and not self.backed_up:
            folder = self.backup_dir or os.path.dirname(os.path.abspath(self.path))
            os.makedirs(folder, exist_ok=True)
            stem, tail = os.path.splitext(os.path.basename(self.path))
            shutil.copy2(self.path, os.path.join(folder, f"{stem}.{time.strftime('%Y%m%d-%H%M%S')}{tail}"))
            self.backed_up = True

    def save(self, catalog: Catalog) -> None:
        """Sheets that are as they were read or last saved are left alone."""
        names = sorted(catalog.tables, key=lambda t: t == METADATA)
        changed = [t for t in names if catalog.tables[t] is not self.saved.get(t)]
        patch.save(self.path, {t: (list(catalog.tables[t].columns), catalog.rows(t)) for t in changed}, set(names) - set(changed), cached=self.data_only)
        self.saved = catalog.snapshot()

    def close(self) -> None:
        if self.locked:
            os.unlink(f"{self.path}.lock")
            self.locked = False


class ParquetStore:
    """A folder of parquet tables, name.parquet each; for queries only."""

    readonly, transactions = True, False

    def __init__(self, path: str, **unknown: Any):
        if unknown:
            raise InterfaceError(f"Unknown options: {', '.join(sorted(unknown))}")
        self.path = path.removeprefix("parquet://")

    def load(self, catalog: Catalog) -> None:
        jvm = catalog.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = folder.getFileSystem(catalog.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            raise OperationalError(f"No such folder: {self.path}")
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if name.endswith(".parquet"):
                catalog.put(name.removesuffix(".parquet"), parquet_relation(catalog.spark, status.getPath().toString()))

    def before_change(self) -> None:
        raise NotSupportedError("Parquet folders are read-only")

    def save(self, catalog: Catalog) -> None:
        raise NotSupportedError("Parquet folders are read-only")

    def close(self) -> None:
        pass


_stores: dict[str, Callable[..., TableStore]] = {}
_schemes: dict[str, str] = {}


def register_engine(name: str, factory: Callable[..., TableStore], schemes: tuple[str, ...] = ()) -> None:
    _stores[name.lower()] = factory
    for scheme in schemes:
        _schemes[scheme.lower()] = name.lower()


def store_for(location: str, engine: str | None, **options: Any) -> tuple[str, TableStore]:
    scheme = location.partition("://")[0].lower() if "://" in location else None
    named = _schemes.get(scheme) if scheme else None
    if engine is not None and named is not None and engine.lower() != named:
        raise InterfaceError(f"Engine {engine!r} does not fit {scheme}://")
    if scheme and named is None and engine is None:
        raise InterfaceError(f"No engine for {scheme}://")
    name = (engine or named or ("parquet" if os.path.isdir(location) else "workbook")).lower()
    if name not in _stores:
        raise InterfaceError(f"Unknown engine: {name}. Known: {', '.join(sorted(_stores))}")
    return name, _stores[name](location, **options)


def _positive(what: str, value: Any) -> Any:
    if value is not None and (isinstance(value, bool) or not isinstance(value, int | float) or value <= 0):
        raise InterfaceError(f"{what} must be a positive number")
    return value


def _alive(pid: int) -> bool:
    try:
        os.kill(pid, 0)
    except ProcessLookupError:
        return False
    except PermissionError:
        return True
    return True


register_engine("workbook", WorkbookStore)
register_engine("parquet", ParquetStore, ("parquet",))
register_engine("graph", RemoteStore, (*SCHEMES, "https"))


def default_session() -> SparkSession:
    return SparkSession.getActiveSession() or (
        SparkSession.builder.master(os.environ.get("GRIDLARK_MASTER", "local[*]"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
