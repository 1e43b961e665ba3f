"""Tables by name as immutable versions; a snapshot is a copy of the dictionary."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlark.errors import BackendOperationError, OperationalError, SqlSemanticError
from gridlark.functions.values import BOOL, DATE, DATETIME, INT, REAL, TEXT, kind_of
from gridlark.plans.scope import ORDINAL, Relation
from gridlark.sources import inference

#: The table that keeps declared types (fixed value of the format).
METADATA = "__excel_meta__"
METADATA_COLUMNS = ("table_name", "column_name", "ordinal", "type_name", "nullable", "primary_key")

_TYPES = {INT: T.LongType(), REAL: T.DoubleType(), TEXT: T.StringType(), BOOL: T.BooleanType(), DATE: T.DateType(), DATETIME: T.TimestampNTZType()}


def spark_type(kind: str) -> T.DataType:
    return _TYPES[kind]


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. A temporary one only on a local master, where none is set."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise OperationalError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="gridlark-checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df without its lineage: written as parquet to the shared folder and read from there, so that later queries read
    only the columns and rows they need. The files go when the process ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/version-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_forget, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _forget(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def relation_of(spark: SparkSession, columns: Iterable[str], rows: list[list[Any]]) -> Relation:
    """A table of cells: types from all of them, the order of rows kept."""
    columns = tuple(columns)
    kinds, dynamic = [], set()
    for place, name in enumerate(columns):
        kind, loose = inference.column_kind([r[place] for r in rows])
        kinds.append(kind)
        if loose:
            dynamic.add(name)
    schema = T.StructType([T.StructField(c, spark_type(k)) for c, k in zip(columns, kinds, strict=True)] + [T.StructField(ORDINAL, T.LongType())])
    cells = [(*(inference.as_kind(x, k) for x, k in zip(r, kinds, strict=True)), i) for i, r in enumerate(rows)]
    return Relation(spark.createDataFrame(cells, schema), columns, frozenset(dynamic), ORDINAL)


class Catalog:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.tables: dict[str, Relation] = {}

    def names(self) -> list[str]:
        return list(self.tables)

    def find(self, name: str) -> str | None:
        return next((t for t in self.tables if t.casefold() == name.casefold()), None)

    def need(self, name: str) -> str:
        found = self.find(name)
        if found is None:
            shown = ", ".join(t for t in self.tables if t != METADATA)
            raise SqlSemanticError(f"Table {name!r} not found. Available: {shown}")
        return found

    def resolve(self, name: str) -> Relation:
        return self.tables[self.need(name)]

    def put(self, name: str, relation: Relation) -> None:
        self.tables[self.find(name) or name] = relation

    def drop(self, name: str) -> None:
        del self.tables[self.need(name)]

    def rename_free(self, name: str) -> None:
        if self.find(name) is not None:
            raise BackendOperationError(f"Table {name!r} already exists")

    def snapshot(self) -> dict[str, Relation]:
        return dict(self.tables)

    def restore(self, tables: dict[str, Relation]) -> None:
        self.tables = dict(tables)

    def rows(self, name: str) -> Iterator[list[Any]]:
        """A table's rows in order, one after the other at the driver: for saving a workbook and for declared types."""
        t = self.resolve(name)
        df = t.df.orderBy(t.ordinal) if t.ordinal else t.df
        return map(list, df.select(*[F.col(f"`{c}`") for c in t.columns]).toLocalIterator())

    # declared types

    def declared(self, table: str) -> list[dict[str, Any]] | None:
        if self.find(METADATA) is None:
            return None
        rows = [r for r in self.rows(METADATA) if str(r[0]).casefold() == table.casefold()]
        if not rows:
            return None
        rows.sort(key=lambda r: int(r[2] or 0))
        return [{"name": r[1], "type_name": r[3], "nullable": str(r[4]) == "True", "primary_key": str(r[5]) == "True"} for r in rows]

    def declare(self, table: str, columns: list[dict[str, Any]] | None) -> None:
        """Replaces a table's entries; None takes them away."""
        kept = [r for r in self.rows(METADATA) if str(r[0]).casefold() != table.casefold()] if self.find(METADATA) else []
        for place, c in enumerate(columns or (), 1):
            kept.append([table, c["name"], place, c.get("type_name", c.get("type", "TEXT")), str(c.get("nullable", True)), str(c.get("primary_key", False))])
        if kept or self.find(METADATA) or columns:
            self.put(METADATA, relation_of(self.spark, METADATA_COLUMNS, kept))


def parquet_relation(spark: SparkSession, path: str) -> Relation:
    df = spark.read.parquet(path)
    kept = tuple(f.name for f in df.schema.fields if kind_of(f.dataType) != "other")
    return Relation(df, kept)
