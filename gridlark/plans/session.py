"""Runs one statement against a catalog: what the DB-API layer and the driver queries share."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from gridlark.errors import CapabilityError, SqlSemanticError
from gridlark.operators import ddl
from gridlark.operators.dml import Changes
from gridlark.plans.relations import Compiler, Result
from gridlark.sources.catalog import Catalog, parquet_relation
from gridlark.sql import ast as a
from gridlark.sql.parser import parse


@dataclass
class Outcome:
    action: str
    result: Result | None = None
    rowcount: int = -1
    lastrowid: int | None = None


MUTATING = (a.Insert, a.Update, a.Delete, a.Create, a.Drop, a.Alter)


def execute(catalog: Catalog, sql: str, params: tuple = (), *, sanitize: bool = True, readonly: bool = False) -> Outcome:
    node, wanted = parse(sql)
    if wanted != len(params):
        raise SqlSemanticError(f"The statement takes {wanted} parameters, {len(params)} were given")
    if isinstance(node, MUTATING) and readonly:
        raise CapabilityError(f"{type(node).__name__.upper()} is not supported by a read-only connection")
    action = type(node).__name__.upper()
    match node:
        case a.Insert() | a.Update() | a.Delete():
            done = Changes(catalog, params, sanitize).run(node)
            return Outcome(action, rowcount=done.rowcount, lastrowid=done.lastrowid)
        case a.Create() | a.Drop() | a.Alter():
            ddl.run(catalog, node, sanitize)
            return Outcome(action)
    return Outcome("SELECT", Compiler(catalog.resolve, params).compile(node))


class Engine:
    """SQL of the dialect over parquet tables, as DataFrames: nothing runs until an action does."""

    def __init__(self, spark: SparkSession, tables: dict[str, str] | None = None):
        self.catalog = Catalog(spark)
        for name, path in (tables or {}).items():
            self.register(name, path)

    def register(self, name: str, path: str) -> None:
        self.catalog.put(name, parquet_relation(self.catalog.spark, path))

    def sql(self, text: str, *params) -> DataFrame | Outcome:
        """The rows of a query under its output labels; of other statements the outcome."""
        outcome = execute(self.catalog, text, params)
        return outcome.result.frame() if outcome.result is not None else outcome
