"""INSERT, UPSERT, UPDATE, DELETE: each makes a new version of a table.

A version is written as parquet to the checkpoint folder, so that reading a table again doesn't repeat its history, and
counts come from the files' footers.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlark.errors import SqlSemanticError
from gridlark.functions import values as v
from gridlark.functions.scalars import sanitized
from gridlark.functions.values import Value
from gridlark.plans.expressions import Binder
from gridlark.plans.relations import Compiler
from gridlark.plans.scope import ORDINAL, Field, Relation, Scope
from gridlark.sources import inference
from gridlark.sources.catalog import Catalog, cut, spark_type
from gridlark.sql import ast as a
from gridlark.sql.printer import text as printed


@dataclass
class Changed:
    rowcount: int
    lastrowid: int | None = None


class Changes:
    def __init__(self, catalog: Catalog, params: tuple = (), sanitize: bool = True):
        self.catalog, self.params, self.sanitize = catalog, params, sanitize
        self.compiler = Compiler(catalog.resolve, params)

    def run(self, node) -> Changed:
        match node:
            case a.Insert():
                return self.insert(node)
            case a.Update():
                return self.update(node)
        return self.delete(node)

    # shared

    def _scope(self, table: str, relation: Relation) -> Scope:
        kinds = {f.name: f.dataType for f in relation.df.schema.fields}
        return Scope([Field(table, c, v.of_column(c, kinds[c], c in relation.dynamic)) for c in relation.columns])

    def _binder(self, scope: Scope) -> Binder:
        return Binder(scope, self.params, self.compiler._nested)

    def _column(self, relation: Relation, name: str) -> str:
        for c in relation.columns:
            if c.casefold() == name.casefold():
                return c
        raise SqlSemanticError(f"Unknown column: {name}. Available: {', '.join(relation.columns)}")

    def _clean(self, value: Value) -> Value:
        if value.kind != v.TEXT or not self.sanitize:
            return value
        return replace(value, col=sanitized(value.col))

    @staticmethod
    def _kinds(relation: Relation) -> dict[str, str]:
        return {f.name: v.kind_of(f.dataType) for f in relation.df.schema.fields if f.name in relation.columns}

    @staticmethod
    def _empty_columns(relation: Relation) -> set[str]:
        """Columns of text that hold nothing yet: they take the type of what comes first."""
        loose = [c for c in relation.columns if c in relation.dynamic]
        if not loose:
            return set()
        counts = relation.df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(loose)]).first()
        return {c for i, c in enumerate(loose) if not counts[i]}

    def _widened(self, relation: Relation, incoming: dict[str, list[str]]) -> Relation:
        """With the types that columns need to hold values of these kinds too."""
        kinds, dynamic, casts = self._kinds(relation), set(relation.dynamic), {}
        free = self._empty_columns(relation)
        for c, more in incoming.items():
            kind = v.common_kind([*([] if c in free else [kinds[c]]), *more])
            kind = v.TEXT if kind == v.NULL else kind
            if kind == v.TEXT:
                dynamic.add(c)
            elif c in free:
                dynamic.discard(c)
            if kind != kinds[c]:
                old = Value(F.col(f"`{c}`"), kinds[c])
                casts[c] = F.lit(None).cast(v.SPARK_TYPE[kind]) if c in free else v.to_kind(old, kind).col
        return replace(relation, df=relation.df.withColumns(casts) if casts else relation.df, dynamic=frozenset(dynamic))

    def _store(self, table: str, relation: Relation, df: DataFrame) -> None:
        self.catalog.put(table, replace(relation, df=cut(df)))

    # INSERT

    def insert(self, node: a.Insert) -> Changed:
        table = self.catalog.need(node.table)
        old = self.catalog.resolve(table)
        columns = [self._column(old, c) for c in node.columns] if node.columns else list(old.columns)
        if len(set(columns)) < len(columns):
            raise SqlSemanticError("A column is named twice in INSERT")
        relation, rows = self._values(old, columns, node.rows) if node.rows is not None else self._selected(old, columns, node.query)
        before = old.df.count()
        if node.conflict is not None:
            done = self._upsert(table, relation, rows, node.conflict)
            after = self.catalog.resolve(table).df.count()
            return Changed(done, after + 1 if after > before else None)
        rows = cut(rows)
        n = rows.count()
        self._store(table, relation, self._appended(relation, rows))
        return Changed(n, before + n + 1 if n else None)

    def _values(self, relation: Relation, columns: list[str], rows: tuple) -> tuple[Relation, DataFrame]:
        """VALUES rows under the table's columns, with their place in ORDINAL."""
        cells = []
        for row in rows:
            if len(row) != len(columns):
                raise SqlSemanticError(f"INSERT has {len(row)} values for {len(columns)} columns")
            got = [self.params[x.place] if isinstance(x, a.Param) else x.value for x in row]
            cells.append([self._clean_cell(x) for x in got])
        kinds = {c: [v.constant(r[i]).kind for r in cells] for i, c in enumerate(columns)}
        wide = self._widened(relation, kinds)
        own = self._kinds(wide)
        schema = T.StructType([T.StructField(c, spark_type(own[c])) for c in relation.columns] + [T.StructField(ORDINAL, T.LongType())])
        place = {c: i for i, c in enumerate(columns)}
        made = [
            (*(inference.as_kind(r[place[c]], own[c]) if c in place else None for c in relation.columns), i) for i, r in enumerate(cells)
        ]
        return wide, self.catalog.spark.createDataFrame(made, schema)

    def _clean_cell(self, x: Any) -> Any:
        return "'" + x if self.sanitize and isinstance(x, str) and x[:1] in tuple("=+-@\t\r") and x else x

    def _selected(self, relation: Relation, columns: list[str], query) -> tuple[Relation, DataFrame]:
        result = self.compiler.compile(query)
        if len(result.names) != len(columns):
            raise SqlSemanticError(f"INSERT has {len(result.names)} columns for {len(columns)}")
        values = [self._clean(x) for x in result.values]
        wide = self._widened(relation, {c: [x.kind] for c, x in zip(columns, values, strict=True)})
        own = self._kinds(wide)
        by = dict(zip(columns, values, strict=True))
        made = [
            (v.to_kind(by[c], own[c]).col if c in by else F.lit(None)).cast(v.SPARK_TYPE[own[c]]).alias(c) for c in relation.columns
        ]
        return wide, result.df.select(*made, F.monotonically_increasing_id().alias(ORDINAL))

    @staticmethod
    def _appended(relation: Relation, rows: DataFrame) -> DataFrame:
        top = relation.df.agg(F.coalesce(F.max(f"`{relation.ordinal}`"), F.lit(-1))).first()[0] if relation.ordinal else None
        if top is None:
            return relation.df.unionByName(rows.drop(ORDINAL))
        return relation.df.unionByName(rows.withColumn(ORDINAL, F.col(ORDINAL) + F.lit(top + 1)).withColumnRenamed(ORDINAL, relation.ordinal))

    # UPSERT

    def _upsert(self, table: str, relation: Relation, rows: DataFrame, conflict: a.Conflict) -> int:
        """Rows in their order: one that finds its key, in the table or among those before it, updates the first that has
        it; one that doesn't is appended. A key with a null finds nothing."""
        keys = [self._column(relation, k) for k in conflict.keys]
        sets = None
        if conflict.sets is not None:
            sets = [(self._column(relation, c), e) for c, e in conflict.sets]
            relation = self._widened(relation, self._set_kinds(table, relation, sets))
            own = self._kinds(relation)
            rows = rows.select(*[F.col(f"`{c}`").cast(v.SPARK_TYPE[own[c]]).alias(c) for c in relation.columns], ORDINAL)
        rows = cut(rows)
        whole = F.lit(True)
        for k in keys:
            whole = whole & F.col(f"`{k}`").isNotNull()
        loose, keyed = rows.filter(~whole), rows.filter(whole)
        # ids are written out, for a second reading might number the rows in another way
        base = relation if relation.ordinal else replace(relation, df=cut(relation.df.withColumn(ORDINAL, F.monotonically_increasing_id())), ordinal=ORDINAL)
        first = (
            base.df.filter(whole)
            .withColumn("nth", F.row_number().over(Window.partitionBy(*[f"`{k}`" for k in keys]).orderBy(base.ordinal)))
            .filter("nth = 1")
            .select(F.struct(*[F.col(f"`{c}`") for c in relation.columns]).alias("had"), F.col(base.ordinal).alias("at"), *[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])
        )
        names = [f"k{i}" for i in range(len(keys))]
        row = F.struct(F.col(ORDINAL).alias("seq"), F.struct(*[F.col(f"`{c}`") for c in relation.columns]).alias("row"))
        # only what is set from the row's own columns has to see all rows of a key one after the other
        step_by_step = sets is not None and any(self._reads_own(relation, e) for _, e in sets)
        rows_of = F.array_sort(F.collect_list(row)) if step_by_step else F.array(F.min_by(row, ORDINAL), F.max_by(row, ORDINAL))
        batch = (
            keyed.groupBy(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)])
            .agg(rows_of.alias("rows"), F.count(F.lit(1)).alias("n"))
            .join(first, names, "left")
        )
        start = F.coalesce("had", F.element_at("rows", 1)["row"])
        if sets is None:
            final = start
        elif step_by_step:
            rest = F.when(F.col("had").isNotNull(), F.col("rows")).otherwise(F.slice("rows", F.lit(2), F.size("rows")))
            final = F.aggregate(rest, start, lambda acc, x: self._applied(table, relation, sets, acc, x["row"]))
        else:  # the last row decides
            last = self._applied(table, relation, sets, start, F.element_at("rows", 2)["row"])
            final = F.when(F.col("had").isNull() & (F.col("n") == 1), start).otherwise(last)
        merged = cut(batch.select("at", F.element_at("rows", 1)["seq"].alias("seq"), final.alias("new")))
        inserted = merged.filter("at IS NULL")
        fresh = inserted.select("new.*", F.col("seq").alias(ORDINAL)).unionByName(loose)
        if sets is None:
            kept, count = base.df, fresh.count()
        else:
            count = rows.count()
            changed = merged.filter("at IS NOT NULL")
            kept = base.df.join(changed.select(F.col("at").alias(base.ordinal)), base.ordinal, "left_anti").unionByName(
                changed.select("new.*", F.col("at").alias(base.ordinal))
            )
        done = self._appended(replace(base, df=kept), fresh)
        self._store(table, relation, done if relation.ordinal else done.drop(ORDINAL))
        return count

    def _reads_own(self, relation: Relation, expr) -> bool:
        own = {c.casefold() for c in relation.columns}
        return any(isinstance(n, a.Name) and n.name.casefold() in own and (n.source or "").casefold() != "excluded" for n in a.walk(expr))

    def _set_kinds(self, table: str, relation: Relation, sets) -> dict[str, list[str]]:
        own = self._scope(table, relation)
        both = Scope([*own.fields, *[replace(f, source="excluded") for f in own.fields]])
        return {c: [self._set_value(both, e).kind] for c, e in sets}

    def _set_value(self, scope: Scope, expr) -> Value:
        if isinstance(expr, a.Name) and expr.source is None and self._own(scope, expr) is None:
            return v.constant(expr.name)  # a name of nothing stands for itself
        return self._clean(_OwnFirst(scope, self).value(expr))

    @staticmethod
    def _own(scope: Scope, name: a.Name) -> Value | None:
        return next((f.value for f in scope.fields if f.source != "excluded" and f.name.casefold() == name.name.casefold()), None)

    def _applied(self, table: str, relation: Relation, sets, acc: Column, row: Column) -> Column:
        kinds = self._kinds(relation)
        value = lambda of, c: Value(of[c], kinds[c], c in relation.dynamic)
        scope = Scope([Field(table, c, value(acc, c)) for c in relation.columns] + [Field("excluded", c, value(row, c)) for c in relation.columns])
        new = {c: self._set_value(scope, e) for c, e in sets}
        return F.struct(*[(v.to_kind(new[c], kinds[c]).col.cast(v.SPARK_TYPE[kinds[c]]) if c in new else acc[c]).alias(c) for c in relation.columns])

    # UPDATE and DELETE

    def update(self, node: a.Update) -> Changed:
        table = self.catalog.need(node.table)
        old = self.catalog.resolve(table)
        sets = [(self._column(old, c), e) for c, e in node.sets]
        if len({c for c, _ in sets}) < len(sets):
            raise SqlSemanticError("A column is set twice in UPDATE")
        scope = self._scope(table, old)
        bind = self._binder(scope)
        new = {c: self._clean(bind.value(e, text_names=isinstance(e, a.Name))) for c, e in sets}
        hit = F.coalesce(bind.condition(node.where), F.lit(False)) if node.where is not None else F.lit(True)
        kinds = self._kinds(old)
        into = {c: v.common_kind([kinds[c], x.kind]) for c, x in new.items()}
        # the condition is decided once, before any column changes
        marked = old.df.withColumn("__hit", hit)
        made = {
            c: F.when(F.col("__hit"), v.to_kind(x, into[c]).col.cast(v.SPARK_TYPE[into[c]])).otherwise(v.to_kind(Value(F.col(f"`{c}`"), kinds[c]), into[c]).col)
            for c, x in new.items()
        }
        changed = cut(marked.withColumns(made))
        dynamic = old.dynamic | {c for c, k in into.items() if k == v.TEXT and kinds[c] != v.TEXT}
        self.catalog.put(table, replace(old, df=changed.drop("__hit"), dynamic=dynamic))
        return Changed(changed.filter("__hit").count())

    def delete(self, node: a.Delete) -> Changed:
        table = self.catalog.need(node.table)
        old = self.catalog.resolve(table)
        hit = F.lit(True)
        if node.where is not None:
            hit = F.coalesce(self._binder(self._scope(table, old)).condition(node.where), F.lit(False))
        kept = cut(old.df.withColumn("__hit", hit).filter("NOT __hit").drop("__hit"))
        gone = old.df.count() - kept.count()
        self.catalog.put(table, replace(old, df=kept))
        return Changed(gone)


class _OwnFirst(Binder):
    """Bare names are the table's, though excluded has them too."""

    def __init__(self, scope: Scope, changes: Changes):
        super().__init__(scope, changes.params, changes.compiler._nested)

    def value(self, node, text_names: bool = False) -> Value:
        if isinstance(node, a.Name) and node.source is None and not self.known:
            own = Changes._own(self.scope, node)
            if own is None:
                raise SqlSemanticError(f"Unknown column: {printed(node)}")
            return own
        return super().value(node, text_names)
