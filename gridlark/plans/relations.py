"""Queries as DataFrames: FROM and joins, filters, groups, windows, projection, DISTINCT, order, limits, set operations."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlark.errors import SqlSemanticError
from gridlark.functions import values as v
from gridlark.functions.values import Value
from gridlark.plans.expressions import Binder
from gridlark.plans.scope import Field, Relation, Resolver, Scope, fresh, scanned
from gridlark.sql import ast as a
from gridlark.sql.printer import label
from gridlark.sql.printer import text as printed


@dataclass
class Result:
    """Rows under fresh names, and what the names stand for outside: labels, which may repeat, and kinds."""

    df: DataFrame
    names: list[str]
    labels: list[str]
    values: list[Value]

    def frame(self) -> DataFrame:
        """The rows under their labels."""
        return self.df.select(*[F.col(f"`{n}`").alias(l) for n, l in zip(self.names, self.labels, strict=True)])

    def relation(self) -> Relation:
        dynamic = frozenset(l for l, x in zip(self.labels, self.values, strict=True) if x.dynamic)
        return Relation(self.frame(), tuple(self.labels), dynamic)


class Compiler:
    def __init__(self, resolve: Resolver, params: tuple = ()):
        self.resolve, self.params = resolve, params

    def compile(self, node) -> Result:
        match node:
            case a.With(tables, query):
                known: dict[str, Relation] = {}
                outside = self.resolve

                def resolve(name: str) -> Relation:
                    return known.get(name.casefold()) or outside(name)

                inner = Compiler(resolve, self.params)
                for name, body in tables:
                    result = inner.compile(body)
                    if len({l.casefold() for l in result.labels}) < len(result.labels):
                        raise SqlSemanticError(f"CTE {name} has duplicate column names")
                    known[name.casefold()] = result.relation()
                return inner.compile(query)
            case a.Compound():
                return self.compound(node)
        return self.select(node)

    # subqueries

    def _nested(self, node, around: Scope, use: str):
        """(rows, kind, dynamic) of a subquery. The rows carry outer references, if any."""
        if use == "exists":
            return self.select(node, around, exists=True).df, None, False
        result = self.select(node, around)
        one = result.values[0]
        return result.df.select(F.col(f"`{result.names[0]}`").alias(f"s{fresh()}")), one.kind, one.dynamic

    def _binder(self, scope: Scope, known=None, order: Column | None = None) -> Binder:
        return Binder(scope, self.params, self._nested, known, order)

    # FROM

    def _joined(self, node: a.Select, around: Scope | None) -> tuple[DataFrame, Scope, Column | None]:
        df, fields, order = scanned(self.resolve(node.source.table), node.source.ref)
        scope = Scope(fields, around)
        refs, tables = {node.source.ref.casefold()}, {node.source.table.casefold()}
        for join in node.joins:
            ref, table = join.source.ref.casefold(), join.source.table.casefold()
            # a name may stand for one source only, be it as alias or as table
            if ref in refs or table in refs or join.source.alias is not None and ref in tables:
                raise SqlSemanticError(f"Ambiguous table reference: {join.source.ref}; use distinct aliases")
            refs.add(ref)
            tables.add(table)
            right, more, _ = scanned(self.resolve(join.source.table), join.source.ref)
            both = Scope(scope.fields + more, around)
            if join.kind == "cross":
                df = df.crossJoin(right)
            else:
                df = df.join(right, self._on(join, both, join.source.ref), join.kind)
            scope, order = both, None
        return df, scope, F.col(f"`{order}`") if order is not None else None

    def _on(self, join: a.Join, scope: Scope, new: str) -> Column:
        def build(node) -> Column:
            match node:
                case a.Logic(op, left, right):
                    l, r = build(left), build(right)
                    return l & r if op == "AND" else l | r
                case a.Not(operand):
                    return ~build(operand)
                case a.Compare(op, a.Name(_, ls) as left, a.Name(_, rs) as right):
                    if ls is None or rs is None:
                        raise SqlSemanticError("Columns in ON must be qualified")
                    if (ls.casefold() == new.casefold()) == (rs.casefold() == new.casefold()):
                        raise SqlSemanticError(f"Each comparison in ON must be between {new} and an earlier source")
                    l, r = scope.need(left), scope.need(right)
                    if op == "=" and (keys := v.equal_keys(l, r)) is not None:
                        return keys[0] == keys[1]
                    return v.compare(op, l, r)
            raise SqlSemanticError("ON takes comparisons of columns only")

        return build(join.on)

    # SELECT

    def select(self, node: a.Select, around: Scope | None = None, exists: bool = False) -> Result:
        df, scope, order = self._joined(node, around)
        if node.joins:
            self._qualified(node)
        bind = self._binder(scope, order=order)
        if node.where is not None:
            df = df.filter(bind.condition(node.where))
        if exists and not node.group and not self._aggregates(node):
            return Result(df, [], [], [])
        items = node.items or tuple(a.Item(a.Name(f.name, f.source, True), f"{f.source}.{f.name}" if node.joins else f.name) for f in scope.fields)
        if node.group or self._aggregates(node):
            if not node.items:
                raise SqlSemanticError("SELECT * can't be grouped")
            df, bind = self._grouped(node, df, scope, bind)
            order = None
        elif node.having is not None:
            raise SqlSemanticError("HAVING requires GROUP BY")
        labels = [i.alias or label(i.expr) for i in items]
        values = [bind.value(i.expr) for i in items]
        names = [fresh() for _ in items]
        bare = {printed(i.expr): x for i, x in zip(items, values, strict=True)}
        aliases = {i.alias.casefold(): x for i, x in zip(items, values, strict=True) if i.alias}
        shown = [x.col.alias(n) for x, n in zip(values, names, strict=True)]
        held = [Value(F.col(f"`{n}`"), x.kind, x.dynamic) for n, x in zip(names, values, strict=True)]
        if node.distinct:
            self._distinct_order(node, items, labels)
            df = bind.prepared(df).select(*shown).dropDuplicates()
            by_label = {l.casefold(): x for l, x in zip(labels, held, strict=True)}
            by_text = {printed(i.expr): x for i, x in zip(items, held, strict=True)}
            keys = [v.ordered(by_label.get(printed(o.expr).casefold()) or by_text[printed(o.expr)], o.descending) for o in node.order]
            df = self._cut(df.orderBy(*keys) if keys else df, node)
            return Result(df, names, labels, held)
        keys = []
        for o in node.order:
            if isinstance(o.expr, a.Literal):
                continue  # a constant, not a place
            if any(isinstance(n, a.Windowed) for n in a.walk(o.expr)) and printed(o.expr) not in bare:
                raise SqlSemanticError("Window functions in ORDER BY must be selected under an alias")
            alias = aliases.get(o.expr.name.casefold()) if isinstance(o.expr, a.Name) and o.expr.source is None else None
            keys.append((alias or bare.get(printed(o.expr)) or bind.value(o.expr), o.descending))
        tie = [order] if order is not None else []
        df = bind.prepared(df)
        if not keys and not tie:
            return Result(self._cut(df.select(*shown), node), names, labels, held)
        # keys become columns before the sort, so that neither windows nor subqueries stand in it
        sort_names = [fresh() for _ in keys]
        tie_name = fresh()
        extra = [v.sort_key(x).alias(n) for (x, _), n in zip(keys, sort_names, strict=True)] + [t.alias(tie_name) for t in tie]
        wide = df.select(*shown, *extra)
        sorts = [F.col(n).desc_nulls_first() if down else F.col(n).asc_nulls_last() for (_, down), n in zip(keys, sort_names, strict=True)]
        if keys or node.limit is not None or node.offset is not None or around is None:
            wide = wide.orderBy(*sorts, *([F.col(tie_name)] if tie else []))
        return Result(self._cut(wide, node).select(*names), names, labels, held)

    def _cut(self, df: DataFrame, node) -> DataFrame:
        limit, offset = (self._count(x, what) for x, what in ((node.limit, "LIMIT"), (node.offset, "OFFSET")))
        if offset:
            df = df.offset(offset)
        return df if limit is None else df.limit(limit)

    def _count(self, node, what: str) -> int | None:
        if node is None:
            return None
        value = self.params[node.place] if isinstance(node, a.Param) else node.value
        if isinstance(value, bool) or not isinstance(value, int) or value < 0:
            raise SqlSemanticError(f"{what} must be a non-negative integer")
        return value

    @staticmethod
    def _qualified(node: a.Select) -> None:
        """In joins every column of the select list, of groups, filters and aggregates names its source; aliases may stand
        in ORDER BY."""
        aliases = {i.alias.casefold() for i in node.items if i.alias}
        parts = [*(i.expr for i in node.items), *node.group, *filter(None, (node.where, node.having))]
        for part in parts:
            for n in a.walk(part):
                if isinstance(n, a.Compare) and isinstance(n.right, a.Name) and n.right.source is None:
                    raise SqlSemanticError(f"Column {n.right.name} must be qualified in a JOIN query")
                if isinstance(n, a.Name) and n.source is None:
                    raise SqlSemanticError(f"Column {n.name} must be qualified in a JOIN query")
        for o in node.order:
            for n in a.walk(o.expr):
                if isinstance(n, a.Name) and n.source is None and not (n is o.expr and n.name.casefold() in aliases):
                    raise SqlSemanticError(f"Column {n.name} must be qualified in a JOIN query")

    @staticmethod
    def _distinct_order(node: a.Select, items, labels: list[str]) -> None:
        known = {l.casefold() for l in labels} | {printed(i.expr).casefold() for i in items}
        for o in node.order:
            if printed(o.expr).casefold() not in known:
                raise SqlSemanticError("ORDER BY columns must appear in the select list of SELECT DISTINCT")

    # groups

    @staticmethod
    def _aggregates(node: a.Select) -> dict[str, a.Aggregate]:
        parts = [*(i.expr for i in node.items), *([node.having] if node.having is not None else []), *(o.expr for o in node.order)]
        return {printed(n): n for part in parts for n in a.walk(part) if isinstance(n, a.Aggregate)}

    def _grouped(self, node: a.Select, df: DataFrame, scope: Scope, bind: Binder) -> tuple[DataFrame, Binder]:
        groups = {printed(g): bind.value(g) for g in node.group}
        aggregates = {t: bind.aggregated(x) for t, x in self._aggregates(node).items()}
        folded = {t.casefold() for t in groups}
        for item in node.items:
            if any(isinstance(n, a.Windowed) for n in a.walk(item.expr)):
                raise SqlSemanticError("Window functions can't be combined with GROUP BY")
            if not isinstance(item.expr, a.Aggregate) and printed(item.expr).casefold() not in folded:
                raise SqlSemanticError(f"Column {printed(item.expr)} must appear in GROUP BY or be used in an aggregate")
        if node.having is not None:
            self._grouped_only(node.having, folded)
        aliases = {i.alias.casefold() for i in node.items if i.alias}
        for o in node.order:
            if not (isinstance(o.expr, a.Name) and o.expr.name.casefold() in aliases or isinstance(o.expr, a.Literal)):
                self._grouped_only(o.expr, folded)
        names = {t: fresh() for t in (*groups, *aggregates)}
        keys = [x.col.alias(names[t]) for t, x in groups.items()]
        # one column at least, so that a group without aggregates is still a group
        sums = [x.col.alias(names[t]) for t, x in aggregates.items()]
        if groups:
            df = df.groupBy(*keys).agg(*sums) if sums else df.select(*keys).dropDuplicates()
        else:
            df = df.select(*sums)  # agg() would ask for outer references before there is an outer query
        known = {t: Value(F.col(f"`{names[t]}`"), x.kind, x.dynamic) for t, x in (groups | aggregates).items()}
        known |= {printed(i.expr): known[t] for i in node.items for t in known if t.casefold() == printed(i.expr).casefold()}
        after = self._binder(_Known(known, scope), known)
        if node.having is not None:
            df = df.filter(after.condition(node.having))
        return df, after

    def _grouped_only(self, node, groups: set[str]) -> None:
        if isinstance(node, a.Aggregate) or printed(node).casefold() in groups:
            return
        if isinstance(node, a.Name):
            raise SqlSemanticError(f"Column {printed(node)} must appear in GROUP BY or be used in an aggregate")
        for child in a.children(node):
            self._grouped_only(child, groups)

    # set operations

    def compound(self, node: a.Compound) -> Result:
        results = [self.compile(b) for b in node.branches]
        width = len(results[0].names)
        if any(len(r.names) != width for r in results):
            raise SqlSemanticError("Set operation branches must have the same number of columns")
        kinds = [v.common_kind([r.values[i].kind for r in results]) for i in range(width)]
        names = [fresh() for _ in range(width)]
        dynamic = [any(r.values[i].dynamic for r in results) for i in range(width)]

        def aligned(r: Result) -> DataFrame:
            return r.df.select(*[v.to_kind(x, k).col.alias(n) for x, k, n in zip(r.values, kinds, names, strict=True)])

        combine = {
            "UNION": lambda l, r: l.union(r).distinct(),
            "UNION ALL": lambda l, r: l.union(r),
            "INTERSECT": lambda l, r: l.intersect(r),
            "EXCEPT": lambda l, r: l.subtract(r),
        }
        ops = iter(node.ops)
        df = reduce(lambda l, r: combine[next(ops)](l, r), map(aligned, results))
        held = [Value(F.col(f"`{n}`"), k, d) for n, k, d in zip(names, kinds, dynamic, strict=True)]
        labels = results[0].labels
        keys = []
        for o in node.order:
            if isinstance(o.expr, a.Literal):
                continue
            wanted = printed(o.expr)
            hits = [x for l, x in zip(labels, held, strict=True) if l == wanted or l.endswith(f".{wanted}")]
            if not isinstance(o.expr, a.Name) or not hits:
                raise SqlSemanticError(f"ORDER BY of a set operation takes output columns, not {wanted}")
            keys.append(v.ordered(hits[0], o.descending))
        return Result(self._cut(df.orderBy(*keys) if keys else df, node), names, list(labels), held)


class _Known(Scope):
    """After grouping, names are found only as groups are written."""

    def __init__(self, known: dict[str, Value], scope: Scope):
        super().__init__([Field("", f.name, f.value) for f in scope.fields], scope.outer)
        self.by_text = {t.casefold(): x for t, x in known.items()}

    def find(self, name: a.Name) -> Value | None:
        return self.by_text.get(printed(name).casefold())
