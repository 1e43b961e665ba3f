"""Expressions and conditions of the tree as columns."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlark.errors import NotSupportedError, SqlSemanticError
from gridlark.functions import scalars
from gridlark.functions import values as v
from gridlark.functions.values import Value
from gridlark.plans.scope import Scope, fresh
from gridlark.sql import ast as a
from gridlark.sql.printer import text as printed


class Binder:
    """Builds columns in a scope. params: the statement's parameters; query: compiles a subquery in a scope around it.

    known: values for whole expressions by their text, as groups and aggregates are after grouping.
    text_names: bare names that name no column stand for themselves, as on the value side of comparisons.
    """

    def __init__(self, scope: Scope, params: tuple, query: Callable, known: dict[str, Value] | None = None, order: Column | None = None):
        self.scope, self.params, self.query, self.known, self.order = scope, params, query, known or {}, order
        #: Columns that the rows need before others can be made, step by step.
        self.steps: list[dict[str, Column]] = []

    def prepared(self, df: DataFrame) -> DataFrame:
        for step in self.steps:
            df = df.withColumns(step)
        return df

    # values

    def value(self, node, text_names: bool = False) -> Value:
        if self.known and (held := self.known.get(printed(node))) is not None:
            return held
        match node:
            case a.Literal(x):
                return v.constant(x)
            case a.Param(place):
                return v.constant(self.params[place])
            case a.Name(name, source, quoted):
                found = self.scope.find(node)
                if found is None and text_names and source is None and not quoted:
                    return v.constant(name)
                return found if found is not None else self.scope.need(node)
            case a.Negate(operand):
                return Value(-v.number(self.value(operand), "Unary minus"), v.REAL)
            case a.Binary("||", left, right):
                return Value(F.concat(*[v.text(self.value(x)).cast("string") for x in (left, right)]), v.TEXT)
            case a.Binary(op, left, right):
                l, r = (v.number(self.value(x), "Arithmetic") for x in (left, right))
                return Value({"+": l + r, "-": l - r, "*": l * r}[op] if op != "/" else l / r, v.REAL)
            case a.Call(name, args):
                return scalars.call(name, [self.value(x) for x in args])
            case a.Cast(operand, target):
                return scalars.cast(self.value(operand), {"INT": "INTEGER", "FLOAT": "REAL", "NUMERIC": "REAL"}.get(target, target))
            case a.Case():
                return self.case(node)
            case a.Windowed():
                return self.windowed(node)
            case a.Scalar(query):
                frame, kind, dynamic = self.query(query, self.scope, "scalar")
                return Value(frame.scalar(), kind, dynamic)
            case a.Aggregate():
                raise SqlSemanticError(f"Aggregate {printed(node)} is not allowed here")
        if isinstance(node, a.CONDITIONS):
            return Value(self.condition(node), v.BOOL)
        raise NotSupportedError(f"Unsupported expression: {node!r}")

    def case(self, node: a.Case) -> Value:
        results = [self.value(r) for _, r in node.branches]
        default = self.value(node.default) if node.default is not None else v.constant(None)
        kind = v.common_kind([x.kind for x in (*results, default)])
        tests = [
            self.condition(c) if node.operand is None else v.compare("=", self.value(node.operand), self.value(c)) for c, _ in node.branches
        ]
        out = F
        for test, result in zip(tests, results, strict=True):
            out = out.when(test, v.to_kind(result, kind).col)
        return Value(out.otherwise(v.to_kind(default, kind).col), kind, any(x.dynamic for x in (*results, default)))

    # windows

    def windowed(self, node: a.Windowed) -> Value:
        spec = Window.partitionBy(*[v.sort_key(self.value(p)) for p in node.partition])
        order = [v.ordered(self.value(o.expr), o.descending) for o in node.order]
        if node.func in ("RANK", "DENSE_RANK") and not order:
            return Value(F.lit(1).cast("bigint"), v.INT)
        if node.func in ("ROW_NUMBER", "RANK", "DENSE_RANK"):
            if node.func == "ROW_NUMBER":  # ties and unordered rows in input order, where there is one
                order = order + ([self.order] if self.order is not None else []) or [F.monotonically_increasing_id()]
            make = {"ROW_NUMBER": F.row_number, "RANK": F.rank, "DENSE_RANK": F.dense_rank}[node.func]
            return Value(make().over(spec.orderBy(*order)).cast("bigint"), v.INT)
        if order:
            tie = [self.order] if self.order is not None else []
            spec = spec.orderBy(*order, *tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if node.distinct and node.func == "COUNT":
            return self.distinct_over(node, order)
        return self.aggregated(node, lambda col: col.over(spec))

    def distinct_over(self, node: a.Windowed, order: list[Column]) -> Value:
        """COUNT(DISTINCT) over a window: the sum of a flag that is set where a value comes first in its partition."""
        keys = [v.sort_key(self.value(p)) for p in node.partition]
        arg = self.value(node.arg).col
        if node.filter is not None:
            arg = F.when(self.condition(node.filter), arg)
        value, place, first = fresh(), fresh(), fresh()
        # one order for both windows, also among ties
        self.steps.append({value: arg, place: self.order if self.order is not None else F.monotonically_increasing_id()})
        own = Window.partitionBy(*keys, F.col(value)).orderBy(*order, place)
        self.steps.append({first: F.when(F.col(value).isNotNull() & (F.row_number().over(own) == 1), 1)})
        spec = Window.partitionBy(*keys)
        if order:
            spec = spec.orderBy(*order, place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return Value(F.coalesce(F.sum(first).over(spec), F.lit(0)).cast("bigint"), v.INT)

    def aggregated(self, node: a.Aggregate | a.Windowed, finish=lambda col: col) -> Value:
        """An aggregate of this scope; finish puts it over a window."""
        where = self.condition(node.filter) if node.filter is not None else None
        kept = (lambda col: col) if where is None else (lambda col: F.when(where, col))
        if node.arg is None:
            return Value(finish(F.count(kept(F.lit(1)))).cast("bigint"), v.INT)
        arg = self.value(node.arg)
        if node.func == "COUNT":
            if not node.distinct:
                return Value(finish(F.count(kept(arg.col))).cast("bigint"), v.INT)
            return Value(F.count_distinct(kept(arg.col)).cast("bigint"), v.INT)
        if node.func in ("SUM", "AVG"):
            return Value(finish((F.sum if node.func == "SUM" else F.avg)(kept(v.number_or_null(arg)))), v.REAL)
        if not arg.dynamic:
            return Value(finish((F.min if node.func == "MIN" else F.max)(kept(arg.col))), arg.kind)
        pick = F.min_by if node.func == "MIN" else F.max_by
        return Value(finish(pick(kept(arg.col), kept(v.sort_key(arg)))), arg.kind, True)

    # conditions

    def condition(self, node) -> Column:
        match node:
            case a.Logic(op, left, right):
                l, r = self.condition(left), self.condition(right)
                return l & r if op == "AND" else l | r
            case a.Not(a.InQuery() as inner):
                return self.membership(a.InQuery(inner.operand, inner.query, not inner.negated))
            case a.Not(operand):
                return ~self.condition(operand)
            case a.Compare(op, left, right):
                return v.compare(op, self.value(left), self.value(right, text_names=True))
            case a.IsNull(operand, negated):
                col = self.value(operand).col
                return col.isNotNull() if negated else col.isNull()
            case a.InList():
                return self.listed(node)
            case a.InQuery():
                return self.membership(node)
            case a.Between(operand, low, high, negated):
                x, lo, hi = self.value(operand), self.value(low, text_names=True), self.value(high, text_names=True)
                inside = v.compare(">=", x, lo) & v.compare("<=", x, hi)
                if not negated:
                    return inside
                # unknown where a bound is null, even if the other decides
                whole = lo.col.isNotNull() & hi.col.isNotNull()
                return ~inside if lo.constant and hi.constant and v.NULL not in (lo.kind, hi.kind) else F.when(whole, ~inside)
            case a.Like():
                return self.like(node)
            case a.Exists(query):
                return self.query(query, self.scope, "exists")[0].exists()
        raise SqlSemanticError(f"Not a condition: {printed(node)}")

    def listed(self, node: a.InList) -> Column:
        x = self.value(node.operand)
        items = [self.value(i) for i in node.items]
        null = any(i.kind == v.NULL for i in items)
        real = [i for i in items if i.kind != v.NULL]
        if x.kind == v.NULL:
            return F.lit(None).cast("boolean")
        same = [i for i in real if i.kind == x.kind and not x.dynamic]
        tests = [v.compare("=", x, i) for i in real if i not in same]
        if same:
            tests.insert(0, x.col.isin([i.literal for i in same]) if x.kind in (v.INT, v.REAL, v.TEXT) else reduce(Column.__or__, [v.compare("=", x, i) for i in same]))
        if null:
            tests.append(F.lit(None).cast("boolean"))
        found = reduce(Column.__or__, tests)
        return ~found if node.negated else found

    def membership(self, node: a.InQuery) -> Column:
        x = self.value(node.operand)
        frame, kind, dynamic = self.query(node.query, self.scope, "in")
        inner = Value(F.col(f"`{frame.columns[0]}`"), kind, dynamic)
        keys = v.equal_keys(x, inner)
        if keys is None:  # null is in nothing, and nothing is surely not in a list with it
            return F.lit(None).cast("boolean") if x.kind == v.NULL else x.col.isin(frame)
        if kind == v.TEXT and x.kind != v.TEXT:  # what can't be read as x's kind equals nothing, but is no null
            frame = frame.filter(inner.col.isNull() | keys[1].isNotNull())
        if not node.negated:
            return keys[0].isin(frame.select(keys[1].alias("k")))
        # NOT IN as it is written would send the subquery everywhere, whatever its size; what nulls and an empty list
        # mean is asked apart, and the rest is a join on equal keys
        name = f"k{fresh()}"
        listed = frame.select(keys[1].alias(name))
        facts = listed.select(F.struct((F.count(F.lit(1)) == 0).alias("none"), (F.count(name) < F.count(F.lit(1))).alias("null")).alias("facts")).scalar()
        match = listed.filter(F.col(name) == keys[0].outer()).exists()
        unknown = keys[0].isNull() | facts["null"]
        return facts["none"] | (~match & F.when(unknown, F.lit(None)).otherwise(F.lit(True)))

    def like(self, node: a.Like) -> Column:
        x, pattern = self.value(node.operand), self.value(node.pattern, text_names=True)
        if pattern.kind == v.NULL or x.kind == v.NULL:
            return F.lit(None).cast("boolean")
        if pattern.kind != v.TEXT:
            raise SqlSemanticError("LIKE takes a text pattern")
        escape = self.value(node.escape).literal if node.escape is not None else None
        if escape is not None and (not isinstance(escape, str) or len(escape) != 1):
            raise SqlSemanticError("ESCAPE takes one character")
        if not pattern.constant:
            folded = (lambda c: F.lower(F.concat(F.upper(c), F.lit("")))) if node.folded else lambda c: c
            found = F.rlike(folded(v.text(x)), scalars.like_expression(folded(pattern.col), escape.casefold() if escape and node.folded else escape))
            return ~found if node.negated else found
        column, shown = v.text(x), pattern.literal
        if node.folded:
            # folds as ß to ss do; bare lower(upper(x)) would be simplified to lower(x)
            column, shown = F.lower(F.concat(F.upper(column), F.lit(""))), shown.casefold()
            escape = escape.casefold() if escape else None
        head = shown[:-1]
        if shown.endswith("%") and escape is None and head and not any(c in head for c in "%_\\") and not x.dynamic and not node.folded and x.kind == v.TEXT:
            # a plain prefix reaches the scan; the rest may not have a line feed, unless it is the last
            found = column.startswith(head) & column.rlike(scalars.like_pattern(shown, None))
        else:
            found = column.rlike(scalars.like_pattern(shown, escape))
        return ~found if node.negated else found
