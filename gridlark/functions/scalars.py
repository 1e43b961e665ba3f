"""The scalar functions and CAST as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridlark.errors import SqlSemanticError
from gridlark.functions import values as v
from gridlark.functions.values import BOOL, DATE, DATETIME, INT, NULL, REAL, TEXT, Value


def call(name: str, args: list[Value]) -> Value:
    return _FUNCTIONS[name](*args)


def _coalesce(*args: Value) -> Value:
    kind = v.common_kind([a.kind for a in args])
    return Value(F.coalesce(*[v.to_kind(a, kind).col for a in args]), kind, any(a.dynamic for a in args))


def _nullif(a: Value, b: Value) -> Value:
    same = a.kind == b.kind or {a.kind, b.kind} <= set(v.NUMERIC)
    return Value(F.nullif(a.col, b.col), a.kind, a.dynamic) if same and a.kind != NULL else a


def _on_text(make):
    return lambda a, *rest: Value(make(v.text(a), *rest), TEXT) if a.kind != NULL else Value(F.lit(None).cast("string"), TEXT)


def _length(a: Value) -> Value:
    return Value(F.length(v.text(a)).cast("bigint"), INT)


def _integer(a: Value, what: str) -> Column:
    return F.floor(v.number(a, what)).cast("int") if a.kind != INT else a.col.cast("int")


def _substr(a: Value, start: Value, length: Value | None = None) -> Value:
    """One-based; 0 is the start, negative counts from the end, a length below one gives ''."""
    at = _integer(start, "SUBSTR")
    n = F.lit(2**31 - 1) if length is None else F.greatest(_integer(length, "SUBSTR"), F.lit(0))
    null = F.lit(False) if length is None else length.col.isNull()
    return Value(F.when(~null, F.substring(v.text(a).cast("string"), at, n)), TEXT)


def _abs(a: Value) -> Value:
    return Value(F.abs(a.col), INT) if a.kind == INT else Value(F.abs(v.number(a, "ABS")), REAL)


def _round(a: Value, digits: Value | None = None) -> Value:
    if digits is None:
        return a if a.kind == INT else Value(F.bround(v.number(a, "ROUND"), 0).cast("bigint"), INT)
    if not digits.constant or digits.kind != INT:
        raise SqlSemanticError("ROUND takes a literal number of digits")
    return Value(F.bround(v.number(a, "ROUND"), digits.literal), REAL)


def _replace(a: Value, old: Value, new: Value) -> Value:
    source = v.text(a).cast("string")
    done = F.replace(source, v.text(old).cast("string"), F.coalesce(v.text(new).cast("string"), F.lit("")))
    return Value(F.when(old.col.isNull(), source).otherwise(done), TEXT)


def _concat(*args: Value) -> Value:
    return Value(F.concat_ws("", *[v.text(a).cast("string") for a in args]), TEXT)


def _day_part(name: str, part):
    def make(a: Value) -> Value:
        if a.kind in v.TEMPORAL:
            return Value(part(a.col).cast("bigint"), INT)
        if a.kind == NULL:
            return Value(F.lit(None).cast("bigint"), INT)
        if a.kind != TEXT:
            raise SqlSemanticError(f"{name} needs dates, not {a.kind} values")
        time = v.iso_or_null(a.col)
        return Value(F.when(a.col.isNull() | time.isNotNull(), part(time)).otherwise(v.refused(f"{name} needs ISO dates", "int")).cast("bigint"), INT)

    return make


_FUNCTIONS = {
    "COALESCE": _coalesce,
    "NULLIF": _nullif,
    "UPPER": _on_text(F.upper),
    "LOWER": _on_text(F.lower),
    "TRIM": _on_text(lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")),
    "LENGTH": _length,
    "SUBSTR": _substr,
    "SUBSTRING": _substr,
    "ABS": _abs,
    "ROUND": _round,
    "REPLACE": _replace,
    "CONCAT": _concat,
    "YEAR": _day_part("YEAR", F.year),
    "MONTH": _day_part("MONTH", F.month),
    "DAY": _day_part("DAY", F.dayofmonth),
}


def _checked(source: Column, result: Column, why: str, kind: str) -> Column:
    return F.when(source.isNull() | result.isNotNull(), result).otherwise(v.refused(why, kind))


def cast(a: Value, target: str) -> Value:
    """target: INTEGER, REAL, TEXT, DATE, DATETIME or BOOLEAN."""
    kind = v.DECLARED[target]
    spark = v.SPARK_TYPE[kind]
    if a.kind == NULL:
        return Value(F.lit(None).cast(spark), kind)
    if a.kind == kind:
        return Value(a.col, kind)
    why = f"Cannot cast to {target}"
    if kind in v.NUMERIC:
        if a.kind not in (*v.NUMERIC, TEXT):
            raise SqlSemanticError(f"{why}: {a.kind} values")
        n = v.number(a, f"CAST AS {target}")
        return Value(n if kind == REAL else F.when(n.isNotNull(), F.when(n < 0, F.ceil(n)).otherwise(F.floor(n))).cast("bigint"), kind)
    if kind == TEXT:
        return Value(v.text(a) if a.kind != DATETIME else F.regexp_replace(F.date_format(a.col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", ""), TEXT)
    if kind in (DATE, DATETIME):
        if a.kind in v.TEMPORAL:
            return Value(a.col.cast(spark), kind)
        if a.kind != TEXT:
            raise SqlSemanticError(f"{why}: {a.kind} values")
        return Value(_checked(a.col, v.iso_or_null(a.col), why, "timestamp_ntz").cast(spark), kind)
    if a.kind == TEXT:
        low = F.lower(F.trim(a.col))
        truth = F.when(low.isin("1", "true", "yes"), F.lit(True)).when(low.isin("0", "false", "no"), F.lit(False))
    elif a.kind in v.NUMERIC:
        truth = F.when(a.col == 1, F.lit(True)).when(a.col == 0, F.lit(False))
    else:
        raise SqlSemanticError(f"{why}: {a.kind} values")
    return Value(_checked(a.col, truth, why, "boolean"), BOOL)


def sanitized(col: Column) -> Column:
    """Text that a spreadsheet would take for a formula, with a quote before it."""
    return F.when(F.substring(col, 1, 1).isin("=", "+", "-", "@", "\t", "\r"), F.concat(F.lit("'"), col)).otherwise(col)


def like_pattern(pattern: str, escape: str | None) -> str:
    """A pattern of the dialect as a regular expression: . doesn't cross line feeds, $ may stand before the last."""
    out, literal = [], False
    for c in pattern:
        if literal or c not in "%_" and c != escape:
            out.append(c if c.isalnum() or c in " \n" or ord(c) > 127 else "\\" + c)
            literal = False
        elif c == escape:
            literal = True
        else:
            out.append(".*" if c == "%" else ".")
    if literal:
        raise SqlSemanticError("LIKE pattern ends with its escape character")
    return f"(?d)^{''.join(out)}$"




def like_expression(pattern: Column, escape: str | None) -> Column:
    """The same for a pattern that is known when the query runs."""
    start = F.struct(F.lit("").alias("out"), F.lit(False).alias("literal"))

    def step(seen: Column, c: Column) -> Column:
        wild = c.isin("%", "_") & ~seen["literal"]
        escapes = (c == F.lit(escape)) & ~seen["literal"] if escape is not None else F.lit(False)
        quoted = F.when(c.rlike(r"[0-9A-Za-z \n]|[^\x00-\x7f]"), c).otherwise(F.concat(F.lit("\\"), c))
        added = F.when(escapes, F.lit("")).when(wild, F.when(c == "%", F.lit(".*")).otherwise(F.lit("."))).otherwise(quoted)
        return F.struct(F.concat(seen["out"], added).alias("out"), escapes.alias("literal"))

    def end(seen: Column) -> Column:
        whole = F.concat(F.lit("(?d)^"), seen["out"], F.lit("$"))
        return F.when(seen["literal"], v.refused("LIKE pattern ends with its escape character", "string")).otherwise(whole)

    return F.when(pattern.isNotNull(), F.aggregate(F.filter(F.split(pattern, ""), lambda c: c != ""), start, step, end))
