"""Kinds of values, and the coercions between them, decided from static types.

Comparison tries dates, then numbers, then text, as the operands' kinds allow. Literals are folded to the other side's
kind while the plan is built, so filters reach the scan and equal keys stay equal keys.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlark.errors import SqlSemanticError

INT, REAL, TEXT, BOOL, DATE, DATETIME, NULL, OTHER = "int", "real", "text", "bool", "date", "datetime", "null", "other"
NUMERIC, TEMPORAL = (INT, REAL), (DATE, DATETIME)
SPARK_TYPE = {INT: "bigint", REAL: "double", TEXT: "string", BOOL: "boolean", DATE: "date", DATETIME: "timestamp_ntz", NULL: "void"}
DECLARED = {"INTEGER": INT, "REAL": REAL, "TEXT": TEXT, "BOOLEAN": BOOL, "DATE": DATE, "DATETIME": DATETIME}

_NOTHING = object()


@dataclass(frozen=True, eq=False)
class Value:
    """A column with its kind. dynamic: text from a workbook cell that may stand for other kinds. literal: its constant."""

    col: Column
    kind: str
    dynamic: bool = False
    literal: Any = _NOTHING

    @property
    def constant(self) -> bool:
        return self.literal is not _NOTHING


def kind_of(data_type: T.DataType) -> str:
    match data_type:
        case T.ByteType() | T.ShortType() | T.IntegerType() | T.LongType():
            return INT
        case T.FloatType() | T.DoubleType() | T.DecimalType():
            return REAL
        case T.StringType() | T.CharType() | T.VarcharType():
            return TEXT
        case T.BooleanType():
            return BOOL
        case T.DateType():
            return DATE
        case T.TimestampType() | T.TimestampNTZType():
            return DATETIME
        case T.NullType():
            return NULL
    return OTHER


def of_column(name: str, data_type: T.DataType, dynamic: bool = False) -> Value:
    kind = kind_of(data_type)
    col = F.col(f"`{name}`")
    if isinstance(data_type, T.DecimalType | T.FloatType):
        col = col.cast("double")
    elif isinstance(data_type, T.TimestampType):
        col = col.cast("timestamp_ntz")
    return Value(col, kind, dynamic and kind == TEXT)


def constant(value: Any) -> Value:
    match value:
        case None:
            return Value(F.lit(None), NULL, literal=None)
        case bool():
            return Value(F.lit(value), BOOL, literal=value)
        case int():
            if not -(2**63) <= value < 2**63:
                return constant(float(value))
            return Value(F.lit(value).cast("bigint"), INT, literal=value)
        case float():
            return Value(F.lit(value), REAL, literal=value)
        case str():
            return Value(F.lit(value), TEXT, literal=value)
        case dt.datetime():
            return Value(F.lit(value.replace(tzinfo=None).isoformat(" ")).cast("timestamp_ntz"), DATETIME, literal=value.replace(tzinfo=None))
        case dt.date():
            return Value(F.lit(value), DATE, literal=value)
    raise SqlSemanticError(f"Unsupported parameter type: {type(value).__name__}")


# numbers

_NUMBER = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"


def parsed_number(text: str) -> float | None:
    return float(text) if re.match(_NUMBER, text) else None


def number_or_null(v: Value) -> Column:
    """As double, null where it is no number."""
    if v.kind in NUMERIC:
        return v.col.cast("double")
    if v.kind == TEXT:
        if v.constant:
            return F.lit(parsed_number(v.literal)).cast("double")
        return F.when(v.col.rlike(_NUMBER), F.trim(v.col).try_cast("double"))
    return F.lit(None).cast("double")


def number(v: Value, what: str) -> Column:
    """As double; an error, now or when run, if it isn't a number."""
    if v.kind == NULL:
        return F.lit(None).cast("double")
    if v.kind in NUMERIC:
        return v.col.cast("double")
    if v.kind == TEXT:
        if v.constant and parsed_number(v.literal) is None:
            raise SqlSemanticError(f"{what} needs numbers, not {v.literal!r}")
        found = number_or_null(v)
        return F.when(v.col.isNull() | found.isNotNull(), found).otherwise(refused(what + " needs numbers", "double"))
    raise SqlSemanticError(f"{what} needs numbers, not {v.kind} values")


def refused(why: str, kind: str) -> Column:
    return F.raise_error(F.lit(why)).cast(kind)


# dates

_ISO = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]+)?)?(?:Z|[+-][0-9]{2}:?[0-9]{2})?|Z)?\s*$"
_ZONE = r"(?:Z|(?<=:[0-9]{2}|\.[0-9]{1,9})[+-][0-9]{2}:?[0-9]{2})$"
#: Written with slashes, tried in this order.
_SLASHED = [f"{day}{time}" for day in ("y/M/d", "M/d/y", "d/M/y") for time in ("", " H:m:s", " H:m")]


def parsed_time(text: str) -> dt.datetime | None:
    text = text.strip()
    try:
        return dt.datetime.fromisoformat(text[:-1] if text.endswith("Z") else text).replace(tzinfo=None)
    except ValueError:
        pass
    for day in ("%Y/%m/%d", "%m/%d/%Y", "%d/%m/%Y"):
        for time in ("", " %H:%M:%S", " %H:%M"):
            try:
                return dt.datetime.strptime(text, day + time)
            except ValueError:
                pass
    return None


def iso_or_null(col: Column) -> Column:
    """ISO text as timestamp without zone, whatever zone it names; null if it isn't ISO text."""
    return F.when(col.rlike(_ISO), F.regexp_replace(F.trim(col), _ZONE, "").try_cast("timestamp_ntz"))


def time_or_null(v: Value) -> Column:
    if v.kind == DATETIME:
        return v.col
    if v.kind == DATE:
        return v.col.cast("timestamp_ntz")
    if v.kind == TEXT:
        if v.constant:
            return constant(parsed_time(v.literal)).col.cast("timestamp_ntz")
        trimmed = F.trim(v.col)
        slashed = [F.try_to_timestamp(trimmed, F.lit(f)).cast("timestamp_ntz") for f in _SLASHED]
        return F.coalesce(iso_or_null(v.col), F.when(F.instr(trimmed, "/") > 0, F.coalesce(*slashed)))
    return F.lit(None).cast("timestamp_ntz")


# text


def text(v: Value) -> Column:
    match v.kind:
        case "text":
            return v.col
        case "bool":
            return F.when(v.col, F.lit("True")).when(~v.col, F.lit("False"))
        case "datetime":
            return F.regexp_replace(F.date_format(v.col, "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.000000$", "")
    return v.col.cast("string")


# comparison


def _apply(op: str, left: Column, right: Column) -> Column:
    match op:
        case "=":
            return left == right
        case "!=":
            return left != right
        case "<":
            return left < right
        case "<=":
            return left <= right
        case ">":
            return left > right
    return left >= right


def compare(op: str, left: Value, right: Value) -> Column:
    """A boolean column, null where either side is."""
    kinds = {left.kind, right.kind}
    if NULL in kinds:
        return F.lit(None).cast("boolean")
    if OTHER in kinds:
        raise SqlSemanticError("Columns of nested types can't be compared")
    if kinds <= set(NUMERIC):
        if kinds == {INT}:
            return _apply(op, left.col, right.col)
        return _apply(op, left.col.cast("double"), right.col.cast("double"))
    if kinds == {BOOL} or kinds == {DATE}:
        return _apply(op, left.col, right.col)
    if kinds <= set(TEMPORAL):
        return _apply(op, left.col.cast("timestamp_ntz"), right.col.cast("timestamp_ntz"))
    if kinds == {TEXT}:
        return _texts(op, left, right) if left.dynamic or right.dynamic else _apply(op, left.col, right.col)
    if TEXT in kinds and kinds & set(TEMPORAL):
        return _mixed(op, left, right, time_or_null)
    if TEXT in kinds and kinds & set(NUMERIC):
        return _mixed(op, left, right, number_or_null)
    return _apply(op, text(left), text(right))


def _mixed(op: str, left: Value, right: Value, common) -> Column:
    """Text against a kind that it may stand for; text order where it doesn't."""
    side = left if left.kind == TEXT else right
    if side.constant:
        readable = (parsed_time if common is time_or_null else parsed_number)(side.literal) is not None
        if readable:
            l, r = (_native(x, common) for x in (left, right))
            return _apply(op, l, r)
        return _apply(op, text(left), text(right))
    parsed = _apply(op, common(left), common(right))
    if op == "=":
        return F.coalesce(parsed, F.when(left.col.isNotNull() & right.col.isNotNull(), F.lit(False)))
    return F.coalesce(parsed, _apply(op, text(left), text(right)))


def _native(v: Value, common) -> Column:
    """A folded literal beside a column that keeps its own type, so that the filter can be pushed down."""
    if v.kind == DATE or v.kind == INT:
        return v.col.cast("timestamp_ntz" if v.kind == DATE else "double")
    return common(v)


def _texts(op: str, left: Value, right: Value) -> Column:
    """Two texts of which one is a workbook's: as dates if both are, else as numbers if both are, else as text."""
    for v in (left, right):
        if v.constant and parsed_time(v.literal) is None and parsed_number(v.literal) is None:
            return _apply(op, left.col, right.col)
    times, numbers = _apply(op, time_or_null(left), time_or_null(right)), _apply(op, number_or_null(left), number_or_null(right))
    return F.coalesce(times, numbers, _apply(op, left.col, right.col))


def equal_keys(left: Value, right: Value) -> tuple[Column, Column] | None:
    """Columns of one type whose equality is compare("=") of the two, so that a join can hash them."""
    kinds = {left.kind, right.kind}
    if NULL in kinds or OTHER in kinds:
        return None
    if kinds <= set(NUMERIC):
        return (left.col, right.col) if kinds == {INT} else (left.col.cast("double"), right.col.cast("double"))
    if len(kinds) == 1 and not (left.dynamic or right.dynamic):
        return left.col, right.col
    if kinds <= set(TEMPORAL):
        return left.col.cast("timestamp_ntz"), right.col.cast("timestamp_ntz")
    if kinds <= {TEXT, *NUMERIC}:
        if kinds == {TEXT}:  # one form for equal dates, numbers and texts
            return tuple(F.coalesce(time_or_null(v).cast("string"), number_or_null(v).cast("string"), v.col) for v in (left, right))
        return number_or_null(left), number_or_null(right)
    if kinds <= {TEXT, *TEMPORAL}:
        return time_or_null(left), time_or_null(right)
    return text(left), text(right)


# order


def sort_key(v: Value) -> Column:
    """What a value is ordered by; nulls stay null."""
    if not v.dynamic or v.constant:
        return v.col
    n, t = number_or_null(v), time_or_null(v)
    rank = F.when(t.isNotNull(), 2).when(n.isNotNull(), 0).otherwise(3)
    return F.when(v.col.isNotNull(), F.struct(rank.alias("rank"), F.when(t.isNull(), n).alias("n"), t.alias("t"), v.col.alias("s")))


def ordered(v: Value, descending: bool) -> Column:
    return sort_key(v).desc_nulls_first() if descending else sort_key(v).asc_nulls_last()


# one type for several


def common_kind(kinds: list[str]) -> str:
    real = [k for k in kinds if k != NULL]
    if not real:
        return NULL
    if len(set(real)) == 1:
        return real[0]
    if set(real) <= set(NUMERIC):
        return REAL
    if set(real) <= set(TEMPORAL):
        return DATETIME
    if OTHER in real:
        raise SqlSemanticError("Columns of nested types can't be combined with others")
    return TEXT


def to_kind(v: Value, kind: str) -> Value:
    if v.kind == kind:
        return v
    if v.kind == NULL:
        return replace(v, col=v.col.cast(SPARK_TYPE[kind]), kind=kind)
    if kind == TEXT:
        return Value(text(v), TEXT, v.dynamic)
    return Value(v.col.cast(SPARK_TYPE[kind]), kind)
