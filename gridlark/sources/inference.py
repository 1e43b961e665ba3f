"""Kinds of columns of untyped cells."""

from __future__ import annotations

import datetime as dt
from typing import Any

from gridlark.functions.values import BOOL, DATE, DATETIME, INT, NULL, REAL, TEXT, common_kind

_KINDS = {type(None): NULL, bool: BOOL, int: INT, float: REAL, dt.datetime: DATETIME, dt.date: DATE}


def column_kind(values: list[Any]) -> tuple[str, bool]:
    """The least kind that holds all cells of a column, and whether it is text that may stand for other kinds. No value is
    lost: a column of several kinds is text."""
    kind = common_kind(sorted({_KINDS.get(type(x), TEXT) for x in values}))
    if kind == INT and not all(-(2**63) <= x < 2**63 for x in values if x is not None):
        kind = REAL
    return (TEXT, True) if kind in (NULL, TEXT) else (kind, False)


def as_kind(value: Any, kind: str) -> Any:
    if value is None:
        return None
    if kind == TEXT:
        return cell_text(value)
    if kind == REAL:
        return float(value)
    if kind == DATETIME and not isinstance(value, dt.datetime):
        return dt.datetime.combine(value, dt.time())
    return value


def cell_text(value: Any) -> str:
    return value.isoformat(" ") if isinstance(value, dt.datetime) else str(value)
