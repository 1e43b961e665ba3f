"""The syntax tree. Nodes are immutable; parameters are places until the binder fills them."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any


@dataclass(frozen=True)
class Literal:
    value: Any


@dataclass(frozen=True)
class Param:
    place: int


@dataclass(frozen=True)
class Name:
    name: str
    source: str | None = None
    quoted: bool = False


@dataclass(frozen=True)
class Negate:
    operand: Any


@dataclass(frozen=True)
class Binary:
    op: str  # + - * / ||
    left: Any
    right: Any


@dataclass(frozen=True)
class Call:
    name: str
    args: tuple


@dataclass(frozen=True)
class Cast:
    operand: Any
    type: str


@dataclass(frozen=True)
class Case:
    operand: Any | None
    branches: tuple  # of (condition or match, result)
    default: Any | None


@dataclass(frozen=True)
class Aggregate:
    func: str
    arg: Name | None  # None: *
    distinct: bool = False
    filter: Any | None = None


@dataclass(frozen=True)
class Windowed:
    func: str
    arg: Name | None
    distinct: bool
    filter: Any | None
    partition: tuple
    order: tuple  # of OrderItem


@dataclass(frozen=True)
class Scalar:
    query: Any


@dataclass(frozen=True)
class Compare:
    op: str
    left: Any
    right: Any


@dataclass(frozen=True)
class IsNull:
    operand: Any
    negated: bool


@dataclass(frozen=True)
class InList:
    operand: Any
    items: tuple
    negated: bool


@dataclass(frozen=True)
class InQuery:
    operand: Any
    query: Any
    negated: bool


@dataclass(frozen=True)
class Between:
    operand: Any
    low: Any
    high: Any
    negated: bool


@dataclass(frozen=True)
class Like:
    operand: Any
    pattern: Any
    escape: Any | None
    folded: bool
    negated: bool


@dataclass(frozen=True)
class Exists:
    query: Any


@dataclass(frozen=True)
class Not:
    operand: Any


@dataclass(frozen=True)
class Logic:
    op: str  # AND, OR
    left: Any
    right: Any


@dataclass(frozen=True)
class OrderItem:
    expr: Any
    descending: bool


@dataclass(frozen=True)
class Item:
    expr: Any
    alias: str | None


@dataclass(frozen=True)
class Source:
    table: str
    alias: str | None

    @property
    def ref(self) -> str:
        return self.alias or self.table


@dataclass(frozen=True)
class Join:
    kind: str  # inner, left, right, full, cross
    source: Source
    on: Any | None


@dataclass(frozen=True)
class Select:
    items: tuple  # of Item; empty: *
    source: Source
    joins: tuple
    distinct: bool = False
    where: Any | None = None
    group: tuple = ()
    having: Any | None = None
    order: tuple = ()
    limit: Any | None = None
    offset: Any | None = None


@dataclass(frozen=True)
class Compound:
    branches: tuple
    ops: tuple  # UNION, UNION ALL, INTERSECT, EXCEPT
    order: tuple = ()
    limit: Any | None = None
    offset: Any | None = None


@dataclass(frozen=True)
class With:
    tables: tuple  # of (name, query)
    query: Any


@dataclass(frozen=True)
class Conflict:
    keys: tuple
    sets: tuple | None  # of (column, expr); None: do nothing


@dataclass(frozen=True)
class Insert:
    table: str
    columns: tuple | None
    rows: tuple | None
    query: Any | None
    conflict: Conflict | None


@dataclass(frozen=True)
class Update:
    table: str
    sets: tuple
    where: Any | None


@dataclass(frozen=True)
class Delete:
    table: str
    where: Any | None


@dataclass(frozen=True)
class Create:
    table: str
    columns: tuple  # of (name, type)


@dataclass(frozen=True)
class Drop:
    table: str


@dataclass(frozen=True)
class Alter:
    table: str
    action: str  # add, drop, rename
    column: str
    to: str | None  # type or new name


QUERIES = (Select, Compound, With)
CONDITIONS = (Compare, IsNull, InList, InQuery, Between, Like, Exists, Not, Logic)


def children(node: Any):
    """The nodes and tuples directly under a node."""
    for value in vars(node).values():
        yield from _nodes(value)


def _nodes(value: Any):
    if isinstance(value, tuple):
        for x in value:
            yield from _nodes(x)
    elif hasattr(value, "__dataclass_fields__"):
        yield value


def walk(node: Any, into_queries: bool = False):
    """The node and all below it; queries inside are met, but entered only if asked."""
    yield node
    if isinstance(node, QUERIES) and not into_queries:
        return
    for child in children(node):
        yield from walk(child, into_queries)
