"""Command line: inspect, tables, schema, query."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from typing import Any

from gridlark import dbapi, reflection
from gridlark.errors import Error
from gridlark.sql import ast as a
from gridlark.sql.parser import parse


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="gridlark", description="SQL over workbooks and parquet folders")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=text)
        p.add_argument("file")
        p.add_argument("--engine")
        p.add_argument("--data-only", action=argparse.BooleanOptionalAction, default=True, help="values of formulas instead of their text")
        return p

    command("inspect", "tables with their columns and rows")
    command("tables", "names of the tables")
    command("schema", "columns of a table").add_argument("table")
    query = command("query", "run a statement")
    query.add_argument("sql")
    query.add_argument("--write", action="store_true", help="allow statements that change data")
    query.add_argument("--backup", action="store_true", help="copy the file before the first change")
    return top


def table_text(headers: Sequence[str], rows: Sequence[Sequence[Any]]) -> str:
    cells = [[("NULL" if x is None else str(x)) for x in r] for r in rows]
    widths = [max(len(h), *(len(r[i]) for r in cells)) if cells else len(h) for i, h in enumerate(headers)]
    line = lambda r: " | ".join(x.ljust(w) for x, w in zip(r, widths, strict=True)).rstrip()
    return "\n".join([line(headers), "-+-".join("-" * w for w in widths), *map(line, cells)])


def _run(args: argparse.Namespace) -> str:
    options: dict[str, Any] = {}
    name = args.engine or ("parquet" if args.file.startswith("parquet://") else None)
    if name != "parquet" and args.file.lower().endswith(".xlsx"):
        options["data_only"] = args.data_only
        if args.command == "query" and args.backup:
            options["backup"] = True
    if args.command == "query" and not args.write and not isinstance(parse(args.sql)[0], a.QUERIES):
        raise Error("Statements that change data need --write")
    with dbapi.connect(args.file, engine=args.engine, **options) as connection:
        match args.command:
            case "tables":
                return "\n".join(reflection.list_tables(connection))
            case "schema":
                columns = reflection.get_columns(connection, args.table)
                return table_text(["column", "type", "nullable"], [[c["name"], c["type_name"], "yes" if c["nullable"] else "no"] for c in columns])
            case "inspect":
                lines = []
                for t in reflection.list_tables(connection):
                    relation = connection.catalog.resolve(t)
                    lines.append(f"{t}: {relation.df.count()} rows; {', '.join(relation.columns)}")
                return "\n".join(lines)
        cursor = connection.execute(args.sql)
        if cursor.description is None:
            return f"{max(0, cursor.rowcount)} rows changed"
        return table_text([d[0] for d in cursor.description], cursor.fetchall())


def main(argv: Sequence[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    try:
        print(_run(args))
    except Error as error:
        print(f"Error: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
