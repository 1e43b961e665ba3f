"""Workbooks: a reader and writer of .xlsx over the standard library, and a Spark data source on top.

A workbook is one compressed file, so it is read by one task and written by one; the engine behind is for the tables
that come out of it.
"""

from __future__ import annotations

import datetime as dt
import io
import math
import os
import re
import tempfile
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any
from xml.sax.saxutils import escape

from gridlark.errors import DataError, OperationalError

# Fixed values of the format.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"
_DATE_FORMATS = frozenset((*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)))


@dataclass
class Sheet:
    name: str
    headers: list[str]
    rows: list[list[Any]] = field(default_factory=list)


def read_workbook(path: str, *, cached_values: bool = True) -> list[Sheet]:
    """All sheets. cached_values: what formulas gave when the file was saved, else their text."""
    try:
        with zipfile.ZipFile(path) as z:
            return _read(z, cached_values)
    except FileNotFoundError:
        raise OperationalError(f"No such workbook: {path}") from None
    except (zipfile.BadZipFile, KeyError, ET.ParseError) as e:
        raise OperationalError(f"Not a workbook: {path} ({e})") from None


def _read(z: zipfile.ZipFile, cached: bool) -> list[Sheet]:
    book = ET.fromstring(z.read("xl/workbook.xml"))
    targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")).iter(f"{_PACKAGE}Relationship")}
    properties = book.find(f"{_MAIN}workbookPr")
    late = properties is not None and properties.get("date1904") in ("1", "true")
    strings, dates = _strings(z), _date_styles(z)
    out = []
    for sheet in book.iter(f"{_MAIN}sheet"):
        target = targets[sheet.get(f"{_REL}id")]
        part = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        with z.open(part) as f:
            cells = list(_rows(f, strings, dates, late, cached))
        out.append(_sheet(sheet.get("name"), cells))
    return out


def _strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    return [_plain(si) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall(f"{_MAIN}si")]


def _plain(si: ET.Element) -> str:
    """The text of a string item without its phonetic guides."""
    return "".join(t.text or "" for run in [si, *si.findall(f"{_MAIN}r")] for t in run.findall(f"{_MAIN}t"))


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """The cell styles that show numbers as dates."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iter(f"{_MAIN}numFmt")}
    shows = lambda code: bool(re.search("[ymdhs]", re.sub(r'"[^"]*"|\\.|_.|\*.|\[(?!h+\]|m+\]|s+\])[^\]]*\]', "", code), re.I))
    formats = root.find(f"{_MAIN}cellXfs")
    used = [int(x.get("numFmtId", 0)) for x in (formats if formats is not None else ())]
    return {i for i, n in enumerate(used) if (shows(own[n]) if n in own else n in _DATE_FORMATS)}


def _rows(f, strings: list[str], dates: set[int], late: bool, cached: bool) -> Iterator[tuple[int, dict[int, Any]]]:
    """(row number from 1, values by column from 0)."""
    number = 0
    shared: Shared = {}
    for _, row in ET.iterparse(f):
        if row.tag != f"{_MAIN}row":
            continue
        number = int(row.get("r", number + 1))
        cells, column = {}, -1
        for c in row.findall(f"{_MAIN}c"):
            ref = c.get("r")
            column = _column(ref) if ref else column + 1
            if not cached:
                _hold(c, shared)
            value = _value(c, strings, dates, late, cached, shared)
            if value is not None:
                cells[column] = value
        yield number, cells
        row.clear()


def _column(ref: str) -> int:
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


#: A formula that one cell holds for several: by its number, that cell and the formula.
Shared = dict[str, tuple[str, str]]


def _hold(c: ET.Element, shared: Shared) -> None:
    formula = c.find(f"{_MAIN}f")
    if formula is not None and formula.get("t") == "shared" and formula.text:
        shared[formula.get("si")] = c.get("r"), formula.text


def _shared_formulas(data: ET.Element) -> Shared:
    out: Shared = {}
    for c in data.iter(f"{_MAIN}c"):
        _hold(c, out)
    return out


def _group(c: ET.Element) -> str | None:
    """What the cells of a shared or an array formula have in common."""
    formula = c.find(f"{_MAIN}f")
    if formula is None or formula.get("t") not in ("shared", "array"):
        return None
    return f"{formula.get('t')}:{formula.get('si') or formula.get('ref')}"


_REFERENCE = re.compile(r"""("[^"]*"|'[^']*')|(?<![A-Za-z0-9_.])(\$?)([A-Za-z]{1,3})(\$?)([0-9]{1,7})(?![A-Za-z0-9_.(])""")


def moved(formula: str, rows: int, columns: int) -> str:
    """A formula as it reads so many rows and columns on: references without $ move along."""

    def step(m: re.Match) -> str:
        if m[1]:
            return m[0]
        column = m[3] if m[2] else _letters(_column(m[3]) + columns)
        return f"{m[2]}{column}{m[4]}{m[5] if m[4] else int(m[5]) + rows}"

    return _REFERENCE.sub(step, formula)


def _value(c: ET.Element, strings: list[str], dates: set[int], late: bool, cached: bool, shared: Shared) -> Any:
    kind = c.get("t", "n")
    formula = c.find(f"{_MAIN}f")
    if formula is not None and not cached:
        if formula.text or formula.get("si") not in shared:
            return "=" + (formula.text or "")
        start, text = shared[formula.get("si")]
        ref = c.get("r")
        row = lambda x: int(re.sub("[^0-9]", "", x))
        return "=" + moved(text, row(ref) - row(start), _column(ref) - _column(start))
    if kind == "inlineStr":
        inline = c.find(f"{_MAIN}is")
        return _plain(inline) if inline is not None else None
    v = c.find(f"{_MAIN}v")
    if v is None or v.text is None:
        return None
    match kind:
        case "s":
            return strings[int(v.text)]
        case "b":
            return v.text.strip() in ("1", "true")
        case "str" | "e":
            return v.text
        case "d":
            return dt.datetime.fromisoformat(v.text.removesuffix("Z"))
    n = float(v.text) if re.search("[.eE]", v.text) else int(v.text)
    return _date(n, late) if int(c.get("s", 0)) in dates else n


def _date(n: float, late: bool) -> dt.datetime:
    """A serial day; the early epoch counts a 29 February 1900 that there wasn't."""
    if late:
        start = dt.datetime(1904, 1, 1)
    else:
        start = dt.datetime(1899, 12, 30) if n >= 60 else dt.datetime(1899, 12, 31)
    return start + dt.timedelta(milliseconds=round(n * 86_400_000))


def headers(values: list[Any], where: str) -> list[str]:
    """Names of columns: not empty, and different even when folded."""
    out: list[str] = []
    for place, value in enumerate(values, 1):
        name = "" if value is None else str(value).strip()
        if not name:
            raise DataError(f"Empty header in column {place} of {where}")
        if name.casefold() in {h.casefold() for h in out}:
            raise DataError(f"Duplicate header in {where}: {name}")
        out.append(name)
    return out


def _sheet(name: str, cells: list[tuple[int, dict[int, Any]]]) -> Sheet:
    first = next((c for n, c in cells if n == 1), {})
    width = max(first, default=-1) + 1
    names = headers([first.get(i) for i in range(width)], f"sheet {name!r}")
    rows, at = [], 2
    for number, values in cells:
        if number < 2:
            continue
        rows += [[None] * width for _ in range(number - at)]
        rows.append([values.get(i) for i in range(width)])
        at = number + 1
    while rows and all(x is None for x in rows[-1]):
        rows.pop()
    return Sheet(name, names, rows)


# writing


def write_workbook(path: str, sheets: list[tuple[str, list[str], Iterator[list[Any]]]]) -> None:
    """All sheets into a file beside path, which then takes its place."""
    folder = os.path.dirname(os.path.abspath(path))
    handle, staged = tempfile.mkstemp(suffix=".xlsx", dir=folder)
    try:
        with os.fdopen(handle, "wb") as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
            _write(z, sheets)
        os.replace(staged, path)
    except BaseException:
        if os.path.exists(staged):
            os.unlink(staged)
        raise


_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_STYLES = (
    f'{_HEAD}<styleSheet xmlns="{_MAIN[1:-1]}"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders>'
    '<cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/>'
    '<xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>'
)


def _write(z: zipfile.ZipFile, sheets) -> None:
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = [f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in range(1, len(sheets) + 1)]
    z.writestr(
        "[Content_Types].xml",
        f'{_HEAD}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" '
        'ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>'
        f'<Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>{"".join(parts)}</Types>',
    )
    link = lambda i, what, target: f'<Relationship Id="rId{i}" Type="{_REL[1:-1]}/{what}" Target="{target}"/>'
    package = f'xmlns="{_PACKAGE[1:-1]}"'
    z.writestr("_rels/.rels", f"{_HEAD}<Relationships {package}>{link(1, 'officeDocument', 'xl/workbook.xml')}</Relationships>")
    links = [link(i, "worksheet", f"worksheets/sheet{i}.xml") for i in range(1, len(sheets) + 1)]
    z.writestr("xl/_rels/workbook.xml.rels", f"{_HEAD}<Relationships {package}>{''.join(links)}{link(len(sheets) + 1, 'styles', 'styles.xml')}</Relationships>")
    names = [f'<sheet name="{escape(n, _QUOTES)}" sheetId="{i}" r:id="rId{i}"/>' for i, (n, _, _) in enumerate(sheets, 1)]
    z.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{_REL[1:-1]}"><sheets>{"".join(names)}</sheets></workbook>')
    z.writestr("xl/styles.xml", _STYLES)
    for i, (_, names_, rows) in enumerate(sheets, 1):
        with z.open(f"xl/worksheets/sheet{i}.xml", "w", force_zip64=True) as raw:
            f = io.TextIOWrapper(raw, "utf-8")
            f.write(f'{_HEAD}<worksheet xmlns="{_MAIN[1:-1]}"><sheetData>')
            for r, row in enumerate(_with_header(names_, rows), 1):
                f.write(f'<row r="{r}">{"".join(_cell(x, f"{_letters(k)}{r}") for k, x in enumerate(row))}</row>')
            f.write("</sheetData></worksheet>")
            f.flush()
            f.detach()


_QUOTES = {'"': "&quot;"}
_BARRED = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")


def _with_header(names: list[str], rows: Iterator[list[Any]]) -> Iterator[list[Any]]:
    yield list(names)
    yield from rows


def _letters(column: int) -> str:
    out, n = "", column + 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def is_date(x: Any) -> bool:
    return isinstance(x, dt.date)


def _cell(x: Any, ref: str, style: int | None = None, late: bool = False) -> str:
    """A cell's XML; text that begins with = is a formula. style: of a workbook that has its own."""
    shown = lambda own: f' s="{own if style is None else style}"' if own or style else ""
    match x:
        case None:
            return f'<c r="{ref}"{shown(0)}/>' if style else ""
        case bool():
            return f'<c r="{ref}"{shown(0)} t="b"><v>{int(x)}</v></c>'
        case float() if not math.isfinite(x):
            return f'<c r="{ref}"{shown(0)} t="e"><v>#NUM!</v></c>'
        case int() | float():
            return f'<c r="{ref}"{shown(0)}><v>{x!r}</v></c>'
        case dt.datetime():
            return f'<c r="{ref}"{shown(2)}><v>{_serial(x, late)!r}</v></c>'
        case dt.date():
            return f'<c r="{ref}"{shown(1)}><v>{int(_serial(dt.datetime.combine(x, dt.time()), late))}</v></c>'
    text = str(x)
    if m := _BARRED.search(text):
        raise DataError(f"Cell {ref} can't hold the character {m[0]!r}")
    if text[:1] == "=" and len(text) > 1:
        return f'<c r="{ref}"{shown(0)}><f>{escape(text[1:])}</f></c>'
    return f'<c r="{ref}"{shown(0)} t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


def _serial(x: dt.datetime, late: bool = False) -> float:
    if late:
        return (x - dt.datetime(1904, 1, 1)) / dt.timedelta(days=1)
    days = (x - dt.datetime(1899, 12, 30)) / dt.timedelta(days=1)
    return days if days >= 61 else days - 1
