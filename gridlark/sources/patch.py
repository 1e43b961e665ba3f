"""Saving into a workbook that is there: only the cells of changed sheets are written, in place.

Every part of the file that isn't touched stays byte for byte: styles, shared strings, charts, the parts of a sheet
around its cells. A cell whose value is the same stays as it is, formula, cached value and rich text included; one whose
value differs keeps the style of its place.
"""

from __future__ import annotations

import os
import re
import tempfile
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterable
from dataclasses import dataclass
from typing import Any
from xml.sax.saxutils import escape, unescape

from gridlark.sources import xlsx
from gridlark.sources.inference import cell_text

_TAG = r"<(?:[\w.-]+:)?"


@dataclass
class Part:
    """A sheet's place in the file."""

    name: str
    target: str
    link: str


def save(path: str, changed: dict[str, tuple[list[str], Iterable[list[Any]]]], kept: Iterable[str], *, cached: bool) -> None:
    """Writes the changed sheets, by name, with their columns and rows; takes away those that are neither changed nor kept.
    cached: whether formulas were read as what they gave."""
    folder = os.path.dirname(os.path.abspath(path))
    handle, staged = tempfile.mkstemp(suffix=".xlsx", dir=folder)
    try:
        with os.fdopen(handle, "wb") as f, zipfile.ZipFile(path) as old, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as new:
            _Patch(old, cached).write(new, changed, set(kept))
        os.replace(staged, path)
    except BaseException:
        if os.path.exists(staged):
            os.unlink(staged)
        raise


class _Patch:
    def __init__(self, old: zipfile.ZipFile, cached: bool):
        self.old, self.cached = old, cached
        self.text = {n: old.read(n).decode("utf-8") for n in ("xl/workbook.xml", "xl/_rels/workbook.xml.rels", "[Content_Types].xml")}
        targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(self.text["xl/_rels/workbook.xml.rels"]).iter(f"{xlsx._PACKAGE}Relationship")}
        book = ET.fromstring(self.text["xl/workbook.xml"])
        self.parts = [Part(s.get("name"), self._path(targets[s.get(f"{xlsx._REL}id")]), s.get(f"{xlsx._REL}id")) for s in book.iter(f"{xlsx._MAIN}sheet")]
        properties = book.find(f"{xlsx._MAIN}workbookPr")
        self.late = properties is not None and properties.get("date1904") in ("1", "true")
        self.styles = old.read("xl/styles.xml").decode("utf-8") if "xl/styles.xml" in old.namelist() else None
        self.dates = xlsx._date_styles(old)
        self.strings = xlsx._strings(old)
        self.new_styles: dict[int, int] = {}

    @staticmethod
    def _path(target: str) -> str:
        return target.lstrip("/") if target.startswith("/") else f"xl/{target}"

    def write(self, new: zipfile.ZipFile, changed: dict, kept: set[str]) -> None:
        there = {p.name: p for p in self.parts}
        for p in [p for p in self.parts if p.name not in changed and p.name not in kept]:
            self._forget(p)
        gone = {p.target for p in there.values() if p not in self.parts}
        gone |= {f"{os.path.dirname(t)}/_rels/{os.path.basename(t)}.rels" for t in gone}
        sheets = {}
        for name, (columns, rows) in changed.items():
            part = there.get(name)
            source = self.old.read(part.target).decode("utf-8") if part else f'{xlsx._HEAD}<worksheet xmlns="{xlsx._MAIN[1:-1]}"><sheetData/></worksheet>'
            if part is None:
                part = self._add(name)
            sheets[part.target] = self._sheet(source, columns, rows)
        if any(re.search(rf"{_TAG}f[\s>/]", x) for x in sheets.values()):
            self._calculate_anew()
        written = {**sheets, **self.text}
        if self.new_styles:
            written["xl/styles.xml"] = self.styles
        for item in self.old.infolist():
            if item.filename not in written and item.filename not in gone:
                new.writestr(item, self.old.read(item.filename))
        for name, text in written.items():
            new.writestr(name, text.encode("utf-8"))

    # the workbook's list of sheets

    def _edit(self, name: str, pattern: str, to, flags: int = re.S) -> None:
        self.text[name] = re.sub(pattern, to, self.text[name], count=1, flags=flags)

    def _add(self, name: str) -> Part:
        known = set(self.old.namelist()) | {p.target for p in self.parts}
        number = next(i for i in range(1, 100_000) if f"xl/worksheets/sheet{i}.xml" not in known)
        links = set(re.findall(r'Id="([^"]*)"', self.text["xl/_rels/workbook.xml.rels"]))
        link = next(f"rId{i}" for i in range(1, 100_000) if f"rId{i}" not in links)
        ids = [int(x) for x in re.findall(r'sheetId="(\d+)"', self.text["xl/workbook.xml"])]
        part = Part(name, f"xl/worksheets/sheet{number}.xml", link)
        self.parts.append(part)
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"
        sheet = f'sheet xmlns:r="{xlsx._REL[1:-1]}" name="{escape(name, xlsx._QUOTES)}" sheetId="{max(ids, default=0) + 1}" r:id="{link}"/>'
        self._edit("xl/workbook.xml", r"</((?:[\w.-]+:)?)sheets>", lambda m: f"<{m[1]}{sheet}{m[0]}")
        relation = f'Relationship Id="{link}" Type="{xlsx._REL[1:-1]}/worksheet" Target="worksheets/sheet{number}.xml"/>'
        self._edit("xl/_rels/workbook.xml.rels", r"</((?:[\w.-]+:)?)Relationships>", lambda m: f"<{m[1]}{relation}{m[0]}")
        override = f'Override PartName="/{part.target}" ContentType="{kind}"/>'
        self._edit("[Content_Types].xml", r"</((?:[\w.-]+:)?)Types>", lambda m: f"<{m[1]}{override}{m[0]}")
        return part

    def _forget(self, part: Part) -> None:
        place = self.parts.index(part)
        self.parts.remove(part)
        sheets = re.finditer(rf"{_TAG}sheet\s[^>]*?(?:/>|></(?:[\w.-]+:)?sheet>)", self.text["xl/workbook.xml"], re.S)
        own = next(m[0] for m in sheets if unescape(re.search(r'\sname="([^"]*)"', m[0])[1], {"&quot;": '"', "&apos;": "'"}) == part.name)
        self.text["xl/workbook.xml"] = self.text["xl/workbook.xml"].replace(own, "", 1)

        def renumbered(m: re.Match) -> str:
            """A name that belongs to one sheet goes with it, or follows it to its new place."""
            local = re.search(r'localSheetId="(\d+)"', m[1])
            if local is None or int(local[1]) < place:
                return m[0]
            return "" if int(local[1]) == place else m[0].replace(local[0], f'localSheetId="{int(local[1]) - 1}"', 1)

        self.text["xl/workbook.xml"] = re.sub(r"<(?:[\w.-]+:)?definedName\s([^>]*)>.*?</(?:[\w.-]+:)?definedName>", renumbered, self.text["xl/workbook.xml"], flags=re.S)
        self._edit("xl/workbook.xml", rf"{_TAG}definedNames>\s*</(?:[\w.-]+:)?definedNames>", "")
        self._edit("xl/workbook.xml", r'\sactiveTab="\d+"', "")
        self._edit("xl/_rels/workbook.xml.rels", rf'{_TAG}Relationship\s[^>]*?Id="{re.escape(part.link)}"[^>]*?/>', "")
        self._edit("[Content_Types].xml", rf'{_TAG}Override\s[^>]*?PartName="/{re.escape(part.target)}"[^>]*?/>', "")

    def _calculate_anew(self) -> None:
        """Values that formulas gave before may not hold any more."""
        book = self.text["xl/workbook.xml"]
        if re.search(r'fullCalcOnLoad="(?:1|true)"', book):
            return
        if m := re.search(rf"{_TAG}calcPr", book):
            self.text["xl/workbook.xml"] = f'{book[: m.end()]} fullCalcOnLoad="1"{book[m.end() :]}'
            return
        last = max(re.finditer(r"</((?:[\w.-]+:)?)(?:sheets|functionGroups|externalReferences|definedNames)>", book), key=lambda m: m.end())
        self.text["xl/workbook.xml"] = f'{book[: last.end()]}<{last[1]}calcPr fullCalcOnLoad="1"/>{book[last.end() :]}'

    # cells

    def _style(self, number_format: int) -> int:
        """A style that shows dates, added to the workbook's."""
        if number_format not in self.new_styles:
            if self.styles is None:
                self.styles = xlsx._STYLES
                self._edit("[Content_Types].xml", r"</((?:[\w.-]+:)?)Types>", lambda m: f'<{m[1]}Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{m[0]}')
                self._edit("xl/_rels/workbook.xml.rels", r"</((?:[\w.-]+:)?)Relationships>", lambda m: f'<{m[1]}Relationship Id="rIdStyles" Type="{xlsx._REL[1:-1]}/styles" Target="styles.xml"/>{m[0]}')
            root = ET.fromstring(self.styles)
            n = len(root.find(f"{xlsx._MAIN}cellXfs"))
            self.styles = re.sub(r"</((?:[\w.-]+:)?)cellXfs>", lambda m: f'<{m[1]}xf numFmtId="{number_format}" fontId="0" fillId="0" borderId="0" xfId="0" applyNumberFormat="1"/>{m[0]}', self.styles, count=1)
            self.styles = re.sub(rf'({_TAG}cellXfs[^>]*?count=")\d+"', rf'\g<1>{n + 1}"', self.styles, count=1)
            self.new_styles[number_format] = n
            self.dates.add(n)
        return self.new_styles[number_format]

    def _sheet(self, source: str, columns: list[str], rows: Iterable[list[Any]]) -> str:
        root = ET.fromstring(source)
        data = root.find(f"{xlsx._MAIN}sheetData")
        old: dict[int, tuple[dict[str, str], dict[int, ET.Element]]] = {}
        at = 0
        for row in data if data is not None else ():
            at = int(row.get("r", at + 1))
            cells, place = {}, -1
            for c in row.findall(f"{xlsx._MAIN}c"):
                place = xlsx._column(c.get("r")) if c.get("r") else place + 1
                cells[place] = c
            old[at] = ({k: v for k, v in row.attrib.items() if not k.startswith("{") and k not in ("r", "spans")}, cells)
        shared = xlsx._shared_formulas(data) if data is not None else {}
        value = lambda c: xlsx._value(c, self.strings, self.dates, self.late, self.cached, shared)
        width = max((p for p, c in old.get(1, ({}, {}))[1].items() if value(c) is not None), default=-1) + 1
        new = [list(columns), *map(list, rows)]
        same = {(r, p) for r, (_, cells) in old.items() if r <= len(new) for p, c in cells.items() if p < len(columns) and _alike(value(c), new[r - 1][p])}
        # formulas that one cell holds for several go together
        broken = {xlsx._group(c) for r, (_, cells) in old.items() for p, c in cells.items() if (r, p) not in same and (p < max(width, len(columns)) or r > len(new))} - {None}
        prefix = re.search(r"<((?:[\w.-]+:)?)worksheet", source)[1]
        out = []
        for r, values in enumerate(new, 1):
            attributes, cells = old.get(r, ({}, {}))
            made = []
            for p in range(max([len(values), *[q + 1 for q in cells]])):
                c = cells.get(p)
                ref = f"{xlsx._letters(p)}{r}"
                if c is not None and ((r, p) in same or p >= max(width, len(columns))) and xlsx._group(c) not in broken:
                    made.append(_raw(c, ref))
                elif p < len(values):
                    made.append(self._cell(values[p], ref, c))
                elif c is not None and c.get("s"):
                    made.append(f'<c r="{ref}" s="{c.get("s")}"/>')
            shown = "".join(f' {k}="{escape(v, xlsx._QUOTES)}"' for k, v in attributes.items())
            out.append(f'<row r="{r}"{shown}>{"".join(made)}</row>')
        body = "".join(out)
        if prefix:
            body = re.sub(r"<(/?)(row|c|v|f|is|t|r|rPr)\b", rf"<\1{prefix}\2", body)
        text = re.sub(r"<((?:[\w.-]+:)?)sheetData\s*/>|<((?:[\w.-]+:)?)sheetData>.*</(?:[\w.-]+:)?sheetData>", lambda m: f"<{prefix}sheetData>{body}</{prefix}sheetData>", source, count=1, flags=re.S)
        across = max([len(columns), *[q + 1 for _, cells in old.values() for q in cells]])
        return re.sub(rf'({_TAG}dimension\s[^>]*?ref=")[^"]*"', rf'\g<1>A1:{xlsx._letters(max(0, across - 1))}{len(new)}"', text, count=1)

    def _cell(self, x: Any, ref: str, old: ET.Element | None) -> str:
        style = int(old.get("s", 0)) if old is not None else 0
        if xlsx.is_date(x):
            if style not in self.dates:
                style = self._style(22 if hasattr(x, "hour") else 14)
        elif style in self.dates and isinstance(x, int | float) and not isinstance(x, bool):
            style = 0
        return xlsx._cell(x, ref, style, self.late)


def _alike(old: Any, new: Any) -> bool:
    """Whether a cell holds a table's value; in a column of several kinds that is the cell's text."""
    if old is None or new is None:
        return old is new
    if isinstance(old, bool) != isinstance(new, bool):
        return isinstance(new, str) and cell_text(old) == new
    if isinstance(new, str) and not isinstance(old, str):
        return cell_text(old) == new
    return old == new or xlsx.is_date(old) and xlsx.is_date(new) and cell_text(old)[:10] == cell_text(new) and cell_text(old)[10:] in ("", " 00:00:00")


ET.register_namespace("", xlsx._MAIN[1:-1])


def _raw(c: ET.Element, ref: str) -> str:
    c.set("r", ref)
    c.tail = None
    return ET.tostring(c, encoding="unicode").replace(f' xmlns="{xlsx._MAIN[1:-1]}"', "", 1).replace(" />", "/>")

