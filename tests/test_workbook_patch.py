"""Saving leaves what it doesn't change as it is."""

import datetime as dt
import re
import zipfile

import pytest

from gridlark import dbapi
from gridlark.errors import DataError, Error
from gridlark.sources import xlsx

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
KIND = "application/vnd.openxmlformats-officedocument.spreadsheetml"

PARTS = {
    "[Content_Types].xml": f'<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Default Extension="bin" ContentType="image/png"/><Override PartName="/xl/workbook.xml" ContentType="{KIND}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{KIND}.worksheet+xml"/><Override PartName="/xl/worksheets/sheet2.xml" ContentType="{KIND}.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="{KIND}.styles+xml"/><Override PartName="/xl/sharedStrings.xml" ContentType="{KIND}.sharedStrings+xml"/></Types>',
    "_rels/.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{REL}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{REL}/worksheet" Target="/xl/worksheets/sheet2.xml"/><Relationship Id="rId3" Type="{REL}/styles" Target="styles.xml"/><Relationship Id="rId4" Type="{REL}/sharedStrings" Target="sharedStrings.xml"/></Relationships>',
    "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets><sheet name="t &amp; co" sheetId="1" r:id="rId1"/><sheet name="other" sheetId="7" r:id="rId2"/></sheets><definedNames><definedName name="a" localSheetId="0">1</definedName><definedName name="b" localSheetId="1">2</definedName></definedNames></workbook>',
    "xl/styles.xml": f'<styleSheet xmlns="{MAIN}"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="0" fontId="1" applyFont="1"/><xf numFmtId="14"/></cellXfs></styleSheet>',
    "xl/sharedStrings.xml": f'<sst xmlns="{MAIN}"><si><t>id</t></si><si><t>name</t></si><si><r><rPr><b/></rPr><t>rich </t></r><r><t>text</t></r></si></sst>',
    "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{MAIN}" xmlns:x14ac="http://x"><dimension ref="A1:E4"/><cols><col min="1" max="1" width="33"/></cols><sheetData>'
    '<row r="1" ht="20" customHeight="1" x14ac:dyDescent="0.2"><c r="A1" s="1" t="s"><v>0</v></c><c r="B1" s="1" t="s"><v>1</v></c><c r="C1" t="inlineStr"><is><t>total</t></is></c><c r="D1" t="inlineStr"><is><t>twice</t></is></c></row>'
    '<row r="2"><c r="A2" s="1"><v>1</v></c><c r="B2" t="s"><v>2</v></c><c r="C2"><f>A2+10</f><v>11</v></c><c r="D2"><f t="shared" si="0" ref="D2:D4">A2*2+$A$2</f><v>3</v></c></row>'
    '<row r="3"><c r="A3"><v>2</v></c><c r="B3" s="1" t="inlineStr"><is><t>Bob</t></is></c><c r="C3"><f>A3+10</f><v>12</v></c><c r="D3"><f t="shared" si="0"/><v>5</v></c></row>'
    '<row r="4"><c r="A4"><v>3</v></c><c r="B4" t="inlineStr"><is><t>Cy</t></is></c><c r="C4"><f>A4+10</f><v>13</v></c><c r="D4"><f t="shared" si="0"/><v>7</v></c><c r="E4" t="inlineStr"><is><t>beside</t></is></c></row>'
    '</sheetData><mergeCells count="1"><mergeCell ref="G1:H1"/></mergeCells></worksheet>',
    "xl/worksheets/sheet2.xml": f'<x:worksheet xmlns:x="{MAIN}"><x:sheetData><x:row r="1"><x:c r="A1" t="inlineStr"><x:is><x:t>k</x:t></x:is></x:c></x:row><x:row r="2"><x:c r="A2" s="2"><x:v>45000</x:v></x:c></x:row></x:sheetData></x:worksheet>',
    "xl/media/image1.bin": "\x89not xml",
}


@pytest.fixture
def book(tmp_path):
    path = tmp_path / "book.xlsx"
    with zipfile.ZipFile(path, "w") as z:
        for name, text in PARTS.items():
            z.writestr(name, text)
    return str(path)


def run(spark, book, *statements, **options):
    with dbapi.connect(book, spark=spark, **options) as c:
        for s in statements:
            c.execute(s)


def parts(book):
    with zipfile.ZipFile(book) as z:
        return {n: z.read(n).decode() for n in z.namelist()}


def cells(text):
    return {m[1]: m[0] for m in re.finditer(r'<(?:x:)?c r="([A-Z]+\d+)"(?:[^>]*?/>|.*?</(?:x:)?c>)', text)}


def values(book, **options):
    return {s.name: [s.headers, *s.rows] for s in xlsx.read_workbook(book, **options)}


def test_update_in_place(spark, book):
    run(spark, book, "UPDATE \"t & co\" SET name = 'Ann' WHERE id = 2")
    new = parts(book)
    assert {n: t for n, t in new.items() if n not in ("xl/worksheets/sheet1.xml", "xl/workbook.xml")} == {n: t for n, t in PARTS.items() if n not in ("xl/worksheets/sheet1.xml", "xl/workbook.xml")}
    sheet, old = new["xl/worksheets/sheet1.xml"], cells(PARTS["xl/worksheets/sheet1.xml"])
    assert {r: c for r, c in cells(sheet).items() if r != "B3"} == {r: c for r, c in old.items() if r != "B3"}
    assert cells(sheet)["B3"].startswith('<c r="B3" s="1"') and "Ann" in cells(sheet)["B3"]
    assert sheet.split("<sheetData>")[0] == PARTS["xl/worksheets/sheet1.xml"].split("<sheetData>")[0] and sheet.endswith('<mergeCells count="1"><mergeCell ref="G1:H1"/></mergeCells></worksheet>')
    assert '<row r="1" ht="20" customHeight="1">' in sheet and 'fullCalcOnLoad="1"' in new["xl/workbook.xml"]


def test_formulas_stay_formulas(spark, book):
    assert [r[2:] for r in values(book, cached_values=False)["t & co"][1:]] == [["=A2+10", "=A2*2+$A$2"], ["=A3+10", "=A3*2+$A$2"], ["=A4+10", "=A4*2+$A$2"]]
    run(spark, book, "UPDATE \"t & co\" SET name = 'Ann' WHERE id = 2", data_only=False)
    assert {r: c for r, c in cells(parts(book)["xl/worksheets/sheet1.xml"]).items() if r != "B3"} == {r: c for r, c in cells(PARTS["xl/worksheets/sheet1.xml"]).items() if r != "B3"}
    run(spark, book, "DELETE FROM \"t & co\" WHERE id = 2", data_only=False)
    assert values(book, cached_values=False)["t & co"][1:] == [[1, "rich text", "=A2+10", "=A2*2+$A$2"], [3, "Cy", "=A4+10", "=A4*2+$A$2"]]
    assert "<f>A4+10</f>" in cells(parts(book)["xl/worksheets/sheet1.xml"])["C3"]


def test_a_shared_formula_whose_holder_changes(spark, book):
    run(spark, book, 'UPDATE "t & co" SET twice = 99 WHERE id = 1')
    assert [r[3] for r in values(book)["t & co"][1:]] == [99, 5, 7]
    assert "shared" not in parts(book)["xl/worksheets/sheet1.xml"] and "<f>A3+10</f>" in parts(book)["xl/worksheets/sheet1.xml"]


def test_delete_and_insert_keep_the_styles_of_their_places(spark, book):
    run(spark, book, "DELETE FROM \"t & co\" WHERE id = 1", "INSERT INTO \"t & co\" (id, name) VALUES (9, 'new')")
    sheet = cells(parts(book)["xl/worksheets/sheet1.xml"])
    assert values(book)["t & co"][1:] == [[2, "Bob", 12, 5], [3, "Cy", 13, 7], [9, "new", None, None]]
    assert [re.search(r' s="(\d)"', sheet[r])[1] for r in ("A1", "A2", "B3")] == ["1", "1", "1"]


def test_dates_take_a_date_style(spark, book):
    assert values(book)["other"] == [["k"], [dt.datetime(2023, 3, 15)]]
    run(spark, book, "INSERT INTO other VALUES ('2024-02-29')", 'CREATE TABLE made (d DATE, n INTEGER)')
    with dbapi.connect(book, spark=spark) as c:
        c.execute("INSERT INTO made VALUES (?, 5)", (dt.date(2024, 2, 29),))
        assert c.execute("SELECT * FROM made").fetchall() == [(dt.date(2024, 2, 29), 5)]
    new = parts(book)
    assert values(book)["made"] == [["d", "n"], [dt.datetime(2024, 2, 29), 5]]
    assert new["xl/styles.xml"].count("<xf ") >= 4 and 'cellXfs count="4"' in new["xl/styles.xml"]
    assert set(values(book)) == {"t & co", "other", "made", "__excel_meta__"}
    assert new["xl/worksheets/sheet1.xml"] == PARTS["xl/worksheets/sheet1.xml"]


def test_dropped_sheets_are_forgotten(spark, book):
    run(spark, book, 'DROP TABLE "t & co"')
    new = parts(book)
    assert list(values(book)) == ["other"] and "xl/worksheets/sheet1.xml" not in new and "sheet1.xml" not in new["[Content_Types].xml"]
    assert re.findall(r"<definedName [^>]*>", new["xl/workbook.xml"]) == ['<definedName name="b" localSheetId="0">']
    assert new["xl/worksheets/sheet2.xml"] == PARTS["xl/worksheets/sheet2.xml"] and new["xl/media/image1.bin"] == PARTS["xl/media/image1.bin"]


def test_dropped_and_added_columns(spark, book):
    run(spark, book, 'ALTER TABLE "t & co" DROP COLUMN twice', 'ALTER TABLE "t & co" ADD COLUMN note TEXT', "UPDATE \"t & co\" SET note = 'n' WHERE id = 3")
    assert values(book)["t & co"] == [["id", "name", "total", "note"], [1, "rich text", 11, None], [2, "Bob", 12, None], [3, "Cy", 13, "n"]]
    assert "beside" in parts(book)["xl/worksheets/sheet1.xml"]


def test_prefixed_sheets(spark, book):
    run(spark, book, "UPDATE other SET k = '2024-01-01'")
    text = parts(book)["xl/worksheets/sheet2.xml"]
    assert text.startswith("<x:worksheet") and "<x:c " in text and "<c " not in text
    assert values(book)["other"] in ([["k"], [dt.datetime(2024, 1, 1)]], [["k"], ["2024-01-01"]])


def test_what_a_cell_cannot_hold(spark, book):
    before = parts(book)
    with dbapi.connect(book, spark=spark) as c:
        with pytest.raises(Error):
            c.execute("UPDATE other SET k = ?", ("bell \x07",))
    assert parts(book) == before
    with pytest.raises(DataError):
        xlsx._cell("\x01", "A1")
    assert 't="e"' in xlsx._cell(float("nan"), "A1") and "inf" not in xlsx._cell(float("-inf"), "A1")


def test_references_move():
    assert xlsx.moved("SUM(A1:$B$2)+Sheet2!C3*$D4+E$5&\"A1\"+LOG10(F6)+A1B", 2, 1) == "SUM(B3:$B$2)+Sheet2!D5*$D6+F$5&\"A1\"+LOG10(G8)+A1B"
