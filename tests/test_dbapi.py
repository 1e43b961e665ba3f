import datetime as dt
import os
import zipfile

import pytest

from gridlark import cli, dbapi, errors, reflection
from gridlark.sources import datasource
from gridlark.sources.xlsx import read_workbook, write_workbook

ROWS = [[1, "Ann", 1.5, True, dt.datetime(2024, 1, 15, 10, 30)], [2, "B & <b>", None, False, dt.datetime(1900, 1, 5)], [3, None, -2, None, None]]


@pytest.fixture
def book(tmp_path):
    path = str(tmp_path / "book.xlsx")
    write_workbook(path, [("Sheet1", ["id", "name", "x", "ok", "at"], iter(ROWS)), ("Two", ["k"], iter([["v"]]))])
    return path


def test_round_trip(book):
    one, two = read_workbook(book)
    assert one.headers == ["id", "name", "x", "ok", "at"] and one.rows == ROWS and two.rows == [["v"]]


def test_reads_what_others_write(tmp_path):
    """Shared strings, sparse rows, formulas with cached values, styled and early dates, errors."""
    path, main = str(tmp_path / "b.xlsx"), 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="x" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>a</t></si><si><r><t>b</t></r><r><t>c</t></r><rPh><t>no</t></rPh></si></sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {main}><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm"/><numFmt numFmtId="165" formatCode="&quot;day&quot;0"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>')
        z.writestr(
            "xl/worksheets/s.xml",
            f'<worksheet {main}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="inlineStr"><is><t>d</t></is></c></row>'
            '<row r="3"><c r="B3"><f>1+1</f><v>2</v></c><c r="C3" s="1"><v>45306</v></c></row><row r="4"><c r="A4" t="e"><v>#N/A</v></c><c r="B4" t="b"><v>1</v></c><c r="C4" s="2"><v>3.5</v></c></row></sheetData></worksheet>',
        )
    (s,) = read_workbook(path)
    assert s.headers == ["a", "bc", "d"]
    assert s.rows == [[None] * 3, [None, 2, dt.datetime(2024, 1, 15)], ["#N/A", True, 3.5]]
    assert read_workbook(path, cached_values=False)[0].rows[1][1] == "=1+1"


@pytest.mark.parametrize("header", [["id", "ID"], ["id", ""], ["id", "  "]])
def test_bad_headers(tmp_path, spark, header):
    path = str(tmp_path / "b.xlsx")
    write_workbook(path, [("S", header, iter(()))])
    with pytest.raises(errors.DataError):
        dbapi.connect(path, spark=spark)


def test_cursor(book, spark):
    with dbapi.connect(book, spark=spark) as c:
        cursor = c.cursor()
        cursor.execute("SELECT id, name AS n, at FROM Sheet1 WHERE id >= ? ORDER BY id", (1,))
        assert [d[0] for d in cursor.description] == ["id", "n", "at"] and cursor.rowcount == 3
        assert cursor.description[0][1] == dbapi.NUMBER and cursor.description[1][1] == dbapi.STRING and cursor.description[2][1] == dbapi.DATETIME
        assert cursor.fetchone()[0] == 1 and [r[0] for r in cursor.fetchmany(1)] == [2] and [r[0] for r in cursor.fetchall()] == [3] and cursor.fetchone() is None
        cursor.close()
        with pytest.raises(errors.InterfaceError):
            cursor.execute("SELECT id FROM Sheet1")
        with pytest.raises(errors.ProgrammingError):
            c.execute("SELECT 1 / 0 FROM Sheet1")
    with pytest.raises(errors.InterfaceError):
        c.cursor()


def test_transactions(book, spark):
    with dbapi.connect(book, autocommit=False, spark=spark) as c:
        c.execute("DELETE FROM Sheet1 WHERE id = 1")
        with pytest.raises(errors.OperationalError):
            dbapi.connect(book, spark=spark).execute("DELETE FROM Two") if _steal(book) else None
        c.rollback()
        assert c.execute("SELECT COUNT(*) FROM Sheet1").fetchone() == (3,)
        c.execute("UPDATE Sheet1 SET name = 'x' WHERE id = 2")
    assert read_workbook(book)[0].rows == ROWS
    with dbapi.connect(book, autocommit=False, spark=spark) as c:
        c.executemany("INSERT INTO Two VALUES (?)", [("a",), ("b",)])
        c.commit()
    assert [r[0] for r in read_workbook(book)[1].rows] == ["v", "a", "b"]
    assert not os.path.exists(book + ".lock")


def _steal(book):
    """Makes the lock another live process's."""
    with open(book + ".lock", "w", encoding="utf-8") as f:
        f.write("1")
    return True


def test_executemany_is_all_or_nothing(book, spark):
    with dbapi.connect(book, spark=spark) as c:
        with pytest.raises(errors.ProgrammingError):
            c.executemany("INSERT INTO Two VALUES (?)", [("a",), ("b", "c")])
        assert c.execute("SELECT COUNT(*) FROM Two").fetchone() == (1,)
        with pytest.raises(errors.NotSupportedError):
            c.rollback()


def test_backup_guards_and_options(book, spark, tmp_path):
    with dbapi.connect(book, spark=spark, backup=True, backup_dir=str(tmp_path / "old")) as c:
        c.execute("INSERT INTO Two VALUES ('n')")
    assert len(os.listdir(tmp_path / "old")) == 1
    with pytest.raises(errors.OperationalError):
        dbapi.connect(book, spark=spark, max_rows=2)
    with pytest.raises(errors.OperationalError):
        dbapi.connect(book, spark=spark, max_memory_mb=0.0001)
    with pytest.warns(UserWarning):
        dbapi.connect(book, spark=spark, warn_rows=2)
    for bad in ({"nope": 1}, {"engine": "nope"}, {"max_rows": 0}):
        with pytest.raises(errors.InterfaceError):
            dbapi.connect(book, spark=spark, **bad)
    with pytest.raises(errors.OperationalError):
        dbapi.connect(str(tmp_path / "none.xlsx"), spark=spark)
    with pytest.raises(errors.NotSupportedError):
        dbapi.connect("https://host/book.xlsx", spark=spark)


def test_empty_workbook(spark, tmp_path):
    path = str(tmp_path / "new.xlsx")
    with dbapi.connect(path, create=True, spark=spark) as c:
        cursor = c.execute("SELECT * FROM Sheet")
        assert cursor.description == [] and cursor.fetchall() == []
        with pytest.raises(errors.ProgrammingError):
            c.execute("SELECT a FROM Sheet")
        c.execute('CREATE TABLE t (id INTEGER, "Full Name" TEXT)')
        c.execute('INSERT INTO t VALUES (1, "quoted")')
        c.execute("DROP TABLE Sheet")
    with dbapi.connect(path, spark=spark) as c:
        assert c.execute('SELECT "Full Name" FROM T').fetchall() == [("quoted",)]
        assert [x["type_name"] for x in reflection.read_table_metadata(c, "t")] == ["INTEGER", "TEXT"]


def test_parquet_folder(spark):
    with dbapi.connect("/root/testdata/sf0.001", spark=spark) as c:
        assert c.engine_name == "parquet" and reflection.has_table(c, "NATION")
        assert c.execute("SELECT COUNT(*) FROM nation").fetchone() == (25,)
        with pytest.raises(errors.NotSupportedError):
            c.execute("DELETE FROM nation")


def test_reflection(book, spark):
    with dbapi.connect(book, spark=spark) as c:
        assert reflection.list_tables(c) == ["Sheet1", "Two"]
        found = {x["name"]: (x["type_name"], x["nullable"]) for x in reflection.get_columns(c, "sheet1")}
        assert found == {"id": ("INTEGER", False), "name": ("TEXT", True), "x": ("FLOAT", True), "ok": ("BOOLEAN", True), "at": ("DATETIME", True)}
        reflection.write_table_metadata(c, "Two", [{"name": "k", "type_name": "TEXT", "primary_key": True}])
        assert reflection.read_table_metadata(c, "two")[0]["primary_key"] is True
        assert reflection.list_tables(c) == ["Sheet1", "Two"] and len(reflection.list_tables(c, include_meta=True)) == 3
        reflection.remove_table_metadata(c, "Two")
        assert reflection.read_table_metadata(c, "Two") is None


def test_cli(book, spark, capsys):
    assert cli.main(["tables", book]) == 0 and cli.main(["schema", book, "Two"]) == 0 and cli.main(["inspect", book]) == 0
    assert cli.main(["query", book, "SELECT id FROM Sheet1 WHERE id = 2"]) == 0
    assert "Sheet1: 3 rows" in capsys.readouterr().out
    assert cli.main(["query", book, "DELETE FROM Two"]) == 1
    assert cli.main(["query", book, "DELETE FROM Two", "--write"]) == 0
    assert read_workbook(book)[1].rows == []


def test_data_source(book, spark, tmp_path):
    datasource.register(spark)
    df = spark.read.format("xlsx").option("sheet", "sheet1").load(book)
    assert [(r.id, r.name) for r in df.orderBy("id").collect()] == [(1, "Ann"), (2, "B & <b>"), (3, None)]
    datasource.save(df.select("id"), str(tmp_path / "out.xlsx"), "Out")
    assert sorted(read_workbook(str(tmp_path / "out.xlsx"))[0].rows) == [[1], [2], [3]]


def test_larger_results_are_read_as_they_are_fetched(book, spark, monkeypatch):
    with dbapi.connect(book, spark=spark) as c:
        sql = "SELECT * FROM Two UNION ALL SELECT * FROM Two UNION ALL SELECT * FROM Two"
        want = c.execute(sql).fetchall()
        monkeypatch.setattr(dbapi, "HELD_ROWS", 1)
        cursor = c.execute(sql)
        assert cursor.rowcount == len(want) > 2
        assert [cursor.fetchone(), *cursor.fetchmany(1), *cursor.fetchall()] == want and cursor.fetchone() is None and cursor.fetchall() == []
