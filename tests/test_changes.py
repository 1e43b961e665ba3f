import datetime as dt

import pytest

from gridlark.errors import Error
from gridlark.plans.session import execute
from tests.helpers import catalog, rows


@pytest.fixture
def c(spark):
    return catalog(spark, items=(["id", "name", "n"], [[1, "a", 10], [2, "b", 20], [2, "b2", 21], [None, "z", 0]]), other=(["id", "name"], [[7, "seven"], [1, "one"]]))


def change(c, sql, *params):
    out = execute(c, sql, params)
    return out.rowcount, out.lastrowid


ALL = "SELECT id, name, n FROM items"


def test_insert(c):
    assert change(c, "INSERT INTO items (id, name) VALUES (3, 'c'), (?, bare)", 4) == (2, 7)
    assert rows(c, ALL)[-2:] == [(3, "c", None), (4, "bare", None)]
    assert change(c, "INSERT INTO items (id, name) SELECT id, name FROM other WHERE id > ?", 5) == (1, 8)
    assert rows(c, ALL)[-1] == (7, "seven", None)
    assert change(c, "INSERT INTO items (id) SELECT id FROM other WHERE id > 99") == (0, None)


@pytest.mark.parametrize("sql", ["INSERT INTO items VALUES (1)", "INSERT INTO items (id, id) VALUES (1, 2)", "INSERT INTO items (nope) VALUES (1)", "INSERT INTO nowhere VALUES (1)", "INSERT INTO items (id) SELECT id, name FROM other"])
def test_insert_refused(c, sql):
    before = rows(c, ALL)
    with pytest.raises(Error):
        change(c, sql)
    assert rows(c, ALL) == before


def test_formulas_are_defused(c):
    change(c, "INSERT INTO items (id, name) VALUES (5, '=1+1')")
    change(c, "UPDATE items SET name = '@x' WHERE id = 1")
    assert [r[1] for r in rows(c, ALL) if r[0] in (1, 5)] == ["'@x", "'=1+1"]


def test_widening(c):
    change(c, "INSERT INTO items VALUES (9, 'i', 'many')")
    assert rows(c, "SELECT n FROM items") == [("10",), ("20",), ("21",), ("0",), ("many",)]
    assert rows(c, "SELECT SUM(n) FROM items") == [(51.0,)]


def test_upsert_nothing(c):
    sql = "INSERT INTO items VALUES (1, 'x', 1), (8, 'p', 1), (8, 'q', 2), (NULL, 'r', 3) ON CONFLICT (id) DO NOTHING"
    assert change(c, sql)[0] == 2
    assert rows(c, ALL)[4:] == [(8, "p", 1), (None, "r", 3)]


def test_upsert_update_takes_rows_in_turn(c):
    sql = "INSERT INTO items VALUES (2, 'x', 1), (8, 'p', 1), (8, 'q', 2), (2, 'y', 5) ON CONFLICT (id) DO UPDATE SET name = name || excluded.name, n = n + excluded.n"
    assert change(c, sql)[0] == 4
    assert rows(c, ALL) == [(1, "a", 10.0), (2, "bxy", 26.0), (2, "b2", 21.0), (None, "z", 0.0), (8, "pq", 3.0)]


def test_upsert_from_select_and_composite_keys(c):
    assert change(c, "INSERT INTO items (id, name) SELECT id, name FROM other ON CONFLICT (id, name) DO UPDATE SET n = 99")[0] == 2
    assert (1, "one", None) in rows(c, ALL) and (1, "a", 10) in rows(c, ALL)
    assert change(c, "INSERT INTO items (id, name) VALUES (1, 'one') ON CONFLICT (id, name) DO UPDATE SET name = fresh, n = 5") == (1, None)
    assert (1, "fresh", 5) in rows(c, ALL)


def test_update(c):
    assert change(c, "UPDATE items SET n = n + ?, name = CASE WHEN id = 1 THEN 'first' ELSE name END WHERE id >= 1", 1) == (3, None)
    assert rows(c, ALL) == [(1, "first", 11.0), (2, "b", 21.0), (2, "b2", 22.0), (None, "z", 0.0)]
    assert change(c, "UPDATE items SET id = n, n = id WHERE name = 'b'")[0] == 1
    assert rows(c, "SELECT id, n FROM items WHERE name = 'b'") == [(21.0, 2.0)]
    assert change(c, "UPDATE items SET name = plain WHERE id IN (SELECT id FROM other)")[0] == 1


def test_delete(c):
    assert change(c, "DELETE FROM items WHERE id > 1") == (2, None)
    assert rows(c, ALL) == [(1, "a", 10), (None, "z", 0)]
    assert change(c, "DELETE FROM items")[0] == 2
    assert rows(c, ALL) == []


def test_ddl(c):
    change(c, "CREATE TABLE made (a INTEGER, b TEXT, d DATE)")
    change(c, "INSERT INTO made (a, b) VALUES (1, 'x')")
    change(c, "ALTER TABLE made ADD COLUMN e REAL")
    change(c, "ALTER TABLE made RENAME COLUMN b TO bb")
    change(c, "ALTER TABLE made DROP COLUMN a")
    assert rows(c, "SELECT * FROM made") == [("x", None, None)]
    assert [(m["name"], m["type_name"]) for m in c.declared("made")] == [("bb", "TEXT"), ("d", "DATE"), ("e", "REAL")]
    change(c, "DROP TABLE made")
    assert c.find("made") is None and c.declared("made") is None


@pytest.mark.parametrize(
    "sql",
    ["CREATE TABLE ITEMS (a)", "CREATE TABLE x (a, A)", "CREATE TABLE __excel_meta__ (a)", "DROP TABLE nowhere", "ALTER TABLE items ADD COLUMN NAME TEXT", "ALTER TABLE items DROP COLUMN nope", "ALTER TABLE items RENAME COLUMN id TO name"],
)
def test_ddl_refused(c, sql):
    with pytest.raises(Error):
        change(c, sql)


def test_last_table_and_last_column_stay(spark):
    c = catalog(spark, only=(["a"], [[dt.date(2024, 1, 1)]]))
    for sql in ("DROP TABLE only", "ALTER TABLE only DROP COLUMN a"):
        with pytest.raises(Error):
            change(c, sql)
