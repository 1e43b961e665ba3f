import os

import duckdb
import pytest

from gridlark.plans import driver_queries as d

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = d.queries(), d.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.sql(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{t}'")
    return con


def plain(x):
    return round(x, 6) if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_the_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    order = sorted(df.columns)
    got = sorted(([plain(r[c]) for c in order] for r in df.collect()), key=repr)
    want = duck.sql(ORACLE[name])
    columns = want.columns
    assert sorted(columns) == order
    at = [columns.index(c) for c in order]
    assert got == sorted(([plain(r[i]) for i in at] for r in want.fetchall()), key=repr)


@pytest.mark.parametrize(("name", "table"), [("arithmetic", "lineitem"), ("order_multi", "customer"), ("order_nulls", "nation"), ("order_expression", "orders")])
def test_whole_tables(spark, duck, name, table):
    got = [tuple(r) for r in QUERIES[name](spark, SF).collect()]
    assert len(got) == duck.sql(f"SELECT count(*) FROM {table}").fetchall()[0][0]
    if name != "arithmetic":  # in the order of the oracle, too
        assert got == duck.sql(ORACLE[name]).fetchall()


def test_rows_to_compare(duck):
    """Few queries are about having no rows."""
    empty = {n for n in QUERIES if not duck.sql(f"SELECT count(*) FROM ({ORACLE[n]})").fetchall()[0][0]}
    assert empty <= {"not_in_list_null", "not_in_subquery_null", "not_in_subquery"}  # the last has rows in larger tables


def test_flagship(spark):
    assert d.flagship(spark, SF).count() == 6
