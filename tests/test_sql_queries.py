import datetime as dt
import itertools

import pytest

from gridlark.errors import Error, mapped
from tests.helpers import catalog, labels, rows


@pytest.fixture(scope="module")
def c(spark):
    return catalog(
        spark,
        people=(["id", "name", "score", "born"], [[1, "Ann", 5, dt.date(2024, 1, 15)], [2, "bob", None, dt.date(2024, 2, 1)], [3, "Straße", 9, None], [4, None, 5, dt.date(2023, 5, 5)]]),
        teams=(["person_id", "team", "Full Name"], [["1", "red", "x y"], ["3", "blue", "z"], ["9", "red", "w"]]),
        mixed=(["v"], [[10], ["hello"], [5], [None], ["9"], [dt.datetime(2024, 1, 2)]]),
        empty=(["id", "name"], []),
        dup=(["k", "v"], [[1, "a"], [2, "b"], [2, "b"], [None, "c"], [None, "c"]]),
        texts=(["t"], [["a\nb"], ["a%b"], ["a_b"], ["a\\b"], ["　pad "], ["ab\n"]]),
    )


CASES = [
    ("SELECT * FROM people WHERE id = 1", [(1, "Ann", 5, dt.date(2024, 1, 15))]),
    ("SELECT id FROM people ORDER BY score", [(1,), (4,), (3,), (2,)]),
    ("SELECT id FROM people ORDER BY score DESC", [(2,), (3,), (1,), (4,)]),
    ("SELECT id FROM people WHERE score != 5", [(3,)]),
    ("SELECT id FROM people WHERE NOT (score = 5)", [(3,)]),
    ("SELECT id FROM people WHERE score IS NULL OR score == 9", [(2,), (3,)]),
    ("SELECT id FROM people WHERE score IN (5, NULL)", [(1,), (4,)]),
    ("SELECT id FROM people WHERE score NOT IN (9, NULL)", []),
    ("SELECT id FROM people WHERE score NOT BETWEEN 9 AND NULL", []),
    ("SELECT id FROM people WHERE name ILIKE 'STRASSE'", [(3,)]),
    ("SELECT id FROM people WHERE born > '2024-01-20'", [(2,)]),
    ("SELECT id FROM people WHERE born = '01/15/2024'", [(1,)]),
    ("SELECT id FROM people WHERE id > '2'", [(3,), (4,)]),
    ("SELECT id FROM people WHERE name = Ann", [(1,)]),
    ("SELECT v FROM mixed ORDER BY v", [("5",), ("9",), ("10",), ("2024-01-02 00:00:00",), ("hello",), (None,)]),
    ("SELECT MIN(v), MAX(v), COUNT(v), SUM(v) FROM mixed", [("5", "hello", 5, 24.0)]),
    ("SELECT v FROM mixed WHERE v > '8' AND v < '11'", [("10",), ("9",)]),
    ("SELECT COUNT(*), SUM(id), MIN(name) FROM empty", [(0, None, None)]),
    ("SELECT id FROM empty GROUP BY id", []),
    ("SELECT DISTINCT k, v FROM dup ORDER BY k", [(1, "a"), (2, "b"), (None, "c")]),
    ("SELECT k, COUNT(*) FROM dup GROUP BY k ORDER BY COUNT(*) DESC, k", [(2, 2), (None, 2), (1, 1)]),
    ("SELECT COUNT(DISTINCT k) FROM dup", [(2,)]),
    ("SELECT score, COUNT(*) FILTER (WHERE id > 1) FROM people GROUP BY score HAVING COUNT(*) > 1", [(5, 1)]),
    ("SELECT p.id, t.team FROM people p JOIN teams t ON p.id = t.person_id ORDER BY p.id", [(1, "red"), (3, "blue")]),
    ("SELECT p.id, t.team FROM people p LEFT JOIN teams t ON p.id = t.person_id ORDER BY p.id", [(1, "red"), (2, None), (3, "blue"), (4, None)]),
    ("SELECT p.id, t.person_id FROM people p RIGHT JOIN teams t ON p.id = t.person_id ORDER BY t.person_id", [(1, "1"), (3, "3"), (None, "9")]),
    ("SELECT p.id, t.person_id FROM people p FULL JOIN teams t ON p.id = t.person_id ORDER BY p.id, t.person_id", [(1, "1"), (2, None), (3, "3"), (4, None), (None, "9")]),
    ('SELECT t."Full Name" FROM teams t JOIN people p ON t.person_id = p.id ORDER BY t.team', [("z",), ("x y",)]),
    ("SELECT id FROM people WHERE id IN (SELECT person_id FROM teams)", [(1,), (3,)]),
    ("SELECT id FROM people WHERE id NOT IN (SELECT k FROM dup)", []),
    ("SELECT id FROM people WHERE EXISTS (SELECT team FROM teams WHERE teams.person_id = people.id)", [(1,), (3,)]),
    ("SELECT id, (SELECT COUNT(*) FROM teams WHERE teams.person_id = people.id) FROM people WHERE id < 3", [(1, 1), (2, 0)]),
    ("SELECT id FROM people WHERE score = (SELECT MAX(score) FROM people)", [(3,)]),
    ("SELECT (SELECT id FROM empty) FROM people WHERE id = 1", [(None,)]),
    ("SELECT k FROM dup UNION SELECT id FROM people ORDER BY k", [(1,), (2,), (3,), (4,), (None,)]),
    ("SELECT k FROM dup EXCEPT SELECT id FROM people", [(None,)]),
    ("SELECT k FROM dup UNION ALL SELECT id FROM people INTERSECT SELECT id FROM people WHERE id < 2", [(1,)]),
    ("WITH a AS (SELECT id, score FROM people), b AS (SELECT score, COUNT(*) AS n FROM a GROUP BY score) SELECT n FROM b WHERE score = 5", [(2,)]),
    ("SELECT id, ROW_NUMBER() OVER (PARTITION BY score ORDER BY id DESC) AS n FROM people ORDER BY id", [(1, 2), (2, 1), (3, 1), (4, 1)]),
    ("SELECT id, RANK() OVER (ORDER BY score), DENSE_RANK() OVER (ORDER BY score), RANK() OVER () FROM people ORDER BY id", [(1, 1, 1, 1), (2, 4, 3, 1), (3, 3, 2, 1), (4, 1, 1, 1)]),
    ("SELECT id, SUM(score) OVER (ORDER BY score) AS s FROM people ORDER BY id", [(1, 5.0), (2, 19.0), (3, 19.0), (4, 10.0)]),
    ("SELECT id, COUNT(DISTINCT score) OVER () AS n, SUM(score) FILTER (WHERE id > 1) OVER () AS s FROM people WHERE id < 4", [(1, 2, 9.0), (2, 2, 9.0), (3, 2, 9.0)]),
    ("SELECT CASE WHEN ROW_NUMBER() OVER (ORDER BY id) = 1 THEN 'first' ELSE 'later' END FROM people WHERE id < 3", [("first",), ("later",)]),
    ("SELECT CASE score WHEN 5 THEN 'five' WHEN 9 THEN 'nine' END FROM people", [("five",), (None,), ("nine",), ("five",)]),
    ("SELECT t FROM texts WHERE t LIKE 'a%b'", [("a%b",), ("a_b",), ("a\\b",), ("ab\n",)]),
    ("SELECT t FROM texts WHERE t LIKE 'a!%b' ESCAPE '!'", [("a%b",)]),
    ("SELECT t FROM texts WHERE t LIKE 'a\\b'", [("a\\b",)]),
    ("SELECT TRIM(t) FROM texts WHERE LENGTH(t) = 5", [("pad",)]),
    ("SELECT id * 2 + 1, -id, id / 2, id || '!' FROM people WHERE id = 3", [(7.0, -3.0, 1.5, "3!")]),
    ("SELECT ROUND(2.5), ROUND(3.5), ROUND(1.234, 2), ABS('-2.5'), ABS(-2) FROM people WHERE id = 1", [(2, 4, 1.23, 2.5, 2)]),
    ("SELECT SUBSTR('hello', 0, 2), SUBSTR('hello', -3), SUBSTR('hello', 2, -1), SUBSTRING('hello', 2) FROM people WHERE id = 1", [("he", "llo", "", "ello")]),
    ("SELECT CONCAT('a', NULL, 1), REPLACE('aXb', 'X', NULL), REPLACE('a', NULL, 'b'), COALESCE(NULL, 2), NULLIF(1, 1) FROM people WHERE id = 1", [("a1", "ab", "a", 2, None)]),
    ("SELECT CAST('3.7' AS INTEGER), CAST(-3.7 AS INT), CAST('yes' AS BOOLEAN), CAST('2024-01-15T10:00:00Z' AS DATE), CAST(born AS TEXT) FROM people WHERE id = 1", [(3, -3, True, dt.date(2024, 1, 15), "2024-01-15")]),
    ("SELECT YEAR('2024-01-15T23:00:00+02:00'), MONTH(born), DAY(born) FROM people WHERE id = 1", [(2024, 1, 15)]),
    ("SELECT id FROM people ORDER BY 1 LIMIT 2 OFFSET 1", [(2,), (3,)]),
    ("SELECT id AS x FROM people ORDER BY x DESC LIMIT 1", [(4,)]),
    ("SELECT ID FROM PEOPLE WHERE Id = 2", [(2,)]),
]


@pytest.mark.parametrize(("sql", "want"), CASES, ids=range(len(CASES)))
def test_rows(c, sql, want):
    assert rows(c, sql) == want


REFUSED = [
    "SELECT nope FROM people", "SELECT id FROM nowhere", "SELECT name, COUNT(*) FROM people", "SELECT id FROM people WHERE nope = 1", "SELECT DISTINCT id FROM people ORDER BY name",
    "SELECT id FROM people p JOIN teams t ON p.id = t.person_id", "SELECT p.id FROM people p JOIN people p ON p.id = p.id", "SELECT p.id FROM people p JOIN teams t ON p.id = p.score",
    "SELECT p.id FROM people p JOIN teams t ON id = person_id", "SELECT id FROM people UNION SELECT id, name FROM people", "SELECT id, score FROM people GROUP BY id", "SELECT id FROM people GROUP BY id HAVING score > 1",
    "SELECT id FROM people GROUP BY id ORDER BY score", "SELECT born + 1 FROM people", "SELECT CAST(born AS INTEGER) FROM people", "SELECT YEAR(id) FROM people", "SELECT k FROM dup UNION SELECT id FROM people ORDER BY nope",
    "SELECT people.id FROM people JOIN people b ON people.id = b.id", "SELECT teams.id FROM people teams JOIN teams t ON teams.id = t.person_id",
    "SELECT people.id FROM people p JOIN teams people ON p.id = people.person_id", "SELECT id FROM people WHERE id LIKE 1",
    "SELECT 'x' + 1 FROM people",
]


@pytest.mark.parametrize("sql", REFUSED)
def test_refused_by_meaning(c, sql):
    with pytest.raises(Error):
        rows(c, sql)


@pytest.mark.parametrize("sql", ["SELECT 1 / 0 FROM people", "SELECT CAST(name AS INTEGER) FROM people WHERE id = 1", "SELECT (SELECT id FROM people) FROM people", "SELECT CAST('y' AS BOOLEAN) FROM people", "SELECT name + 1 FROM people"])
def test_errors_when_run(c, sql):
    with pytest.raises(Exception) as e:  # noqa: PT011  Spark's own, before the DB-API layer maps it
        rows(c, sql)
    assert isinstance(mapped(e.value), Error)


def test_labels(c):
    assert labels(c, "SELECT p.id, COUNT(*), SUM(p.id) AS s FROM people p JOIN teams t ON p.id = t.person_id GROUP BY p.id") == ["p.id", "COUNT(*)", "s"]
    assert labels(c, "SELECT * FROM people p JOIN teams t ON p.id = t.person_id")[:2] == ["p.id", "p.name"]


def test_parameters(c):
    assert rows(c, "SELECT id, ? FROM people WHERE score = ? AND born < ? ORDER BY id LIMIT ?", "x", 5, dt.date(2024, 1, 1), 1) == [(4, "x")]
    with pytest.raises(Error):
        rows(c, "SELECT id FROM people WHERE id = ?")
    assert rows(c, "SELECT id FROM people WHERE name = ?", "name") == []


def test_filters_reach_the_scan(spark):
    from gridlark.plans.driver_queries import engine

    sql = "SELECT l_orderkey FROM lineitem WHERE l_quantity > 40 AND l_shipdate <= '1998-09-02' AND l_returnflag IN ('R', 'A')"
    plan = engine(spark, "/root/testdata/sf0.001", sql).sql(sql)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,40.0)" in plan and "LessThanOrEqual(l_shipdate" in plan and "In(l_returnflag" in plan
    assert "l_extendedprice" not in plan


def test_joins_on_text_and_number_stay_hashable(c):
    from gridlark.plans.session import execute

    df = execute(c, "SELECT p.id FROM people p JOIN teams t ON p.id = t.person_id").result.df
    assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()


def test_patterns_of_rows(spark):
    texts = ["abc", "a%c", "a_c", "a.c", "x\ny", "50%", "ÄB", "äb", "", None, "a\\c", "(a"]
    patterns = ["abc", "a%c", "a_c", "%", "x%y", "50!%", "ä_", "", None, "a.c", "a\\_", "(%", "!_%"]
    c = catalog(spark, t=(["i", "s", "p"], [[i, s, p] for i, (s, p) in enumerate(itertools.product(texts, patterns))]))
    for negated, ending in itertools.product(("", "NOT "), ("", " ESCAPE '!'")):
        for kind in ("LIKE", "ILIKE"):
            got = {i for (i,) in rows(c, f"SELECT i FROM t WHERE s {negated}{kind} p{ending}")}
            for p in patterns:
                literal = {i for (i,) in rows(c, f"SELECT i FROM t WHERE s {negated}{kind} ?{ending} AND p = ?", p, p)} if p is not None else set()
                own = {i for i, (_, q) in enumerate(itertools.product(texts, patterns)) if q == p}
                assert got & own == literal & own, (kind, p, ending)
    with pytest.raises(Exception, match="escape character"):
        rows(c, "SELECT i FROM t WHERE s LIKE p || '!' ESCAPE '!'")
    assert rows(c, "SELECT DISTINCT s FROM t WHERE s LIKE '%' || SUBSTR(s, 2) AND LENGTH(s) = 4") == []


def test_not_in_with_nulls(spark):
    c = catalog(spark, t=(["x"], [[1], [2], [None]]), some=(["k"], [[2], [5]]), nulls=(["k"], [[2], [None]]), none=(["k", "g"], []), texts=(["k"], [["2"], ["x"]]))
    for table, want in (("some", [1]), ("nulls", []), ("none", [1, 2, None]), ("texts", [1])):
        assert [x for (x,) in rows(c, f"SELECT x FROM t WHERE x NOT IN (SELECT k FROM {table})")] == want, table
        assert [x for (x,) in rows(c, f"SELECT x FROM t WHERE NOT (x NOT IN (SELECT k FROM {table}) OR x = 1)")] == ([2] if table != "none" else []), table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_not_in_is_not_broadcast_whatever_its_size(spark):
    from gridlark.plans.driver_queries import engine

    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sql = "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)"
        text = plan(engine(spark, "/root/testdata/sf0.001", sql).sql(sql))
        assert "Broadcast" not in text and "NestedLoop" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_distinct_counts_over_windows_hold_no_sets(spark):
    c = catalog(spark, t=(["g", "o", "x"], [[g, o, x] for g, o, x in [(1, 1, "a"), (1, 1, "b"), (1, 2, "a"), (1, 3, None), (1, 4, "c"), (2, 1, None), (2, 2, "a"), (None, 1, "a")]]))
    assert rows(c, "SELECT COUNT(DISTINCT x) OVER (PARTITION BY g ORDER BY o) AS n, COUNT(DISTINCT x) OVER (PARTITION BY g) AS m, COUNT(DISTINCT x) FILTER (WHERE o > 1) OVER (PARTITION BY g) AS f FROM t") == [
        (1, 3, 2), (2, 3, 2), (2, 3, 2), (2, 3, 2), (3, 3, 2), (0, 1, 1), (1, 1, 1), (1, 1, 0),
    ]
    from gridlark.plans.driver_queries import engine

    sql = "SELECT o_orderkey, COUNT(DISTINCT o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders"
    assert "collect_set" not in plan(engine(spark, "/root/testdata/sf0.001", sql).sql(sql))


def test_changed_tables_are_read_by_column_and_filter(spark):
    from gridlark.plans.driver_queries import engine

    own = engine(spark, "/root/testdata/sf0.001", "customer")
    own.sql("UPDATE customer SET c_acctbal = 0 WHERE c_custkey < 10")
    text = plan(own.sql("SELECT c_name FROM customer WHERE c_custkey > 100"))
    assert "FileScan parquet" in text and "GreaterThan(c_custkey,100)" in text and "c_acctbal" not in text
