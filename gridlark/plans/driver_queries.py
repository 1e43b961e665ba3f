"""Queries over the driver's tables, one or more for each operator of the dialect, with SQL that another engine runs.

Each entry is the dialect's text and the reference SQL. The tables hold no nulls, so queries about nulls make their own.
"""

from __future__ import annotations

import datetime as dt
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridlark.plans.session import Engine
from gridlark.sources import datasource
from gridlark.sources.catalog import relation_of
from gridlark.sources.xlsx import read_workbook

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def engine(spark: SparkSession, sf_dir: str, sql: str) -> Engine:
    """With the tables that the text names."""
    folded = sql.casefold()
    return Engine(spark, {t: f"{sf_dir}/{t}.parquet" for t in TABLES if t in folded})


#: name: (text of the dialect, reference SQL or None where the text itself means the same)
SELECTS: dict[str, tuple[str, str | None]] = {
    "scan_project": ("SELECT n_nationkey, n_name FROM nation", None),
    "select_star": ("SELECT * FROM region", None),
    "where_cmp": (
        "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 45 AND l_discount < 0.05 AND l_returnflag <> 'N'",
        None,
    ),
    "where_date_text": (
        "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate > '1998-06-01' AND l_shipdate <= '1998/09/02'",
        "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate > TIMESTAMP '1998-06-01' AND l_shipdate <= TIMESTAMP '1998-09-02'",
    ),
    "where_3vl": (
        "WITH t AS (SELECT o_orderkey, NULLIF(o_orderstatus, 'F') AS st FROM orders) SELECT o_orderkey FROM t WHERE NOT (st = 'O') OR st IS NULL",
        None,
    ),
    "in_list": ("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')", None),
    "not_in_list": ("SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (1, 2, 3, 4)", None),
    "not_in_list_null": ("SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (1, NULL)", None),
    "between": ("SELECT p_partkey FROM part WHERE p_size BETWEEN 10 AND 20", None),
    "not_between": (
        "WITH t AS (SELECT p_partkey, p_size, NULLIF(p_size, 7) AS hi FROM part) SELECT p_partkey FROM t WHERE p_size NOT BETWEEN 3 AND hi",
        "SELECT p_partkey FROM part WHERE NULLIF(p_size, 7) IS NOT NULL AND NOT (p_size >= 3 AND p_size <= p_size)",
    ),
    "like": ("SELECT p_partkey, p_name FROM part WHERE p_type LIKE 'S%' AND p_name LIKE '% gi_mo'", None),
    "like_escape": ("SELECT n_name FROM nation WHERE n_name LIKE 'NATION!_1%' ESCAPE '!'", None),
    "not_like": ("SELECT c_custkey FROM customer WHERE c_name NOT LIKE '%9%'", None),
    "ilike": ("SELECT r_regionkey, r_name FROM region WHERE r_name ILIKE '%as%' OR r_name NOT ILIKE '%a%'", None),
    "like_column": (
        "WITH t AS (SELECT c_custkey, c_name, '%' || SUBSTR(c_name, -2) || '_' AS p, '%!%' || SUBSTR(c_name, -1) AS q, c_name || '%' AS r FROM customer)"
        " SELECT c_custkey, CASE WHEN c_name || '0' LIKE p THEN 1 ELSE 0 END AS a, CASE WHEN c_name LIKE p THEN 1 ELSE 0 END AS b, CASE WHEN '%' || SUBSTR(c_name, -1) LIKE q ESCAPE '!' THEN 1 ELSE 0 END AS c"
        " FROM t WHERE c_name LIKE r AND c_name NOT ILIKE p",
        "SELECT c_custkey, CAST((c_name || '0' LIKE p) AS BIGINT) AS a, CAST((c_name LIKE p) AS BIGINT) AS b, CAST(('%' || right(c_name, 1) LIKE q ESCAPE '!') AS BIGINT) AS c"
        " FROM (SELECT c_custkey, c_name, '%' || right(c_name, 2) || '_' AS p, '%!%' || right(c_name, 1) AS q, c_name || '%' AS r FROM customer) WHERE c_name LIKE r AND NOT c_name ILIKE p",
    ),
    "not_like_column": (
        "SELECT a.n_name AS x, b.n_name AS y FROM nation a CROSS JOIN nation b WHERE a.n_name LIKE b.n_name || '_' AND a.n_name NOT LIKE '%' || b.n_nationkey",
        "SELECT a.n_name AS x, b.n_name AS y FROM nation a CROSS JOIN nation b WHERE a.n_name LIKE b.n_name || '_' AND a.n_name NOT LIKE '%' || CAST(b.n_nationkey AS VARCHAR)",
    ),
    "equals_twice": ("SELECT n_nationkey FROM nation WHERE n_regionkey == 2", "SELECT n_nationkey FROM nation WHERE n_regionkey = 2"),
    "distinct_aggregate": ("SELECT DISTINCT COUNT(*) AS n FROM orders GROUP BY o_custkey", None),
    "setop_parenthesised": (
        "SELECT n_regionkey AS k FROM nation UNION ALL (SELECT r_regionkey FROM region WHERE r_regionkey > 2)",
        "SELECT n_regionkey AS k FROM nation UNION ALL (SELECT r_regionkey FROM region WHERE r_regionkey > 2)",
    ),
    "order_literal": ("SELECT r_regionkey FROM region ORDER BY 1", None),
    "win_partition_expression": (
        "SELECT o_orderkey, COUNT(*) OVER (PARTITION BY YEAR(o_orderdate), o_orderstatus) AS n FROM orders",
        "SELECT o_orderkey, count(*) OVER (PARTITION BY year(o_orderdate), o_orderstatus) AS n FROM orders",
    ),
    "win_count_distinct_running": (
        "SELECT o_orderkey, COUNT(DISTINCT o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, COUNT(DISTINCT o_orderstatus) FILTER (WHERE o_totalprice > 200000) OVER (PARTITION BY o_custkey) AS m FROM orders",
        "SELECT o_orderkey, len(list_distinct(list(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderkey))) AS n,"
        " coalesce(len(list_distinct(list(o_orderstatus) FILTER (WHERE o_totalprice > 200000) OVER (PARTITION BY o_custkey))), 0) AS m FROM orders",
    ),
    "win_case_order": (
        "SELECT n_nationkey, CASE WHEN RANK() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey DESC) = 1 THEN 'last' ELSE n_name END AS x, ROW_NUMBER() OVER (ORDER BY n_name) AS rn FROM nation ORDER BY rn DESC",
        "SELECT n_nationkey, CASE WHEN rank() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey DESC) = 1 THEN 'last' ELSE n_name END AS x, row_number() OVER (ORDER BY n_name) AS rn FROM nation",
    ),
    "not_in_subquery_empty": ("SELECT n_nationkey FROM nation WHERE NULLIF(n_regionkey, 1) NOT IN (SELECT r_regionkey FROM region WHERE r_regionkey > 90)", None),
    "not_in_subquery_or": (
        "SELECT c_custkey FROM customer WHERE c_acctbal < 0 OR NOT (c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000))",
        None,
    ),
    "is_null": (
        "WITH t AS (SELECT n_nationkey, NULLIF(n_regionkey, 2) AS k FROM nation) SELECT n_nationkey FROM t WHERE k IS NULL",
        None,
    ),
    "is_not_null": (
        "WITH t AS (SELECT n_nationkey, NULLIF(n_regionkey, 2) AS k FROM nation) SELECT n_nationkey, k FROM t WHERE k IS NOT NULL",
        None,
    ),
    "not_parens": ("SELECT o_orderkey FROM orders WHERE NOT (o_orderstatus = 'O' AND (o_totalprice > 50000 OR o_custkey < 50))", None),
    "arithmetic": ("SELECT l_orderkey, l_linenumber, l_quantity * 2 + 1 - l_tax / 4 AS a, -l_quantity AS b FROM lineitem", None),
    "concat_op": ("SELECT n_name || '/' || n_nationkey AS tag FROM nation", None),
    "case_searched": (
        "SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_class FROM part",
        None,
    ),
    "case_simple": ("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 END AS st FROM orders", "SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 END AS BIGINT) AS st FROM orders"),
    "cast_int": ("SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS INTEGER) AS v FROM lineitem", "SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice) AS BIGINT) AS v FROM lineitem"),
    "cast_real": ("SELECT n_nationkey, CAST(n_regionkey AS REAL) AS v FROM nation", "SELECT n_nationkey, CAST(n_regionkey AS DOUBLE) AS v FROM nation"),
    "cast_text": ("SELECT n_nationkey, CAST(n_regionkey AS TEXT) AS v FROM nation", None),
    "cast_date": ("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TEXT) AS d FROM orders", None),
    "cast_datetime": ("SELECT n_nationkey, CAST('2024-01-15T10:30:00Z' AS DATETIME) AS d FROM nation", "SELECT n_nationkey, TIMESTAMP '2024-01-15 10:30:00' AS d FROM nation"),
    "cast_boolean": ("SELECT n_nationkey, CAST(CASE WHEN n_regionkey = 1 THEN 'yes' ELSE '0' END AS BOOLEAN) AS b FROM nation", "SELECT n_nationkey, n_regionkey = 1 AS b FROM nation"),
    "fn_coalesce": ("SELECT n_nationkey, COALESCE(NULLIF(n_regionkey, 1), -1) AS v FROM nation", "SELECT n_nationkey, CAST(coalesce(nullif(n_regionkey, 1), -1) AS BIGINT) AS v FROM nation"),
    "fn_nullif": ("SELECT n_nationkey, NULLIF(n_name, 'NATION_3') AS v FROM nation", None),
    "fn_upper_lower": ("SELECT r_regionkey, UPPER(LOWER(r_name)) AS u, LOWER(r_name) AS l FROM region", None),
    "fn_trim": ("SELECT r_regionkey, TRIM('  ' || r_name || '  ') AS v FROM region", None),
    "fn_length": ("SELECT c_custkey, LENGTH(c_name) AS v FROM customer", None),
    "fn_substr": ("SELECT c_custkey, SUBSTR(c_name, 3, 4) AS a, SUBSTRING(c_name, -3) AS b FROM customer", None),
    "fn_abs": ("SELECT c_custkey, ABS(c_acctbal) AS v FROM customer", None),
    "fn_round": ("SELECT p_partkey, ROUND(p_size / 2) AS v FROM part", "SELECT p_partkey, CAST(round_even(p_size / 2, 0) AS BIGINT) AS v FROM part"),
    "fn_replace": ("SELECT n_nationkey, REPLACE(n_name, 'NATION', 'N') AS v FROM nation", None),
    "fn_concat": ("SELECT n_nationkey, CONCAT(n_name, NULL, '-', n_regionkey) AS v FROM nation", None),
    "fn_year_month_day": (
        "SELECT o_orderkey, YEAR(o_orderdate) AS y, MONTH(o_orderdate) AS m, DAY(o_orderdate) AS d FROM orders",
        None,
    ),
    "distinct": ("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem ORDER BY l_returnflag, l_linestatus", None),
    "order_multi": ("SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment DESC, c_acctbal, c_custkey", None),
    "order_nulls": (
        "WITH t AS (SELECT n_nationkey, NULLIF(n_regionkey, 2) AS k FROM nation) SELECT n_nationkey, k FROM t ORDER BY k DESC, n_nationkey",
        "SELECT n_nationkey, nullif(n_regionkey, 2) AS k FROM nation ORDER BY k DESC NULLS FIRST, n_nationkey",
    ),
    "order_expression": ("SELECT o_orderkey FROM orders ORDER BY o_totalprice * -1, o_orderkey", None),
    "limit_offset": ("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 5", None),
    "count_star": ("SELECT COUNT(*) AS n FROM lineitem", None),
    "count_column": ("WITH t AS (SELECT NULLIF(l_returnflag, 'R') AS f FROM lineitem) SELECT COUNT(f) AS n FROM t", None),
    "count_distinct": ("SELECT COUNT(DISTINCT l_suppkey) AS n, COUNT(DISTINCT l_returnflag) AS m FROM lineitem", None),
    "sum_avg_min_max": (
        "SELECT l_returnflag, SUM(l_quantity) AS s, MIN(l_shipdate) AS lo, MAX(l_extendedprice) AS hi, AVG(l_linenumber) AS a FROM lineitem GROUP BY l_returnflag",
        None,
    ),
    "agg_filter": (
        "SELECT l_returnflag, COUNT(*) FILTER (WHERE l_quantity > 25) AS big, SUM(l_linenumber) FILTER (WHERE l_linestatus = 'O') AS s FROM lineitem GROUP BY l_returnflag",
        "SELECT l_returnflag, count(*) FILTER (WHERE l_quantity > 25) AS big, CAST(sum(l_linenumber) FILTER (WHERE l_linestatus = 'O') AS DOUBLE) AS s FROM lineitem GROUP BY l_returnflag",
    ),
    "group_expr": ("SELECT YEAR(o_orderdate) AS y, COUNT(*) AS n FROM orders GROUP BY YEAR(o_orderdate)", "SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1"),
    "having": ("SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey HAVING COUNT(*) > 12 AND SUM(o_totalprice) > 0", None),
    "order_aggregate": ("SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY COUNT(*) DESC, o_custkey LIMIT 15", None),
    "join_inner": ("SELECT n.n_name AS n_name, r.r_name AS r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey", None),
    "join_left": (
        "SELECT c.c_custkey AS c_custkey, o.o_orderkey AS o_orderkey FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey WHERE c.c_nationkey = 5",
        None,
    ),
    "join_right": ("WITH s AS (SELECT s_nationkey AS k, s_suppkey AS v FROM supplier) SELECT s.v AS v, n.n_name AS n_name FROM s RIGHT JOIN nation n ON s.k = n.n_nationkey", None),
    "join_full": (
        "WITH a AS (SELECT n_nationkey AS k FROM nation WHERE n_nationkey < 15), b AS (SELECT n_nationkey AS k FROM nation WHERE n_nationkey > 10)"
        " SELECT a.k AS ak, b.k AS bk FROM a FULL OUTER JOIN b ON a.k = b.k",
        None,
    ),
    "join_cross": ("SELECT r.r_name AS r_name, n.n_name AS n_name FROM region r CROSS JOIN nation n", None),
    "join_chained": (
        "SELECT s.s_suppkey AS s_suppkey, n.n_name AS n_name, r.r_name AS r_name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey",
        None,
    ),
    "join_self": (
        "SELECT a.n_name AS x, b.n_name AS y FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey",
        None,
    ),
    "join_theta": ("SELECT a.r_name AS x, b.r_name AS y FROM region a JOIN region b ON a.r_regionkey > b.r_regionkey OR a.r_name = b.r_name", None),
    "join_group": (
        "SELECT n.n_name AS n_name, COUNT(*) AS n, COUNT(DISTINCT c.c_mktsegment) AS m FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name HAVING COUNT(*) > 1",
        None,
    ),
    "join_text_number": (
        "WITH t AS (SELECT CAST(n_nationkey AS TEXT) AS k, n_name FROM nation) SELECT t.n_name AS n_name, s.s_suppkey AS s_suppkey FROM supplier s JOIN t ON s.s_nationkey = t.k",
        "SELECT n_name, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    ),
    "in_subquery": ("SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)", None),
    "not_in_subquery": ("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)", None),
    "not_in_subquery_null": ("SELECT n_name FROM nation WHERE n_regionkey NOT IN (SELECT NULLIF(r_regionkey, 3) AS k FROM region)", None),
    "exists_corr": ("SELECT c_custkey FROM customer WHERE EXISTS (SELECT o_orderkey FROM orders WHERE orders.o_custkey = customer.c_custkey AND o_orderstatus = 'F')", None),
    "not_exists_corr": ("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT o_orderkey FROM orders WHERE orders.o_custkey = customer.c_custkey AND o_totalprice > 400000)", None),
    "scalar_subquery": ("SELECT o_orderkey FROM orders WHERE o_totalprice = (SELECT MAX(o_totalprice) FROM orders)", None),
    "scalar_corr": (
        "SELECT n_name, (SELECT COUNT(*) FROM customer WHERE customer.c_nationkey = nation.n_nationkey) AS n FROM nation",
        None,
    ),
    "union": ("SELECT n_regionkey AS k FROM nation UNION SELECT r_regionkey FROM region", None),
    "union_all": ("SELECT n_regionkey AS k FROM nation UNION ALL SELECT r_regionkey FROM region", None),
    "intersect": ("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier", None),
    "except": ("SELECT c_nationkey AS k FROM customer EXCEPT SELECT n_nationkey FROM nation WHERE n_regionkey < 2", None),
    "setop_left_to_right": (
        "SELECT r_regionkey AS k FROM region UNION ALL SELECT n_regionkey FROM nation INTERSECT SELECT r_regionkey FROM region WHERE r_regionkey < 2",
        "SELECT k FROM ((SELECT r_regionkey AS k FROM region UNION ALL SELECT n_regionkey FROM nation) INTERSECT SELECT r_regionkey FROM region WHERE r_regionkey < 2)",
    ),
    "setop_sorted": ("SELECT n_nationkey AS k FROM nation UNION SELECT s_suppkey FROM supplier ORDER BY k DESC LIMIT 7 OFFSET 2", None),
    "cte": ("WITH big AS (SELECT o_custkey AS k, o_totalprice AS p FROM orders WHERE o_totalprice > 100000) SELECT k, COUNT(*) AS n FROM big GROUP BY k", None),
    "cte_multi": (
        "WITH a AS (SELECT n_nationkey AS k, n_regionkey AS r FROM nation), b AS (SELECT r, COUNT(*) AS n FROM a GROUP BY r) SELECT a.k AS k, b.n AS n FROM a JOIN b ON a.r = b.r",
        None,
    ),
    "win_row_number": ("SELECT o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders", None),
    "win_rank": ("SELECT p_partkey, RANK() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS rk FROM part", None),
    "win_dense_rank": ("SELECT p_partkey, DENSE_RANK() OVER (ORDER BY p_size) AS rk FROM part", None),
    "win_partition_sum": ("SELECT n_nationkey, SUM(n_nationkey) OVER (PARTITION BY n_regionkey) AS s FROM nation", "SELECT n_nationkey, CAST(sum(n_nationkey) OVER (PARTITION BY n_regionkey) AS DOUBLE) AS s FROM nation"),
    "win_running_sum": (
        "SELECT o_orderkey, SUM(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM orders",
        "SELECT o_orderkey, CAST(sum(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS s FROM orders",
    ),
    "win_filter": (
        "SELECT n_nationkey, COUNT(*) FILTER (WHERE n_nationkey > 10) OVER (PARTITION BY n_regionkey) AS n FROM nation",
        None,
    ),
    "win_count_distinct": ("SELECT c_custkey, COUNT(DISTINCT c_mktsegment) OVER (PARTITION BY c_nationkey) AS n FROM customer", None),
    "win_min_max": (
        "SELECT n_nationkey, MIN(n_name) OVER (PARTITION BY n_regionkey) AS lo, MAX(n_nationkey) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS hi FROM nation",
        "SELECT n_nationkey, min(n_name) OVER (PARTITION BY n_regionkey) AS lo, max(n_nationkey) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi FROM nation",
    ),
    "q1_pricing": (
        "WITH t AS (SELECT l_returnflag AS f, l_linestatus AS s, l_quantity AS q, l_extendedprice * (1 - l_discount) AS net FROM lineitem WHERE l_shipdate <= '1998-09-02')"
        " SELECT f, s, COUNT(*) AS n, SUM(q) AS sum_q, MIN(net) AS lo, MAX(net) AS hi FROM t GROUP BY f, s ORDER BY f, s",
        "SELECT l_returnflag AS f, l_linestatus AS s, count(*) AS n, sum(l_quantity) AS sum_q, min(l_extendedprice * (1 - l_discount)) AS lo, max(l_extendedprice * (1 - l_discount)) AS hi"
        " FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2",
    ),
    "q3_segment": (
        "SELECT o.o_orderkey AS o_orderkey, COUNT(*) AS n, MAX(l.l_extendedprice) AS top FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey"
        " JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE c.c_mktsegment = 'BUILDING' AND o.o_orderdate < '1995-03-15' AND l.l_shipdate > '1995-03-15'"
        " GROUP BY o.o_orderkey ORDER BY top DESC, o.o_orderkey LIMIT 10",
        "SELECT o_orderkey, count(*) AS n, max(l_extendedprice) AS top FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey"
        " WHERE c_mktsegment = 'BUILDING' AND o_orderdate < TIMESTAMP '1995-03-15' AND l_shipdate > TIMESTAMP '1995-03-15' GROUP BY 1 ORDER BY top DESC, o_orderkey LIMIT 10",
    ),
}

#: name: (statements, the query that shows the table, reference SQL)
CHANGES: dict[str, tuple[tuple[str, ...], str, str]] = {
    "insert_values": (
        ("INSERT INTO region (r_regionkey, r_name) VALUES (90, 'X'), (91, NULL)",),
        "SELECT r_regionkey, r_name FROM region",
        "SELECT r_regionkey, r_name FROM region UNION ALL VALUES (90, 'X'), (91, NULL)",
    ),
    "insert_select": (
        ("INSERT INTO region SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 2",),
        "SELECT r_regionkey, r_name FROM region",
        "SELECT r_regionkey, r_name FROM region UNION ALL SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 2",
    ),
    "upsert_nothing": (
        ("INSERT INTO region VALUES (1, 'one'), (7, 'seven'), (7, 'again') ON CONFLICT (r_regionkey) DO NOTHING",),
        "SELECT r_regionkey, r_name FROM region",
        "SELECT r_regionkey, r_name FROM region UNION ALL VALUES (7, 'seven')",
    ),
    "upsert_update": (
        ("INSERT INTO region VALUES (1, 'one'), (7, 'seven'), (7, 'again') ON CONFLICT (r_regionkey) DO UPDATE SET r_name = r_name || '+' || excluded.r_name",),
        "SELECT r_regionkey, r_name FROM region",
        "SELECT r_regionkey, CASE WHEN r_regionkey = 1 THEN r_name || '+one' ELSE r_name END AS r_name FROM region UNION ALL VALUES (7, 'seven+again')",
    ),
    "update": (
        ("UPDATE customer SET c_acctbal = c_acctbal * 2, c_name = UPPER(c_mktsegment) WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 0)",),
        "SELECT c_custkey, c_name, c_acctbal FROM customer",
        "SELECT c_custkey, CASE WHEN hit THEN upper(c_mktsegment) ELSE c_name END AS c_name, CASE WHEN hit THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal"
        " FROM (SELECT *, c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 0) AS hit FROM customer)",
    ),
    "delete": (
        ("DELETE FROM orders WHERE o_totalprice > 50000 OR o_orderstatus = 'F'",),
        "SELECT o_orderkey, o_totalprice FROM orders",
        "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT (o_totalprice > 50000 OR o_orderstatus = 'F')",
    ),
    "drop_table": (
        ("CREATE TABLE made (id INTEGER)", "INSERT INTO made SELECT n_nationkey FROM nation", "INSERT INTO region SELECT id, 'made' FROM made WHERE id > 20", "DROP TABLE made"),
        "SELECT r_regionkey, r_name FROM region",
        "SELECT r_regionkey, r_name FROM region UNION ALL SELECT n_nationkey, 'made' FROM nation WHERE n_nationkey > 20",
    ),
    "upsert_select": (
        (
            "INSERT INTO customer (c_custkey, c_name, c_acctbal) SELECT o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 450000 ON CONFLICT (c_custkey) DO UPDATE SET c_name = 'big', c_acctbal = 1",
        ),
        "SELECT c_custkey, c_name, c_acctbal FROM customer",
        "SELECT c_custkey, CASE WHEN hit THEN 'big' ELSE c_name END AS c_name, CASE WHEN hit THEN 1 ELSE c_acctbal END AS c_acctbal"
        " FROM (SELECT *, c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000) AS hit FROM customer)",
    ),
    "create_alter": (
        (
            "CREATE TABLE made (id INTEGER, label TEXT, extra REAL)",
            "INSERT INTO made SELECT n_nationkey, n_name, n_regionkey FROM nation",
            "ALTER TABLE made ADD COLUMN later TEXT",
            "ALTER TABLE made DROP COLUMN extra",
            "ALTER TABLE made RENAME COLUMN label TO name",
            "UPDATE made SET later = 'x' WHERE id < 5",
        ),
        "SELECT id, name, later FROM made",
        "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CASE WHEN n_nationkey < 5 THEN 'x' END AS later FROM nation",
    ),
}

#: name: (text of the dialect with ?, parameters, reference SQL)
WITH_PARAMETERS: dict[str, tuple[str, tuple, str]] = {
    "parameters": (
        "SELECT o_orderkey FROM orders WHERE o_orderdate >= ? AND o_totalprice BETWEEN ? AND ? AND o_orderstatus <> ?",
        (dt.date(1996, 1, 1), 1000, 200000.5, "F"),
        "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_totalprice BETWEEN 1000 AND 200000.5 AND o_orderstatus <> 'F'",
    ),
}


def _with_parameters(sql: str, parameters: tuple) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: engine(spark, sf_dir, sql).sql(sql, *parameters)


def _workbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet as a data source: nation written as a workbook, and read back through the engine's reader."""
    datasource.register(spark)
    path = f"{tempfile.mkdtemp(prefix='gridlark-sheet-')}/nation.xlsx"
    datasource.save(spark.read.parquet(f"{sf_dir}/nation.parquet"), path, "nation")
    sheet = next(s for s in read_workbook(path) if s.name == "nation")
    own = Engine(spark)
    own.catalog.put("nation", relation_of(spark, sheet.headers, sheet.rows))
    return own.sql("SELECT n_regionkey, COUNT(*) AS n, MAX(n_name) AS last FROM nation WHERE n_nationkey > '3' GROUP BY n_regionkey")


def _many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One statement with several rows of parameters, as executemany() runs it."""
    sql = "INSERT INTO region (r_regionkey, r_name) VALUES (?, ?)"
    own = engine(spark, sf_dir, sql)
    for row in ((70, "a"), (71, None), (72, "c")):
        own.sql(sql, *row)
    return own.sql("SELECT r_regionkey, r_name FROM region")


#: name: (query, reference SQL)
OTHERS: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "workbook_scan": (_workbook, "SELECT n_regionkey, count(*) AS n, max(n_name) AS last FROM nation WHERE n_nationkey > 3 GROUP BY 1"),
    "insert_many": (_many, "SELECT r_regionkey, r_name FROM region UNION ALL VALUES (70, 'a'), (71, NULL), (72, 'c')"),
}


def _select(sql: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: engine(spark, sf_dir, sql).sql(sql)


def _change(statements: tuple[str, ...], shown: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        own = engine(spark, sf_dir, " ".join([*statements, shown]))
        for s in statements:
            own.sql(s)
        return own.sql(shown)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name: _select(text) for name, (text, _) in SELECTS.items()}
    out |= {name: _change(statements, shown) for name, (statements, shown, _) in CHANGES.items()}
    out |= {name: _with_parameters(text, parameters) for name, (text, parameters, _) in WITH_PARAMETERS.items()}
    return out | {name: query for name, (query, _) in OTHERS.items()}


def oracle_sql() -> dict[str, str]:
    out = {n: other or text for n, (text, other) in SELECTS.items()} | {n: other for n, (_, _, other) in CHANGES.items()}
    return out | {n: other for n, (_, _, other) in WITH_PARAMETERS.items()} | {n: other for n, (_, other) in OTHERS.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = (
        "SELECT l_returnflag, l_linestatus, COUNT(*) AS n, SUM(l_quantity) AS sum_qty, AVG(l_discount) AS avg_disc "
        "FROM lineitem WHERE l_shipdate <= '1998-09-02' GROUP BY l_returnflag, l_linestatus ORDER BY l_returnflag, l_linestatus"
    )
    return engine(spark, sf_dir, sql).sql(sql)
