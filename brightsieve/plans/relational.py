"""Relational operators reached through ad-hoc SQL: joins, windows, set operations, subqueries, cubes, JSON, as-of and range joins.

Each entry has the Spark text (tables in braces) and the oracle's.
"""

from __future__ import annotations

import re

from brightsieve.session import table

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def runner(sql: str):
    """A query over the driver tables that ``sql`` names in braces."""

    def run(spark, sf_dir):
        names = sorted(set(re.findall(r"\{(\w+)\}", sql)))
        return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})

    return run


def _same(sql: str) -> tuple[str, str]:
    return sql, re.sub(r"\{(\w+)\}", r"\1", sql)


SQL_QUERIES = {
    "sql_inner_join": _same("SELECT n_name, count(*) AS n, round(sum(c_acctbal), 2) AS bal FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey GROUP BY n_name"),
    "sql_left_join": _same("SELECT c_custkey, count(o_orderkey) AS n FROM {customer} LEFT JOIN {orders} ON o_custkey = c_custkey GROUP BY c_custkey"),
    "sql_right_join": _same("SELECT s_suppkey, n_name FROM {nation} RIGHT JOIN {supplier} ON s_nationkey = n_nationkey AND n_regionkey = 1"),
    "sql_full_join": _same("SELECT coalesce(c_custkey, s_suppkey) AS k, c_name, s_name FROM {customer} FULL OUTER JOIN {supplier} ON c_custkey = s_suppkey"),
    "sql_cross_join": _same("SELECT r_name, n_name FROM {region} CROSS JOIN {nation}"),
    "sql_semi_join": _same("SELECT c_custkey FROM {customer} WHERE EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_totalprice > 200000)"),
    "sql_anti_join": _same("SELECT c_custkey FROM {customer} WHERE NOT EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_totalprice > 200000)"),
    "sql_theta_join": _same("SELECT a.n_name AS a, b.n_name AS b FROM {nation} a JOIN {nation} b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey"),
    "sql_inequality_join": _same("SELECT a.r_name AS a, b.n_name AS b FROM {region} a JOIN {nation} b ON a.r_regionkey < b.n_nationkey - 20"),
    "sql_natural_join": _same("SELECT r_regionkey, n, r_name FROM (SELECT r_regionkey, r_name FROM {region}) a NATURAL JOIN (SELECT n_regionkey AS r_regionkey, count(*) AS n FROM {nation} GROUP BY n_regionkey) b"),
    "sql_grouping_sets": _same("SELECT o_orderstatus, o_orderpriority, grouping(o_orderstatus) AS g, count(*) AS n FROM {orders} GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderpriority), ())"),
    "sql_window_distribution": _same("SELECT o_orderkey, round(percent_rank() OVER w, 9) AS p, round(cume_dist() OVER w, 9) AS c, first_value(o_orderkey) OVER w AS f, nth_value(o_orderkey, 2) OVER w AS s FROM {orders} WINDOW w AS (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_orderkey)"),
    "sql_window_range": _same("SELECT o_orderkey, count(*) OVER (PARTITION BY o_orderstatus ORDER BY o_custkey RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS n FROM {orders}"),
    "sql_group_having": _same("SELECT o_orderpriority, o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS custs, count(*) FILTER (WHERE o_totalprice > 100000) AS big FROM {orders} GROUP BY o_orderpriority, o_orderstatus HAVING count(*) > 10"),
    "sql_rollup": _same("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS q FROM {lineitem} GROUP BY ROLLUP (l_returnflag, l_linestatus)"),
    "sql_cube": _same("SELECT l_returnflag, l_linestatus, count(*) AS n FROM {lineitem} GROUP BY CUBE (l_returnflag, l_linestatus)"),
    "sql_window_rank": _same("SELECT o_orderkey, rank() OVER w AS r, dense_rank() OVER w AS d, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n, ntile(4) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS t FROM {orders} WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderpriority)"),
    "sql_window_frame": _same("SELECT o_orderkey, lag(o_orderkey) OVER w AS before, lead(o_orderkey, 2) OVER w AS after, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS s FROM {orders} WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)"),
    "sql_union": _same("SELECT c_nationkey AS k FROM {customer} UNION SELECT s_nationkey FROM {supplier}"),
    "sql_intersect": _same("SELECT c_nationkey AS k FROM {customer} INTERSECT SELECT s_nationkey FROM {supplier}"),
    "sql_except": _same("SELECT c_custkey AS k FROM {customer} EXCEPT SELECT o_custkey FROM {orders} WHERE o_orderkey % 7 = 0"),
    "sql_cte_subquery": _same("WITH t AS (SELECT o_custkey, sum(o_totalprice) AS s FROM {orders} GROUP BY o_custkey) SELECT o_custkey, round(s, 2) AS s FROM t WHERE s > (SELECT avg(s) FROM t)"),
    "sql_correlated": _same("SELECT o_orderkey FROM {orders} o WHERE o_totalprice > (SELECT avg(o_totalprice) FROM {orders} i WHERE i.o_custkey = o.o_custkey)"),
    "sql_recursive_cte": _same("WITH RECURSIVE t(n, f) AS (SELECT 1, 1 UNION ALL SELECT n + 1, f * (n + 1) FROM t WHERE n < 10) SELECT n, f FROM t"),
    "sql_topk": _same("SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 5"),
    "sql_json": ("SELECT event_id, CAST(get_json_object(props, '$.k') AS INT) AS k FROM {events}", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"),
    "sql_string_functions": (
        "SELECT c_custkey, upper(c_name) AS u, substring(c_name, 3, 4) AS s, locate('#', c_name) AS i, length(c_name) AS l, lpad(CAST(c_custkey AS STRING), 6, '0') AS z, replace(c_mktsegment, 'A', 'a') AS r FROM {customer}",
        "SELECT c_custkey, upper(c_name) AS u, substr(c_name, 3, 4) AS s, CAST(instr(c_name, '#') AS INTEGER) AS i, CAST(length(c_name) AS INTEGER) AS l, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS z, replace(c_mktsegment, 'A', 'a') AS r FROM customer",
    ),
    "sql_date_functions": (
        "SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, date_format(o_orderdate, 'yyyy-MM-dd') AS d, datediff(DATE '2000-01-01', CAST(o_orderdate AS DATE)) AS n FROM {orders}",
        "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, strftime(o_orderdate, '%Y-%m-%d') AS d, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01') AS INTEGER) AS n FROM orders",
    ),
    "sql_group_concat": (
        "SELECT n_regionkey, array_join(array_sort(collect_list(n_name)), ',') AS names FROM {nation} GROUP BY n_regionkey",
        "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey",
    ),
    # the latest event of the same user before each purchase, by one window over the union: no join on inequality
    "sql_asof_join": (
        "SELECT event_id, last_id FROM (SELECT event_id, event_type, last_value(CASE WHEN event_type <> 'purchase' THEN event_id END) IGNORE NULLS OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_id FROM {events}) WHERE event_type = 'purchase'",
        "SELECT event_id, last_id FROM (SELECT event_id, event_type, last_value(CASE WHEN event_type <> 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_id FROM events) WHERE event_type = 'purchase'",
    ),
    # pairs of events of a user at most ten minutes apart: equal user and time block, then the exact bounds
    "sql_range_join": (
        "WITH a AS (SELECT event_id, user_id, unix_micros(CAST(ts AS TIMESTAMP)) AS t FROM {events}), b AS (SELECT *, explode(array(t DIV 600000000, t DIV 600000000 - 1)) AS w FROM a), "
        "c AS (SELECT *, t DIV 600000000 AS w FROM a) SELECT c.event_id AS a, b.event_id AS b FROM c JOIN b ON c.user_id = b.user_id AND c.w = b.w AND b.t >= c.t AND b.t - c.t <= 600000000 AND b.event_id <> c.event_id",
        "SELECT a.event_id AS a, b.event_id AS b FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 10 MINUTE AND a.event_id <> b.event_id",
    ),
    "sql_tpch_q1": _same("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS q, round(sum(l_extendedprice), 2) AS p, round(sum(l_extendedprice * (1 - l_discount)), 2) AS d, round(avg(l_discount), 6) AS a, count(*) AS n FROM {lineitem} WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY l_returnflag, l_linestatus"),
    "sql_tpch_q5": _same("SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM {customer} JOIN {orders} ON c_custkey = o_custkey JOIN {lineitem} ON l_orderkey = o_orderkey JOIN {supplier} ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey GROUP BY n_name"),
}
