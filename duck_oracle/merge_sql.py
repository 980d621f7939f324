"""DuckDB SQL for the order / line-item assembly joins."""

from __future__ import annotations

from duck_oracle import ORACLE

PERIODS = """(SELECT CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 1
                       WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 2 ELSE 3 END AS period,
    'O' || CAST(o_orderkey AS VARCHAR) AS order_id, 'U' || CAST(o_custkey AS VARCHAR) AS user_id,
    CAST(o_orderdate AS DATE) AS transaction_date, o_orderkey FROM orders)"""
INDEXED = f"""(SELECT ROW_NUMBER() OVER (PARTITION BY period ORDER BY o_orderkey) - 1 AS unnamed_0, *
    FROM {PERIODS} p)"""


def period(i: int) -> str:
    return f"(SELECT unnamed_0, order_id, user_id, transaction_date FROM {INDEXED} x WHERE period = {i})"


ORACLE["order_period_union"] = f"""
SELECT order_id, user_id, transaction_date FROM {period(1)} a
UNION ALL SELECT order_id, user_id, transaction_date FROM {period(2)} b
UNION ALL SELECT order_id, user_id, transaction_date FROM {period(3)} c"""

ORACLE["outer_merge_keep_left"] = f"""
WITH m12 AS (
  SELECT COALESCE(a.unnamed_0, b.unnamed_0) AS unnamed_0, a.order_id, a.user_id, a.transaction_date
  FROM {period(1)} a FULL OUTER JOIN {period(2)} b ON a.unnamed_0 = b.unnamed_0)
SELECT COALESCE(m.unnamed_0, c.unnamed_0) AS unnamed_0, m.order_id, m.user_id, m.transaction_date
FROM m12 m FULL OUTER JOIN {period(3)} c ON m.unnamed_0 = c.unnamed_0"""

LINK = """(SELECT l_orderkey, 'O' || CAST(l_orderkey AS VARCHAR) AS order_id,
    'M' || CAST(min(l_suppkey) AS VARCHAR) AS merchant_id, 'S' || CAST(max(l_suppkey) AS VARCHAR) AS staff_id
    FROM lineitem GROUP BY l_orderkey)"""
BASE = "(SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS order_id, 'U' || CAST(o_custkey AS VARCHAR) AS user_id FROM orders)"


def link(i: int) -> str:
    return f"(SELECT order_id, merchant_id, staff_id FROM {LINK} l WHERE l_orderkey % 3 = {i})"


ORACLE["left_join_keep_left"] = f"""
SELECT o.order_id, o.user_id, l1.merchant_id, l1.staff_id
FROM {BASE} o LEFT JOIN {link(0)} l1 ON o.order_id = l1.order_id
LEFT JOIN {link(1)} l2 ON o.order_id = l2.order_id
LEFT JOIN {link(2)} l3 ON o.order_id = l3.order_id"""

ORACLE["left_join_coalesce"] = f"""
SELECT o.order_id, o.user_id, COALESCE(l1.merchant_id, l2.merchant_id, l3.merchant_id) AS merchant_id,
       COALESCE(l1.staff_id, l2.staff_id, l3.staff_id) AS staff_id
FROM {BASE} o LEFT JOIN {link(0)} l1 ON o.order_id = l1.order_id
LEFT JOIN {link(1)} l2 ON o.order_id = l2.order_id
LEFT JOIN {link(2)} l3 ON o.order_id = l3.order_id"""

_LI = """(SELECT ROW_NUMBER() OVER (ORDER BY l_orderkey NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
    l_linenumber NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
    l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) - 1 AS unnamed_0,
    * FROM lineitem)"""
ORACLE["broadcast_index_join"] = f"""
WITH idx AS {_LI},
prices AS (SELECT unnamed_0, 'O' || CAST(l_orderkey AS VARCHAR) AS order_id,
                  CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_quantity AS INTEGER) AS quantity FROM idx),
products AS (SELECT unnamed_0, 'part ' || CAST(l_partkey AS VARCHAR) AS product_name,
                    'P' || CAST(l_partkey AS VARCHAR) AS product_id FROM idx)
SELECT p.unnamed_0, p.order_id, p.price, p.quantity, d.product_name, d.product_id
FROM prices p LEFT JOIN products d ON p.unnamed_0 = d.unnamed_0"""
