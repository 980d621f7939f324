"""DuckDB SQL for the ingestion and format queries."""

from __future__ import annotations

from duck_oracle import ORACLE
from duck_oracle.clean_sql import cleaned_sql

STAMP1, STAMP2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def as_text(cols, stamp=None, missing=()):
    parts = [("CAST(NULL AS VARCHAR)" if c in missing else f"CAST({c} AS VARCHAR)") + f" AS {c}" for c in cols]
    if stamp:
        parts.append(f"TIMESTAMP '{stamp}' AS ingested_at")
    return ", ".join(parts)


ORACLE["raw_text_stamp"] = f"SELECT {as_text(ORDER_COLS, STAMP1)} FROM orders"

ORACLE["sanitize_columns"] = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment AS c_mkt_segment FROM customer"""

ORACLE["drop_sensitive"] = "SELECT c_custkey AS user_id, c_name AS name, c_mktsegment AS issuing_bank FROM customer"

ORACLE["drop_unnamed"] = "SELECT c_name, c_acctbal, c_mktsegment FROM customer"

ORACLE["ingest_audit_upsert"] = """
SELECT schema_name, table_name, max(last_ingested_at) AS last_ingested_at FROM (
  SELECT 'raw' AS schema_name, event_type AS table_name, max(ts) AS last_ingested_at FROM events GROUP BY event_type
  UNION ALL
  SELECT 'raw', 'orders', max(o_orderdate) FROM orders) a
GROUP BY schema_name, table_name"""

ORACLE["raw_append_two_batches"] = f"""
SELECT {as_text(ORDER_COLS, STAMP1, missing=('o_orderpriority',))} FROM orders
UNION ALL SELECT {as_text(ORDER_COLS, STAMP2)} FROM orders"""

ORACLE["staging_overwrite"] = f"SELECT * FROM {cleaned_sql('line_item')} c"

ORACLE["preview_sample"] = f"SELECT * FROM ({ORACLE['dedup_campaign']}) c ORDER BY campaign_id LIMIT 10"

_CUST = """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
  CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment, c_name || ', "' || c_mktsegment || '"' AS c_label"""
ORACLE["csv_delimiter_fallback"] = "\nUNION ALL\n".join(
    f"{_CUST}, '{lab}' AS source FROM customer" for lab in ["comma", "tab", "semicolon"])

_ORDERS = """CAST(o_orderkey AS VARCHAR) AS unnamed_0, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders"""
ORACLE["json_column_orient_scan"] = f"SELECT 'columns' AS form, {_ORDERS} UNION ALL SELECT 'lines', {_ORDERS}"

ORACLE["html_table_scan"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       NULLIF(o_orderstatus, 'F') AS o_orderstatus, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders"""

ORACLE["row_index_column"] = """
SELECT row_number() OVER () - 1 AS unnamed_0, 'lineitem.parquet' AS file, l_orderkey, l_linenumber FROM lineitem"""

ORACLE["incremental_file_ingest"] = """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS VARCHAR) AS ts, CAST(user_id AS VARCHAR) AS user_id, event_type,
       CAST(value AS VARCHAR) AS value, props FROM events"""

ORACLE["dedup_sink"] = ORACLE["dedup_order"]
ORACLE["snapshot_sink"] = ORACLE["dim_user_snapshot"]
ORACLE["calendar_sink"] = ORACLE["dim_date"]
ORACLE["fact_orders_reload"] = ORACLE["fact_orders"]

ORACLE["csv_line_breaks"] = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
       c_name || ',' || chr(10) || '"' || c_mktsegment || '"' || chr(10) || CAST(c_acctbal AS VARCHAR) AS c_label, c_mktsegment FROM customer"""

ORACLE["json_column_layouts"] = f"SELECT 'line' AS form, {_ORDERS} UNION ALL SELECT 'pretty', {_ORDERS}"

ORACLE["html_data_frame_scan"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS unnamed_0, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders"""

ORACLE["html_hand_written_scan"] = """
SELECT CAST(p_partkey AS VARCHAR) AS key, p_name AS part_name, p_type AS part_type FROM part
UNION ALL
SELECT CAST(p_partkey AS VARCHAR), 'size ' || p_size, 'size ' || p_size FROM part"""

ORACLE["ingest_quarantine"] = """
SELECT 'customer.csv' AS source, count(*) FILTER (c_custkey % 17 <> 0 AND c_custkey % 19 <> 0) AS good,
       count(*) FILTER (c_custkey % 17 = 0 OR c_custkey % 19 = 0) AS bad, CAST(NULL AS VARCHAR) AS skipped FROM customer
UNION ALL
SELECT 'orders.json', count(*) FILTER (o_orderkey % 13 <> 0), count(*) FILTER (o_orderkey % 13 = 0), NULL FROM orders
UNION ALL
SELECT 'supplier.html', count(*) FILTER (s_suppkey % 50 % 7 <> 0), count(DISTINCT s_suppkey % 50) FILTER (s_suppkey % 50 % 7 = 0), NULL FROM supplier
UNION ALL SELECT 'region.parquet', 0, 0, 'empty' UNION ALL SELECT 'nation.xlsx', 0, 0, 'no distributed Excel reader'"""
ORACLE["ingest_audit_table"] = ORACLE["ingest_audit_upsert"]
ORACLE["stream_latest_wins"] = ORACLE["dedup_order"]
