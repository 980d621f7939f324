"""Raw-layer stand-ins derived from the driver tables.

The shop's department files are not available, so each raw table is derived
from a driver table with deterministic "dirt" (messy text, re-ingested
batches, conflicting copies, NULLs) computed from key arithmetic. Every row of
the driver table is used; the modulo tests only decide which rows get extra
dirty copies or messy text, never which rows are kept.

Column recipes are plain SQL expressions valid in both Spark SQL and DuckDB,
so the oracle derives the identical input; the operators under test
(cleaning, dedup, SCD2, facts, ...) are written separately on each side.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.sources.tables import read_for_row_work, read_table

STAMP1 = "2024-01-01 00:00:00"
STAMP2 = "2024-02-01 00:00:00"


def pick(values: list, idx_sql: str) -> str:
    """SQL CASE choosing values[idx % n] (NULL for None)."""
    n = len(values)
    parts = []
    for i, v in enumerate(values):
        lit = "NULL" if v is None else "'" + v.replace("'", "''") + "'"
        parts.append(f"WHEN {i} THEN {lit}")
    return f"(CASE ({idx_sql}) % {n} {' '.join(parts)} END)"


def date_text(key: str, salt: int = 0) -> str:
    """ISO or US date text from key arithmetic; some invalid, some blank."""
    y = f"cast(2020 + ({key} + {salt}) % 5 as string)"
    m = f"lpad(cast(1 + ({key} + {salt}) % 12 as string), 2, '0')"
    d = f"lpad(cast(1 + ({key} + {salt}) % 28 as string), 2, '0')"
    return (f"(CASE WHEN {key} % 31 = 0 THEN '2024-02-30' WHEN {key} % 37 = 0 THEN 'unknown' "
            f"WHEN {key} % 3 = 1 THEN {m} || '/' || {d} || '/' || {y} "
            f"ELSE {y} || '-' || {m} || '-' || {d} END)")


def state_text(key: str, idx: str) -> str:
    code = pick(["AL", "CA", "TX", "NY", "FL", "WA", "Ontario"], idx)
    return (f"(CASE WHEN {key} % 19 = 0 THEN ' ' WHEN {key} % 4 = 1 THEN ' ' || lower({code}) || ' ' "
            f"ELSE {code} END)")


def phone_text(key: str) -> str:
    return (f"(CASE WHEN {key} % 9 = 0 THEN 'none' ELSE '+1 (' || lpad(cast({key} % 1000 as string), 3, '0') "
            f"|| ') 555-' || lpad(cast({key} % 10000 as string), 4, '0') END)")


@dataclass
class Standin:
    """A raw table: source driver table, integer key, column recipes, and the
    batch recipe (which column changes in later batches)."""

    source: str
    key: str
    columns: list[tuple[str, str]]
    change_col: str | None = None
    change_a: str | None = None
    change_b: str | None = None
    null_key_col: str | None = None
    extra: dict = field(default_factory=dict)


STANDINS: dict[str, Standin] = {
    "raw_user": Standin(
        source="customer", key="c_custkey",
        columns=[
            ("user_id", "'U' || cast(c_custkey as string)"),
            ("creation_date", date_text("c_custkey")),
            ("name", "c_name"),
            ("street", "cast(c_custkey % 500 as string) || ' Market St'"),
            ("state", state_text("c_custkey", "c_nationkey")),
            ("city", "'City ' || cast(c_nationkey as string)"),
            ("country", "(CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_nationkey = 5 THEN 'Philippines' "
                        "ELSE 'United States' END)"),
            ("birthdate", date_text("c_custkey", 7) + " || ' 08:30:00'"),
            ("gender", pick(["M", "F", ""], "c_custkey")),
            ("device_address", "'DEV-' || cast(c_custkey as string)"),
            ("user_type", "c_mktsegment"),
        ],
        change_col="user_type", change_a="c_mktsegment || '-X'", change_b="lower(c_mktsegment)",
        null_key_col="user_id",
    ),
    "raw_user_job": Standin(
        source="customer", key="c_custkey",
        columns=[
            ("user_id", "'U' || cast(c_custkey as string)"),
            ("name", "lower(c_name)"),
            ("job_title", pick(["front-end developer", "data ENGINEER", "  sales manager ",
                                "o'neil mcDONALD analyst", "", None, "qa-tester"], "c_custkey")),
            ("job_level", "(CASE WHEN c_acctbal < 1000 THEN 'junior' WHEN c_acctbal < 5000 THEN 'mid-level' "
                          "ELSE 'SENIOR' END)"),
        ],
        change_col="job_level", change_a="'lead'", change_b="'principal'", null_key_col="user_id",
    ),
    "raw_credit_card": Standin(
        source="customer", key="c_custkey",
        columns=[
            ("user_id", "'U' || cast(c_custkey as string)"),
            ("name", "c_name"),
            ("issuing_bank", pick(["bpi", "  city   savings ", "BDO unibank", "nan", "", "metrobank",
                                   "security bank 2", "eastwest bank"], "c_custkey")),
            ("credit_card_number", "'4111' || lpad(cast(c_custkey as string), 12, '0')"),
        ],
        change_col="issuing_bank", change_a="'rcbc savings'", change_b="'pnb'", null_key_col="user_id",
    ),
    "raw_merchant": Standin(
        source="supplier", key="s_suppkey",
        columns=[
            ("merchant_id", "'M' || cast(s_suppkey as string)"),
            ("creation_date", date_text("s_suppkey", 3)),
            ("name", "s_name"),
            ("street", "cast(s_suppkey % 300 as string) || ' Trade Ave'"),
            ("state", state_text("s_suppkey", "s_nationkey")),
            ("city", "'City ' || cast(s_nationkey as string)"),
            ("country", "(CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE 'United States' END)"),
            ("contact_number", phone_text("s_suppkey")),
        ],
        change_col="name", change_a="s_name || ' Inc'", change_b="s_name || ' LLC'",
        null_key_col="merchant_id",
    ),
    "raw_staff": Standin(
        source="supplier", key="s_suppkey",
        columns=[
            ("staff_id", "'S' || cast(s_suppkey as string)"),
            ("name", "'Staff ' || cast(s_suppkey as string)"),
            ("job_level", "(CASE WHEN s_acctbal < 2000 THEN 'Associate' WHEN s_acctbal < 6000 THEN 'Senior' "
                          "ELSE 'Manager' END)"),
            ("street", "cast(s_suppkey % 300 as string) || ' Office Rd'"),
            ("state", state_text("s_suppkey", "s_nationkey + 1")),
            ("city", "'City ' || cast(s_nationkey as string)"),
            ("country", "(CASE WHEN s_suppkey % 17 = 0 THEN NULL ELSE 'United States' END)"),
            ("contact_number", phone_text("s_suppkey + 7")),
            ("creation_date", date_text("s_suppkey", 11)),
        ],
        change_col="job_level", change_a="'Director'", change_b="'Lead'", null_key_col="staff_id",
    ),
    "raw_product": Standin(
        source="part", key="p_partkey",
        columns=[
            ("product_id", "'P' || cast(p_partkey as string)"),
            ("product_name", "p_name"),
            ("product_type", "(CASE WHEN p_partkey % 9 = 0 THEN 'N/A' WHEN p_partkey % 23 = 0 THEN NULL "
                             "WHEN p_partkey % 4 = 1 THEN ' ' || lower(p_type) || '_goods ' ELSE p_type END)"),
            ("price", "(CASE WHEN p_partkey % 15 = 0 THEN 'x' ELSE "
                      "cast(cast(p_retailprice as decimal(10,2)) as string) || cast(p_partkey % 10 as string) END)"),
        ],
        change_col="price", change_a="cast(cast(p_retailprice + 1 as decimal(10,2)) as string)",
        change_b="cast(cast(p_retailprice + 2 as decimal(10,2)) as string)", null_key_col="product_id",
    ),
    "raw_campaign": Standin(
        source="orders", key="o_orderkey",
        columns=[
            ("campaign_id", "'C' || cast(o_orderkey as string)"),
            ("campaign_name", "substr(o_orderpriority, 3)"),
            ("campaign_description", "'Priority ' || o_orderpriority || ' for status ' || o_orderstatus"),
            ("discount", "(CASE WHEN o_orderkey % 17 = 0 THEN 'free' ELSE cast(o_custkey % 40 as string) || "
                         + pick(["%", "pct", "%%", "percent"], "o_orderkey") + " END)"),
        ],
        change_col="discount", change_a="'15%'", change_b="'25pct'", null_key_col="campaign_id",
    ),
    "raw_order": Standin(
        source="orders_linked", key="o_orderkey",
        columns=[
            ("order_id", "'O' || cast(o_orderkey as string)"),
            ("campaign_id", "'C' || cast(o_orderkey as string)"),
            ("user_id", "'U' || cast(o_custkey as string)"),
            ("merchant_id", "'M' || cast(merchant_key as string)"),
            ("staff_id", "'S' || cast(staff_key as string)"),
            ("transaction_date", "(CASE WHEN o_orderkey % 31 = 0 THEN '2024-02-30' WHEN o_orderkey % 37 = 0 "
                                 "THEN NULL ELSE cast(cast(o_orderdate as date) as string) END)"),
            ("estimated_arrival", "cast(o_custkey % 10 + 1 as string) || 'days'"),
            ("delay_in_days", "(CASE WHEN o_orderkey % 41 = 0 THEN 'none' ELSE cast(ship_span as string) END)"),
            ("availed", "(CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' ELSE '1.0' END)"),
        ],
        change_col="delay_in_days", change_a="cast(ship_span + 1 as string)", change_b="cast(ship_span + 2 as string)",
        null_key_col="order_id",
    ),
    "raw_line_item": Standin(
        source="lineitem", key="l_orderkey",
        columns=[
            ("order_id", "'O' || cast(l_orderkey as string)"),
            ("price", "cast(cast(l_extendedprice as decimal(12,2)) as string)"),
            ("quantity", "(CASE WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_orderkey % 19 = 0 THEN 'none' "
                         "ELSE cast(cast(l_quantity as int) as string) || 'PC' END)"),
            ("product_name", "'part ' || cast(l_partkey as string)"),
            ("product_id", "'P' || cast(l_partkey as string)"),
        ],
        change_col="quantity", change_a="'1PC'", change_b="'2 pcs'", null_key_col="order_id",
    ),
}

# Per-order link data derived from the line items: the order's merchant and
# staff member and the span of its shipments (one aggregate over lineitem).
ORDERS_LINKED_SQL = """
SELECT o.*, l.merchant_key, l.staff_key, l.ship_span
FROM orders o LEFT JOIN (
  SELECT l_orderkey, min(l_suppkey) AS merchant_key, max(l_suppkey) AS staff_key,
         date_diff('day', min(l_shipdate), max(l_shipdate)) AS ship_span
  FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
"""


def orders_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders ⟕ (per-order aggregate of lineitem): partial aggregation before
    the shuffle, then a shuffle join on the order key."""
    li = read_table(spark, sf_dir, "lineitem")
    agg = li.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("merchant_key"),
        F.max("l_suppkey").alias("staff_key"),
        F.datediff(F.max("l_shipdate"), F.min("l_shipdate")).alias("ship_span"),
    )
    o = read_for_row_work(spark, sf_dir, "orders")
    return o.join(agg, o.o_orderkey == agg.l_orderkey, "left").drop("l_orderkey")


def source_rows(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    if source == "orders_linked":
        return orders_linked(spark, sf_dir)
    return read_for_row_work(spark, sf_dir, source)


def raw_table(spark: SparkSession, sf_dir: str, name: str, batches: bool = True, source: DataFrame | None = None) -> DataFrame:
    """The raw table as ingested: all text columns + ``ingested_at``.

    Batches: every row at STAMP1; exact copies (key % 7) at STAMP1; a changed
    copy (key % 10) at STAMP2; two disagreeing copies (key % 11) at STAMP2;
    a copy with a NULL key (key % 17) at STAMP2.

    One scan: each source row is expanded to its list of batch tags with
    ``explode`` (no union of repeated scans/joins). ``source``: the rows of
    ``source_rows``, where a caller has them already."""
    st = STANDINS[name]
    src = source if source is not None else source_rows(spark, sf_dir, st.source)
    if not batches or st.change_col is None:
        return src.select(*_single_batch_columns(name))
    tag, out = _batch_columns(name)
    return src.select("*", tag).select(*out)


@functools.cache
def _single_batch_columns(name: str) -> list[Column]:
    st = STANDINS[name]
    s1 = F.lit(STAMP1).cast("timestamp_ntz")
    return [*[F.expr(e).alias(c) for c, e in st.columns], s1.alias("ingested_at")]


@functools.cache
def _batch_columns(name: str) -> tuple[Column, list[Column]]:
    """The batch-tag generator and the output columns of a raw table, built
    once per process (immutable expressions, reused by every query)."""
    st = STANDINS[name]
    s1 = F.lit(STAMP1).cast("timestamp_ntz")
    s2 = F.lit(STAMP2).cast("timestamp_ntz")
    k = F.col(st.key)
    tags = F.array(F.lit(0), F.when(k % 7 == 0, 1), F.when(k % 10 == 0, 2), F.when(k % 11 == 0, 3),
                   F.when(k % 11 == 0, 4), F.when(k % 17 == 0, 5))
    tag = F.explode(F.filter(tags, lambda x: x.isNotNull())).alias("_b")
    b = F.col("_b")
    out = []
    for c, e in st.columns:
        v = F.expr(e)
        if c == st.change_col:
            v = F.when(b.isin(2, 3), F.expr(st.change_a)).when(b == 4, F.expr(st.change_b)).otherwise(v)
        if c == st.null_key_col:
            v = F.when(b == 5, F.lit(None).cast("string")).otherwise(v)
        out.append(v.alias(c))
    out.append(F.when(b <= 1, s1).otherwise(s2).alias("ingested_at"))
    return tag, out


# ---------------------------------------------------------------- SQL side

def source_sql(source: str) -> str:
    if source == "orders_linked":
        return f"({ORDERS_LINKED_SQL})"
    return source


def raw_table_sql(name: str, batches: bool = True) -> str:
    """The same raw table as DuckDB SQL."""
    st = STANDINS[name]
    src = source_sql(st.source)
    names = [c for c, _ in st.columns]

    def sel(over: dict, stamp: str) -> str:
        parts = [f"{over.get(c, e)} AS {c}" for c, e in st.columns]
        return ", ".join(parts) + f", TIMESTAMP '{stamp}' AS ingested_at"

    k = st.key
    q = [f"SELECT {sel({}, STAMP1)} FROM {src} s"]
    if batches and st.change_col is not None:
        q += [
            f"SELECT {sel({}, STAMP1)} FROM {src} s WHERE {k} % 7 = 0",
            f"SELECT {sel({st.change_col: st.change_a}, STAMP2)} FROM {src} s WHERE {k} % 10 = 0",
            f"SELECT {sel({st.change_col: st.change_a}, STAMP2)} FROM {src} s WHERE {k} % 11 = 0",
            f"SELECT {sel({st.change_col: st.change_b}, STAMP2)} FROM {src} s WHERE {k} % 11 = 0",
            f"SELECT {sel({st.null_key_col: 'CAST(NULL AS VARCHAR)'}, STAMP2)} FROM {src} s WHERE {k} % 17 = 0",
        ]
    body = "\nUNION ALL\n".join(q)
    return f"(SELECT {', '.join(names)}, ingested_at FROM ({body}) u)"
