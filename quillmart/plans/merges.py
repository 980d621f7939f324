"""Assembly of orders and line items from several source files.

The source splits orders over period files and links merchants/staff via
separate files; line-item prices and products come as two files that share
a row index. Stand-ins are derived from the driver tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.operators.joins import (
    join_coalesce,
    join_keep_left,
    outer_merge_keep_left,
    union_all,
)
from quillmart.operators.keys import dense_number
from quillmart.sources.tables import read_table

PERIOD_BOUNDS = ("1997-01-01", "1999-01-01")


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def period_of(d: F.Column) -> F.Column:
    a, b = PERIOD_BOUNDS
    return (F.when(d < F.lit(a).cast("timestamp_ntz"), 1)
            .when(d < F.lit(b).cast("timestamp_ntz"), 2).otherwise(3))


def _orders_with_period(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "orders").select(
        period_of(F.col("o_orderdate")).alias("period"),
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("order_id"),
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.col("o_orderkey"))


def order_periods(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Three period files of orders, each with its own row index
    ``unnamed_0`` (0-based, by order key) — indexes overlap across files."""
    idx = dense_number(_orders_with_period(spark, sf), ["o_orderkey"], "unnamed_0", group=["period"], start=0)
    cols = ["unnamed_0", "order_id", "user_id", "transaction_date"]
    return [idx.where(F.col("period") == p).select(*cols) for p in (1, 2, 3)]


def order_period_union(spark: SparkSession, sf: str) -> DataFrame:
    """Intended assembly: the period files are rows of one table (their row
    indexes are not needed)."""
    o = _orders_with_period(spark, sf)
    return union_all([o.where(F.col("period") == p).drop("period", "o_orderkey") for p in (1, 2, 3)])


def outer_merge_periods(spark: SparkSession, sf: str) -> DataFrame:
    """As the source does it: full outer join of the period files on the row
    index, left file's columns win (rows sharing an index collapse)."""
    return outer_merge_keep_left(order_periods(spark, sf), "unnamed_0")


def merchant_links(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Three order→merchant/staff link files (split by order key mod 3). The
    split looks at an aggregate's value, not at the grouping key, so it stays
    above the aggregate and all three files come from one scan."""
    li = _t(spark, sf, "lineitem")
    link = li.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("m"), F.max("l_suppkey").alias("s"),
                                        F.max("l_orderkey").alias("file_key"))
    link = link.select(
        "file_key",
        F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("order_id"),
        F.concat(F.lit("M"), F.col("m").cast("string")).alias("merchant_id"),
        F.concat(F.lit("S"), F.col("s").cast("string")).alias("staff_id"))
    return [link.where(F.col("file_key") % 3 == i).drop("file_key") for i in range(3)]


def _orders_base(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "orders").select(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("order_id"),
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("user_id"))


def left_join_chain(spark: SparkSession, sf: str, keep_left: bool) -> DataFrame:
    """Orders ⟕ link1 ⟕ link2 ⟕ link3 on order_id. ``keep_left`` is the
    source's behaviour (later files' merchant/staff dropped); otherwise the
    first non-NULL value wins."""
    out = _orders_base(spark, sf)
    for link in merchant_links(spark, sf):
        out = join_keep_left(out, link, ["order_id"]) if keep_left else join_coalesce(out, link, ["order_id"])
    return out


def line_item_files(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Prices file (index, order, price, quantity) and products file (index,
    name, product) sharing a global row index over lineitem."""
    li = _t(spark, sf, "lineitem")
    idx = dense_number(li, li.columns, "unnamed_0", start=0)
    prices = idx.select("unnamed_0",
                        F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("order_id"),
                        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
                        F.col("l_quantity").cast("int").alias("quantity"))
    products = idx.select("unnamed_0",
                          F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("product_name"),
                          F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_id"))
    return prices, products


def index_join(prices: DataFrame, products: DataFrame) -> DataFrame:
    """Left join of prices to products on the shared index column (the first
    column starting with 'unnamed'); AQE picks the join from measured sizes."""
    key = next(c for c in prices.columns if c.lower().startswith("unnamed"))
    clash = [c for c in products.columns if c in prices.columns and c != key]
    prod = products.select(key, *[F.col(c).alias(c + "_prod") if c in clash else F.col(c)
                                  for c in products.columns if c != key])
    return prices.join(prod, key, "left")
