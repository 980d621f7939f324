"""The three business questions on the star schema (plus a per-order variant).

``order_lines`` collapses the line items to one row per order in one scan, and
the order's own columns are joined to that; the reports take these rows. A hot
order collapses in the map-side partial aggregate, and no line item is joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.sources.tables import read_table

REVENUE_TYPE = "decimal(38,2)"


def campaign_order_volume(orders: DataFrame, dim_campaign: DataFrame) -> DataFrame:
    """Order volume per campaign name, availed orders only, largest first."""
    per_campaign = (orders.where(F.col("campaign_availed") == F.lit(True))
                    .groupBy("campaign_id").agg(F.count("order_id").alias("n")))
    return (per_campaign.join(dim_campaign.select("campaign_id", "campaign_name"), "campaign_id")
            .groupBy("campaign_name").agg(F.sum("n").cast("bigint").alias("total_order_volume"))
            .orderBy(F.desc("total_order_volume"), "campaign_name"))


def _per_merchant_name(per_merchant: DataFrame, dim_merchant: DataFrame, *more) -> DataFrame:
    names = dim_merchant.select("merchant_id", F.col("name").alias("merchant_name"))
    return (per_merchant.join(names, "merchant_id").groupBy("merchant_name").agg(
        (F.sum("delay_sum").cast("double") / F.sum("delay_n").cast("double")).alias("avg_delay_days"), *more,
        F.sum("revenue").cast(REVENUE_TYPE).alias("total_revenue"))
        .orderBy(F.desc_nulls_last("avg_delay_days"), "merchant_name"))


def merchant_performance(orders: DataFrame, dim_merchant: DataFrame) -> DataFrame:
    """Average delay and revenue per merchant name. As in the source query,
    the average runs over line items (an order with more lines weighs more):
    sum(delay * lines) / lines-with-a-delay, exact in integers."""
    per_merchant = orders.where("n_lines > 0").groupBy("merchant_id").agg(
        F.sum(F.col("delay_in_days").cast("bigint") * F.col("n_lines")).alias("delay_sum"),
        F.sum(F.when(F.col("delay_in_days").isNotNull(), F.col("n_lines"))).alias("delay_n"),
        F.sum("revenue").alias("revenue"))
    return _per_merchant_name(per_merchant, dim_merchant)


def merchant_performance_per_order(orders: DataFrame, dim_merchant: DataFrame) -> DataFrame:
    """Variant: each order counts once in the average delay."""
    per_merchant = orders.where("n_lines > 0").groupBy("merchant_id").agg(
        F.sum("delay_in_days").alias("delay_sum"), F.count("delay_in_days").alias("delay_n"),
        F.count(F.lit(1)).alias("n_orders"), F.sum("revenue").alias("revenue"))
    return _per_merchant_name(per_merchant, dim_merchant,
                              F.sum("n_orders").cast("bigint").alias("number_of_orders"))


def customer_segment_revenue(orders: DataFrame, dim_user: DataFrame) -> DataFrame:
    """Orders with lines and their revenue per (user type, job level),
    largest first: totals per user, then the segment join."""
    per_user = orders.where("n_lines > 0").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("revenue").alias("revenue"))
    return (per_user.join(dim_user.select("user_id", "user_type", "job_level"), "user_id")
            .groupBy("user_type", "job_level").agg(
                F.sum("n_orders").cast("bigint").alias("number_of_orders"),
                F.sum("revenue").cast(REVENUE_TYPE).alias("total_revenue"))
            .orderBy(F.desc("total_revenue"), "user_type", "job_level"))


# ------------------------------------------------------------------ star views
# The prototype star over the driver tables: ids stay native integers (no
# string concatenation in join keys), the grain is the source pipeline's.

def job_level_band(acctbal: F.Column) -> F.Column:
    return (F.when(acctbal < 1000, "Junior").when(acctbal < 5000, "Mid-Level").otherwise("Senior"))


def star_dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"),
                    F.col("c_mktsegment").alias("user_type"),
                    job_level_band(F.col("c_acctbal")).alias("job_level"),
                    F.col("c_nationkey").alias("location_id"))


def star_dim_merchant(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("merchant_id"), F.col("s_name").alias("name"),
                    F.col("s_nationkey").alias("location_id"))


def campaign_columns(priority: F.Column) -> tuple[F.Column, F.Column]:
    """Campaign id and name of an order priority such as ``2-HIGH``."""
    return (F.substring(priority, 1, 1).cast("int").alias("campaign_id"),
            F.expr("substring(o_orderpriority, 3)").alias("campaign_name"))


def star_dim_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One campaign per order priority (derived by a distinct over orders)."""
    return read_table(spark, sf_dir, "orders").select(*campaign_columns(F.col("o_orderpriority"))).distinct()


def star_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order facts without what only the lines know."""
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        campaign_columns(F.col("o_orderpriority"))[0],
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        (F.col("o_custkey") % 10 + 1).cast("int").alias("estimated_arrival"),
        (F.col("o_orderstatus") == "F").alias("campaign_availed"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order of the line items: merchant, staff, delay, number of
    lines and revenue (exact decimals)."""
    price, quantity = F.col("l_extendedprice").cast("decimal(12,2)"), F.col("l_quantity").cast("int")
    return read_table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.min("l_suppkey").alias("merchant_id"), F.max("l_suppkey").alias("staff_id"),
        F.datediff(F.max("l_shipdate"), F.min("l_shipdate")).alias("delay_in_days"),
        F.count(F.lit(1)).alias("n_lines"), F.sum(price * quantity).alias("revenue"))


def star_order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order facts with their lines' totals (NULL for an order without lines)."""
    return star_orders(spark, sf_dir).join(order_lines(spark, sf_dir), "order_id", "left")
