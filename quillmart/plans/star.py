"""Star-layer builders: calendar, dimension snapshots, fact loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.functions.calendar import calendar_columns, date_key
from quillmart.functions.fixed_values import CALENDAR_END, CALENDAR_START
from quillmart.operators.keys import number_small_groups


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """Calendar rows start..end (default 2020-01-01..2030-12-31: 4,018 rows)."""
    span = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"),
                                                      F.lit(end).cast("date"))).alias("d"))
    return span.select(*calendar_columns(F.col("d")))


def rows_per_day(calendar: DataFrame, dates: DataFrame, col: str, name: str) -> DataFrame:
    """The calendar with the number of rows dated on each day, as ``name``: rows
    are counted per day before the join."""
    per_day = dates.groupBy(date_key(col).alias("date_sk")).agg(F.count(F.lit(1)).alias("n"))
    return calendar.join(per_day, "date_sk", "left").withColumn(
        name, F.coalesce("n", F.lit(0)).cast("bigint")).drop("n")


def dim_date_spanning(dates: DataFrame, col: str) -> DataFrame:
    """Calendar covering the min..max of a date column (one global min/max
    aggregate, then a bounded sequence: one row per day of the span)."""
    span = dates.agg(F.min(F.col(col).cast("date")).alias("lo"), F.max(F.col(col).cast("date")).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


# ------------------------------------------------------------ snapshots (t2)

def location_snapshot(user: DataFrame, merchant: DataFrame, staff: DataFrame) -> DataFrame:
    """All addresses of users, merchants and staff with a street (duplicates kept)."""
    cols = ["street", "city", "state", "country"]
    u = user.select(*cols).unionAll(merchant.select(*cols)).unionAll(staff.select(*cols))
    return u.where(F.col("street").isNotNull())


ADDRESS = ["street", "city", "state", "country"]


def user_snapshot(user: DataFrame, user_job: DataFrame) -> DataFrame:
    """User with job title/level (left join on user id: can fan out when a
    user id carries several job rows), with the stamps of both."""
    uj = user_job.select("user_id", "job_title", "job_level", F.col("ingested_at").alias("job_ingested_at"))
    return user.join(uj, "user_id", "left").select(
        "user_id", "name", F.col("birthdate").cast("date").alias("birthdate"), "gender",
        "device_address", "creation_date", "user_type", "job_title", "job_level", *ADDRESS,
        "ingested_at", "job_ingested_at")


def product_snapshot(product: DataFrame) -> DataFrame:
    return product.select("product_id", "product_name", "product_type", "price", "ingested_at")


def merchant_snapshot(merchant: DataFrame) -> DataFrame:
    return merchant.select("merchant_id", "name", "contact_number", "creation_date", *ADDRESS, "ingested_at")


def staff_snapshot(staff: DataFrame) -> DataFrame:
    return staff.select("staff_id", "name", "job_level", "contact_number", "creation_date", *ADDRESS, "ingested_at")


def campaign_snapshot(campaign: DataFrame) -> DataFrame:
    return campaign.select("campaign_id", "campaign_name", "campaign_description", "discount", "ingested_at")


def issuing_bank_snapshot(credit_card: DataFrame) -> DataFrame:
    return credit_card.select("user_id", "issuing_bank", "ingested_at")


def with_location_sk(rows: DataFrame, dim_location: DataFrame) -> DataFrame:
    """``rows`` with the surrogate key of their address in the current
    location versions: a NULL-safe match of the four columns, 0 where there
    is none."""
    loc = dim_location.where("is_current AND location_sk > 0").select(
        *[F.col(c).alias("_l_" + c) for c in ADDRESS], F.col("location_sk").alias("_l_sk"))
    cond = F.lit(True)
    for c in ADDRESS:
        cond = cond & F.col(c).eqNullSafe(F.col("_l_" + c))
    return rows.join(loc, cond, "left").select(*rows.columns,
                                               F.coalesce("_l_sk", F.lit(0)).cast("bigint").alias("location_sk"))


# ------------------------------------------------------------------- facts

def _current(dim: DataFrame, cols: list) -> DataFrame:
    return dim.where(F.col("is_current") == F.lit(True)).select(*cols)


def fact_orders(orders: DataFrame, dim_user: DataFrame, dim_merchant: DataFrame,
                dim_staff: DataFrame, dim_campaign: DataFrame,
                existing: DataFrame | None = None, user_name: str | None = None,
                staff_name: str | None = None) -> DataFrame:
    """Order facts with surrogate keys of the current dimension versions
    (unknown member 0 when unmatched). With ``existing`` (append) orders
    already loaded are skipped; without (truncate) all are loaded. With
    ``user_name`` / ``staff_name``, columns of ``orders``, the user / the
    staff member must match by id and name.

    Dimensions are filtered to current versions before the join; each join
    is an equi-join AQE can turn into a broadcast from measured sizes."""
    o = orders
    if existing is not None:
        o = o.join(existing.select("order_id"), "order_id", "left_anti")
    u = _current(dim_user, ["user_id", "user_sk", *([F.col("name").alias(user_name)] if user_name else [])])
    m = _current(dim_merchant, ["merchant_id", "merchant_sk"])
    s = _current(dim_staff, ["staff_id", "staff_sk", *([F.col("name").alias(staff_name)] if staff_name else [])])
    c = _current(dim_campaign, ["campaign_id", "campaign_sk"])
    j = (o.join(u, ["user_id", *([user_name] if user_name else [])], "left").join(m, "merchant_id", "left")
         .join(s, ["staff_id", *([staff_name] if staff_name else [])], "left").join(c, "campaign_id", "left"))
    return j.select(
        "order_id",
        F.coalesce("user_sk", F.lit(0)).cast("bigint").alias("user_sk"),
        F.coalesce("merchant_sk", F.lit(0)).cast("bigint").alias("merchant_sk"),
        F.coalesce("staff_sk", F.lit(0)).cast("bigint").alias("staff_sk"),
        F.coalesce("campaign_sk", F.lit(0)).cast("bigint").alias("campaign_sk"),
        date_key("transaction_date").alias("date_sk"),
        "estimated_arrival", "delay_in_days",
        F.coalesce("availed", F.lit(False)).alias("campaign_availed"))


def fact_line_items(line_items: DataFrame, fact_orders_df: DataFrame, dim_product: DataFrame,
                    existing: DataFrame | None = None) -> DataFrame:
    """Line facts: numbered per order (deterministic total order: product,
    price, quantity, name), joined to their order fact (lines of unknown
    orders dropped) and the current product version; (order, line) pairs
    already loaded are skipped.

    Line numbers come from ``number_small_groups``: a window that leaves the
    lines partitioned for the join; a hot order is spread over several range
    partitions instead of one window task."""
    # Numbering first: an order's lines are all kept or all dropped by the
    # inner join (one fact row per order), so the numbers are the same, and
    # the numbering does not have to carry the order facts' lineage.
    numbered = number_small_groups(line_items, ["product_id", "price", "quantity", "product_name"],
                                   "line_item_id", group=["order_id"])
    numbered = numbered.join(fact_orders_df.select(
        "order_id", "merchant_sk", "user_sk", "staff_sk", "date_sk"), "order_id", "inner")
    p = _current(dim_product, ["product_id", "product_sk"])
    j = numbered.join(p, "product_id", "left")
    out = j.select(
        F.col("line_item_id").cast("bigint").alias("line_item_id"),
        F.col("order_id").alias("order_sk"),
        F.coalesce("product_sk", F.lit(0)).cast("bigint").alias("product_sk"),
        "merchant_sk", "user_sk", "staff_sk", "date_sk", "price", "quantity")
    return out if existing is None else not_loaded(out, existing)


def not_loaded(lines: DataFrame, existing: DataFrame) -> DataFrame:
    """The line facts whose (order, line) pair is not among the loaded ones."""
    return lines.join(existing.select("order_sk", "line_item_id"), ["order_sk", "line_item_id"], "left_anti")
