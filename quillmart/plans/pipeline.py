"""The warehouse chain:
raw -> clean -> dedup -> snapshots -> SCD2 dimensions -> facts -> reports.

Numbering a table runs Spark jobs while the plan is built (range bounds and
one checkpoint); the dimensions of a load are numbered together. The rest are
plans that Catalyst can fuse and prune.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.operators import scd
from quillmart.operators.scd import ScdSpec
from quillmart.plans import analytics as A
from quillmart.plans import star as S
from quillmart.plans.queries import deduped
from quillmart.sources.tables import read_table

LOAD_DATE = "2024-03-01"

# M-06: the seven type-2 dimensions (key, tracked columns, required key columns).
SCD_SPECS = {
    "dim_location": ScdSpec("dim_location", "location_sk", ("street", "city", "state", "country"), ()),
    "dim_user": ScdSpec("dim_user", "user_sk", ("user_id",),
                        ("name", "birthdate", "gender", "device_address", "user_type", "job_title", "job_level",
                         "location_sk"), ("user_id",)),
    "dim_product": ScdSpec("dim_product", "product_sk", ("product_id",), ("product_name", "product_type", "price"),
                           ("product_id",)),
    "dim_merchant": ScdSpec("dim_merchant", "merchant_sk", ("merchant_id",),
                            ("name", "contact_number", "location_sk"), ("merchant_id",)),
    "dim_staff": ScdSpec("dim_staff", "staff_sk", ("staff_id",),
                         ("name", "job_level", "contact_number", "location_sk"), ("staff_id",)),
    "dim_campaign": ScdSpec("dim_campaign", "campaign_sk", ("campaign_id",),
                            ("campaign_name", "campaign_description", "discount"), ("campaign_id",)),
    "dim_issuing_bank": ScdSpec("dim_issuing_bank", "issuing_bank_sk", ("user_id", "issuing_bank"), (), ("user_id",)),
}
LOCATED = ("dim_user", "dim_merchant", "dim_staff")
STAMPS = {"dim_user": ["ingested_at", "job_ingested_at"]}


def stamps_of(name: str) -> list[str]:
    return STAMPS.get(name, ["ingested_at"])


def snapshots(spark: SparkSession, sf: str, until: str | None = None) -> dict[str, DataFrame]:
    """The dimension snapshots with their stamps, of all batches or of those
    up to ``until``."""
    d = {t: deduped(spark, sf, t, until, keep_stamp=True) for t in
         ["user", "user_job", "merchant", "staff", "product", "campaign", "credit_card"]}
    return {
        "dim_location": S.location_snapshot(d["user"], d["merchant"], d["staff"]),
        "dim_user": S.user_snapshot(d["user"], d["user_job"]),
        "dim_product": S.product_snapshot(d["product"]),
        "dim_merchant": S.merchant_snapshot(d["merchant"]),
        "dim_staff": S.staff_snapshot(d["staff"]),
        "dim_campaign": S.campaign_snapshot(d["campaign"]),
        "dim_issuing_bank": S.issuing_bank_snapshot(d["credit_card"]),
    }


def unique_snapshot(name: str, snapshot: DataFrame, dim_location: DataFrame | None) -> DataFrame:
    """A snapshot's newest row per natural key, without NULL keys, and with
    the key of its address where the dimension tracks it."""
    spec = SCD_SPECS[name]
    rows = scd.without_null_keys(snapshot, spec)
    if name in LOCATED:
        rows = S.with_location_sk(rows, dim_location)
    return scd.one_version_per_key(rows, spec, stamps_of(name))


def _initial(snaps: dict[str, DataFrame], names, load_date: str) -> dict[str, DataFrame]:
    """First loads, each with its unknown member: locations first, as the
    others look their addresses up, then all others together."""
    names, out = list(names), {}
    if "dim_location" in names or set(names) & set(LOCATED):
        spec = SCD_SPECS["dim_location"]
        out["dim_location"] = scd.scd2_initial(unique_snapshot("dim_location", snaps["dim_location"], None), spec, load_date)
    rest = [n for n in names if n != "dim_location"]
    if rest:
        unique = {n: unique_snapshot(n, snaps[n], out.get("dim_location")) for n in rest}
        out |= scd.scd2_initial_many(unique, SCD_SPECS, load_date)
    return {n: scd.with_unknown_member(d, SCD_SPECS[n]) for n, d in out.items()}


def dimensions(spark: SparkSession, sf: str, names=None) -> dict[str, DataFrame]:
    """The dimensions after a first load of all batches (and dim_location
    where another one needs it)."""
    return _initial(snapshots(spark, sf), names or list(SCD_SPECS), LOAD_DATE)


# Daily reload: the first run saw only the first ingest batch; the next run
# sees every batch and applies its snapshot to the dimension built then.
RELOAD_FIRST = ("2024-01-01 00:00:00", "2024-01-02")   # (batches up to, load date)
RELOAD_NEXT = "2024-02-02"


def reloaded_dimension(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Dimension ``name`` after two daily runs: the initial load from the
    first batch, then an SCD2 merge of the full snapshot (changed tracked
    columns expire the old version, new keys get versions, keys that vanish
    from the snapshot stay current). Addresses are looked up in the locations
    of the same day."""
    until, first_day = RELOAD_FIRST
    full = snapshots(spark, sf)
    first = _initial(snapshots(spark, sf, until), [name], first_day)

    def merged(n: str, dim_location: DataFrame | None) -> DataFrame:
        return scd.scd2_merge(first[n], unique_snapshot(n, full[n], dim_location), SCD_SPECS[n], RELOAD_NEXT)

    return merged(name, merged("dim_location", None) if name in LOCATED else None)


def null_key_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Per dimension the snapshot rows kept out for lack of a key, and the
    keys whose newest stamps carry several values."""
    out = None
    for name, snap in snapshots(spark, sf).items():
        spec = SCD_SPECS[name]
        if not spec.required:
            continue
        bad = scd.null_key_rows(snap, spec).agg(F.count(F.lit(1)).cast("bigint").alias("null_key_rows"))
        own = ScdSpec(spec.name, spec.sk, spec.key, tuple(c for c in spec.tracked if c != "location_sk"), spec.required)
        ties = scd.stamp_ties(scd.without_null_keys(snap, spec), own, stamps_of(name)).agg(
            F.count(F.lit(1)).cast("bigint").alias("tied_keys"))
        row = bad.crossJoin(ties).select(F.lit(name).alias("dimension"), "null_key_rows", "tied_keys")
        out = row if out is None else out.unionByName(row)
    return out


ORDER_DIMS = ["dim_user", "dim_merchant", "dim_staff", "dim_campaign"]


def fact_orders(spark: SparkSession, sf: str, dims: dict | None = None) -> DataFrame:
    dims = dims or dimensions(spark, sf, ORDER_DIMS)
    orders = deduped(spark, sf, "order")
    return S.fact_orders(orders, dims["dim_user"], dims["dim_merchant"], dims["dim_staff"], dims["dim_campaign"])


def orders_with_names(spark: SparkSession, sf: str) -> DataFrame:
    """Deduplicated orders carrying the customer and staff names the order
    system recorded (missing for every 29th customer and 23rd staff key)."""
    users = read_table(spark, sf, "customer").select(
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("user_id"),
        F.when(F.col("c_custkey") % 29 != 0, F.col("c_name")).alias("user_name"))
    staff = read_table(spark, sf, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("staff_id"),
        F.when(F.col("s_suppkey") % 23 != 0, F.concat(F.lit("Staff "), F.col("s_suppkey").cast("string")))
        .alias("staff_name"))
    return deduped(spark, sf, "order").join(users, "user_id", "left").join(staff, "staff_id", "left")


def fact_orders_composite_key(spark: SparkSession, sf: str, dims: dict | None = None) -> DataFrame:
    """Order facts whose user and staff keys are found by id AND name: an
    order whose recorded name is missing or differs gets the unknown member 0."""
    dims = dims or dimensions(spark, sf, ORDER_DIMS)
    return S.fact_orders(orders_with_names(spark, sf), dims["dim_user"], dims["dim_merchant"], dims["dim_staff"],
                         dims["dim_campaign"], user_name="user_name", staff_name="staff_name")


def facts(spark: SparkSession, sf: str, dims: dict | None = None) -> tuple[DataFrame, DataFrame]:
    dims = dims or dimensions(spark, sf, [*ORDER_DIMS, "dim_product"])
    fo = fact_orders(spark, sf, dims)
    fli = S.fact_line_items(deduped(spark, sf, "line_item"), fo, dims["dim_product"])
    return fo, fli


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Customer-segment revenue over the star built by the whole chain."""
    dims = dimensions(spark, sf, ["dim_user", "dim_merchant", "dim_staff", "dim_campaign", "dim_product"])
    fo, fli = facts(spark, sf, dims)
    du = scd.current_view(dims["dim_user"])
    lines = fli.select(F.col("order_sk").alias("order_id"), "user_sk", "price", "quantity")
    users = du.select("user_sk", "user_type", "job_level")
    per_order = lines.groupBy("order_id", "user_sk").agg(F.sum(F.col("price") * F.col("quantity")).alias("revenue"))
    return (per_order.join(users, "user_sk")
            .groupBy("user_type", "job_level")
            .agg(F.count_distinct("order_id").cast("bigint").alias("number_of_orders"),
                 F.sum("revenue").cast(A.REVENUE_TYPE).alias("total_revenue"))
            .orderBy(F.desc("total_revenue"), "user_type", "job_level"))
