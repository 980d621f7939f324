"""The data-quality suites run beside each stage, as report queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.functions.fixed_values import (
    DEFAULT_COUNTRY,
    MAX_FAILED_LOOKUP_RATIO,
    MAX_MISSING_RATIO,
    MAX_UNPARSED_DATE_RATIO,
)
from quillmart.operators import quality as Q
from quillmart.operators.quality import Check
from quillmart.plans import contracts

TABLES = list(contracts.CLEANED)


def _text_cols(t):
    return [(c, n) for c, typ, n in contracts.CLEANED[t] if n is not None]


SUITES: dict[str, dict[str, list[Check]]] = {
    "dq_row_count": {t: [Check("rows", None, 0, ">")] for t in TABLES},
    "dq_null_counts": {
        "credit_card": [Check("nulls", c, None, None, "info") for c in contracts.columns("credit_card")],
        "user_job": [Check("nulls", c, None, None, "info") for c in contracts.columns("user_job")],
        "user": [Check("nulls", c, None, None, "info") for c in contracts.columns("user")],
    },
    "dq_max_length": {t: [Check("max_length", c, n, "<=") for c, n in _text_cols(t)] for t in TABLES},
    "dq_business_rules": {
        "merchant": [Check("all_not_null", "merchant_id", 1, "=="), Check("nulls", "merchant_id", 0, "<=")],
        "staff": [Check("all_not_null", "staff_id", 1, "=="), Check("nulls", "staff_id", 0, "<=")],
    },
    "dq_digits_only": {
        "merchant": [Check("non_digits", "contact_number", 0, "<=")],
        "staff": [Check("non_digits", "contact_number", 0, "<=")],
    },
    "dq_allowed_values": {
        "merchant": [Check("not_value", "country", 0, "<=", value=DEFAULT_COUNTRY)],
        "staff": [Check("other_value", "country", 0, "<=", value=DEFAULT_COUNTRY)],
        "user": [Check("not_value", "country", 0, "<=", value=DEFAULT_COUNTRY)],
    },
    "dq_missing_ratio": {
        "merchant": [Check("missing_ratio", c, MAX_MISSING_RATIO, "<=") for c in contracts.columns("merchant")],
        "staff": [Check("missing_ratio", c, MAX_MISSING_RATIO, "<=") for c in contracts.columns("staff")],
    },
    "dq_range": {"campaign": [Check("out_of_range_01", "discount", 0, "<=", "info")]},
    "dq_nonnegative": {"product": [Check("negative", "price", 0, "<=")]},
    "dq_order_thresholds": {"order": [
        Check("rows", None, 0, ">"),
        Check("null_ratio", "merchant_id", MAX_FAILED_LOOKUP_RATIO, "<="),
        Check("nulls", "estimated_arrival", None, None, "info"),
        Check("nulls", "delay_in_days", None, None, "info"),
        Check("null_ratio", "transaction_date", MAX_UNPARSED_DATE_RATIO, "<="),
    ]},
    "dq_bank_pattern": {"credit_card": [Check("has_digits", "issuing_bank", 0, "<=", "info")]},
    "dq_state_coverage": {"user": [
        Check("rows", None, None, None, "info"), Check("non_null", "state", None, None, "info"),
        Check("nulls", "state", None, None, "info")]},
}

DUPLICATE_KEYS = {"merchant": (["merchant_id"], "critical"), "staff": (["staff_id"], "critical"),
                  "credit_card": (["user_id"], "info")}
SURPLUS = {"user": ["user_id"], "user_job": ["user_id"]}


def run_suite(spark: SparkSession, sf: str, name: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    from quillmart.plans.queries import cleaned
    suite = SUITES[name]
    reps = []
    for t, checks in suite.items():
        df = tables[t] if tables and t in tables else cleaned(spark, sf, t)
        reps.append(Q.run_checks(df, t, checks))
    return Q.union_reports(reps)


def duplicate_keys(spark, sf) -> DataFrame:
    from quillmart.plans.queries import cleaned
    return Q.union_reports([Q.duplicate_keys(cleaned(spark, sf, t), t, k, sev)
                            for t, (k, sev) in DUPLICATE_KEYS.items()])


def surplus_duplicates(spark, sf) -> DataFrame:
    from quillmart.plans.queries import cleaned
    return Q.union_reports([Q.surplus_duplicates(cleaned(spark, sf, t), t, k) for t, k in SURPLUS.items()])


def row_reconcile(spark, sf) -> DataFrame:
    """Per raw table the rows of its source and of the table as ingested:
    each source is appended batch by batch to a raw table in the shared
    folder, and that table is read back and counted. The linked orders, an
    aggregate and a join, are made once for both appends and the count."""
    from quillmart.plans.clean import RAW_OF
    from quillmart.plans.standins import STAMP1, STAMP2, STANDINS, raw_table, source_rows
    from quillmart.session import run_folder
    from quillmart.sources.sinks import append_raw, read_raw
    base, sources, loaded = run_folder(spark, "reconcile"), {}, {}
    linked = f"{base}/orders_linked"
    source_rows(spark, sf, "orders_linked").write.parquet(linked)
    for raw in RAW_OF.values():
        made = spark.read.parquet(linked) if STANDINS[raw].source == "orders_linked" else None
        sources[raw] = src = raw_table(spark, sf, raw, source=made)
        for stamp in (STAMP1, STAMP2):
            append_raw(src.where(F.col("ingested_at") == F.lit(stamp).cast("timestamp_ntz")), f"{base}/{raw}")
        loaded[raw] = read_raw(spark, f"{base}/{raw}")
    return reconcile(sources, loaded)


def reconcile(sources: dict[str, DataFrame], targets: dict[str, DataFrame]) -> DataFrame:
    """Source and target row counts per table, joined on the table name. They
    match if the rows do too: both sides have an order-free fingerprint of all
    rows (the sum and the exclusive or of their hashes, repeated rows included),
    taken in the same pass as the count. Columns are compared by name; one that
    a side lacks is a difference."""
    def counted(frames, name):
        return reduce(DataFrame.unionByName, [_fingerprint(d, t, name) for t, d in frames.items()])
    j = counted(sources, "source").join(counted(targets, "target"), "table_name", "full_outer")
    same = (F.col("source_rows") == F.col("target_rows")) & F.col("source_print").eqNullSafe(F.col("target_print"))
    return j.select("table_name", "source_rows", "target_rows", F.coalesce(same, F.lit(False)).alias("matched"))


def _fingerprint(rows: DataFrame, table: str, name: str) -> DataFrame:
    cells = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000"))) for c in sorted(rows.columns)]
    h = F.xxhash64(*cells)
    return rows.agg(F.count(F.lit(1)).cast("bigint").alias(f"{name}_rows"),
                    F.struct(F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).alias(f"{name}_print")).select(
        F.lit(table).alias("table_name"), f"{name}_rows", f"{name}_print")


def primary_keys(tables: dict[str, DataFrame], sks: dict[str, list[str]], naturals: dict[str, tuple]) -> DataFrame:
    """Declared primary keys of the star's tables, and the natural keys among
    a dimension's current versions."""
    reports = [Q.duplicate_keys(d, n, sks[n]) for n, d in tables.items()]
    reports += [Q.duplicate_keys(tables[n].where("is_current"), n, list(k)) for n, k in naturals.items()]
    return Q.union_reports(reports)


# The star's foreign keys: table, column -> table, column.
FOREIGN_KEYS = [
    ("dim_user", "location_sk", "dim_location", "location_sk"),
    ("dim_issuing_bank", "user_id", "dim_user", "user_id"),
    ("dim_merchant", "location_sk", "dim_location", "location_sk"),
    ("dim_staff", "location_sk", "dim_location", "location_sk"),
    ("fact_orders", "user_sk", "dim_user", "user_sk"),
    ("fact_orders", "merchant_sk", "dim_merchant", "merchant_sk"),
    ("fact_orders", "staff_sk", "dim_staff", "staff_sk"),
    ("fact_orders", "campaign_sk", "dim_campaign", "campaign_sk"),
    ("fact_orders", "date_sk", "dim_date", "date_sk"),
    ("fact_line_items", "order_sk", "fact_orders", "order_id"),
    ("fact_line_items", "product_sk", "dim_product", "product_sk"),
    ("fact_line_items", "merchant_sk", "dim_merchant", "merchant_sk"),
    ("fact_line_items", "user_sk", "dim_user", "user_sk"),
    ("fact_line_items", "date_sk", "dim_date", "date_sk"),
]


def foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Per foreign key the rows whose key is missing from the referenced table
    (NULL refers to nothing), and the rows that refer to the unknown member 0.

    Each table is read once for all its keys: a row becomes one (constraint,
    key) pair per foreign key, counted before the shuffle. The referenced keys
    of all tables are stacked likewise, so one anti join serves all."""
    used, refs = [], []
    for table in dict.fromkeys(t for t, *_ in FOREIGN_KEYS):
        pairs = [F.struct(F.lit(i).alias("i"), F.lit(f"{o}.{k}").alias("ref"), F.col(c).cast("string").alias("key"))
                 for i, (t, c, o, k) in enumerate(FOREIGN_KEYS) if t == table]
        used.append(tables[table].select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where("key IS NOT NULL"))
    for other, key in dict.fromkeys((o, k) for *_, o, k in FOREIGN_KEYS):
        refs.append(tables[other].select(F.lit(f"{other}.{key}").alias("ref"), F.col(key).cast("string").alias("key")))
    counted = reduce(DataFrame.unionByName, used).groupBy("i", "ref", "key").agg(F.count(F.lit(1)).alias("n"))
    known = reduce(DataFrame.unionByName, refs).distinct().withColumn("known", F.lit(True))
    found = counted.join(known, ["ref", "key"], "left").groupBy("i").agg(
        F.sum(F.when(F.col("known").isNull(), F.col("n"))).alias("orphans"), F.sum(F.when(F.col("key") == "0", F.col("n"))).alias("zero_refs"))
    rows = []
    for i, (table, column, *_) in enumerate(FOREIGN_KEYS):
        rows.append((i, table, "orphans", column, 0.0, "critical"))
        if column.endswith("_sk") and column not in ("date_sk", "order_sk"):
            rows.append((i, table, "zero_refs", column, None, "info"))
    checks = tables["fact_orders"].sparkSession.createDataFrame(
        rows, "i int, table_name string, check_name string, column_name string, threshold double, severity string")
    observed = F.coalesce(F.when(F.col("check_name") == "orphans", F.col("orphans")).otherwise(F.col("zero_refs")), F.lit(0)).cast("double")
    return checks.join(found, "i", "left").withColumn("observed", observed).select(
        "table_name", "check_name", "column_name", "observed", "threshold",
        F.coalesce(F.col("observed") <= F.col("threshold"), F.lit(True)).alias("passed"), "severity")


# How the stored contract check breaks a copy of the product table: a column of
# another type and one of another precision, two columns changed places, one is missing.
def broken_products(product: DataFrame) -> DataFrame:
    return product.select("product_name", "product_id", F.col("price").cast("decimal(6,1)").alias("price"))


def stored_contract(spark, sf) -> DataFrame:
    """The nine cleaned tables as they are stored, and a broken copy of one,
    against their contracts."""
    from quillmart.plans.queries import cleaned
    from quillmart.session import run_folder
    from quillmart.sources.sinks import overwrite
    base, reports = run_folder(spark, "contract"), []
    for t in TABLES:
        overwrite(cleaned(spark, sf, t).select(*contracts.columns(t)), f"{base}/{t}")
    overwrite(broken_products(spark.read.parquet(f"{base}/product")), f"{base}/product_broken")
    for t in [*TABLES, "product_broken"]:
        reports.append(Q.stored_contract_rows(spark.read.parquet(f"{base}/{t}"), t, contracts.CLEANED[t.removesuffix("_broken")]))
    return Q.union_reports(reports)


def checks_by_table() -> dict[str, list[Check]]:
    out: dict[str, list[Check]] = {}
    for suite in SUITES.values():
        for t, checks in suite.items():
            out.setdefault(t, []).extend(checks)
    return out


def full_report(spark, sf) -> DataFrame:
    """Every simple check of a table in one aggregate (one scan per table),
    plus the grouped duplicate checks."""
    from quillmart.plans.queries import cleaned
    reps = [Q.run_checks(cleaned(spark, sf, t), t, checks) for t, checks in checks_by_table().items()]
    reps += [duplicate_keys(spark, sf), surplus_duplicates(spark, sf)]
    return Q.union_reports(reps)
