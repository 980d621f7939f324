"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each reads the driver tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.operators import dedup as D
from quillmart.plans import analytics as A
from quillmart.plans import clean as C
from quillmart.plans import contracts
from quillmart.plans import star as S
from quillmart.plans.standins import raw_table
from quillmart.session import run_folder
from quillmart.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def tbl(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def cleaned(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return C.CLEANERS[table](raw_table(spark, sf, C.RAW_OF[table]))


def deduped(spark: SparkSession, sf: str, table: str, until: str | None = None,
            keep_stamp: bool = False) -> DataFrame:
    """Cleaned and deduplicated table; with ``until``, only the batches
    ingested up to that stamp (the state of an earlier daily run); with
    ``keep_stamp``, the newest stamp of each row."""
    df = cleaned(spark, sf, table)
    if until is not None:
        df = df.where(F.col("ingested_at") <= F.lit(until).cast("timestamp_ntz"))
    cols = contracts.columns(table)
    if table in contracts.LATEST_WINS:
        keys = contracts.LATEST_WINS[table]
        return D.latest_wins(df, keys, [c for c in cols if c not in keys], "ingested_at", keep_stamp)
    if table == "line_item":
        return D.exact_rows_no_nulls(df, cols, "ingested_at")
    return D.exact_rows(df, cols, "ingested_at" if keep_stamp else None)


# ----------------------------------------------------------------- analytics

@query("customer_segment_revenue")
def q_customer_segment_revenue(spark, sf):
    return A.customer_segment_revenue(A.star_order_facts(spark, sf), A.star_dim_user(spark, sf))


@query("campaign_order_volume")
def q_campaign_order_volume(spark, sf):
    return A.campaign_order_volume(A.star_orders(spark, sf), A.star_dim_campaign(spark, sf))


@query("merchant_performance")
def q_merchant_performance(spark, sf):
    return A.merchant_performance(A.star_order_facts(spark, sf), A.star_dim_merchant(spark, sf))


@query("merchant_performance_per_order")
def q_merchant_performance_per_order(spark, sf):
    return A.merchant_performance_per_order(A.star_order_facts(spark, sf), A.star_dim_merchant(spark, sf))


# ------------------------------------------------------------------ calendar

@query("dim_date")
def q_dim_date(spark, sf):
    """Calendar spanning the order dates."""
    return S.dim_date_spanning(tbl(spark, sf, "orders"), "o_orderdate")


@query("dim_date_default_usage")
def q_dim_date_default_usage(spark, sf):
    """The default calendar (2020-2030) with the users and merchants created on
    each day."""
    created = [cleaned(spark, sf, t).select("creation_date").where("creation_date IS NOT NULL") for t in ("user", "merchant")]
    return S.rows_per_day(S.dim_date(spark), created[0].unionAll(created[1]), "creation_date", "created")


# ------------------------------------------------------------------ cleaning

for _t in C.CLEANERS:
    def _mk(t):
        return lambda spark, sf: cleaned(spark, sf, t)
    QUERIES[f"clean_{_t}"] = _mk(_t)


# ------------------------------------------------------------------- dedup

for _t in ["campaign", "merchant", "order", "product", "line_item", "staff", "user", "user_job", "credit_card"]:
    def _mkd(t):
        return lambda spark, sf: deduped(spark, sf, t)
    QUERIES[f"dedup_{_t}"] = _mkd(_t)


@query("dedup_latest_window")
def q_dedup_latest_window(spark, sf):
    """Window form on lineitem (key l_orderkey, stamp l_shipdate): the newest
    stamp per order and how many lines share it."""
    ranked = D.ranked_stamps(tbl(spark, sf, "lineitem"), ["l_orderkey"], "l_shipdate")
    return ranked.where("stamp_rank = 1").select("l_orderkey", "l_shipdate", "rows_at_stamp")


@query("dedup_conflict_stats")
def q_dedup_conflict_stats(spark, sf):
    li = tbl(spark, sf, "lineitem")
    return D.conflict_stats(li, ["l_orderkey"], ["l_partkey", "l_suppkey", "l_quantity"], "l_shipdate") \
        .select("l_orderkey", "l_shipdate", "rows_at_stamp", "distinct_rows")


@query("dedup_lineitem_latest")
def q_dedup_lineitem_latest(spark, sf):
    """Latest-wins on the driver's lineitem: key (l_orderkey, l_linenumber),
    stamp l_shipdate — natural conflicts exist in the data."""
    li = tbl(spark, sf, "lineitem")
    return D.latest_wins(li, ["l_orderkey", "l_linenumber"],
                         ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"], "l_shipdate")


# ------------------------------------------------------ snapshots, SCD2, keys

def _pipeline():
    from quillmart.plans import pipeline
    return pipeline


for _d in ["dim_location", "dim_user", "dim_product", "dim_merchant", "dim_staff", "dim_campaign",
           "dim_issuing_bank"]:
    def _mks(d):
        return lambda spark, sf: _pipeline().snapshots(spark, sf)[d].drop("ingested_at", "job_ingested_at")
    QUERIES[f"{_d}_snapshot"] = _mks(_d)


@query("surrogate_keys")
def q_surrogate_keys(spark, sf):
    from quillmart.operators.keys import surrogate_keys
    c = tbl(spark, sf, "customer").select("c_custkey", "c_name")
    return surrogate_keys(c, ["c_custkey"], "user_sk")


@query("location_sk_lookup")
def q_location_sk_lookup(spark, sf):
    """Users get the surrogate key of their address (4-column NULL-safe
    match against the location dimension; 0 when not found)."""
    loc = _pipeline().dimensions(spark, sf, ["dim_location"])["dim_location"]
    return S.with_location_sk(deduped(spark, sf, "user").select("user_id", *S.ADDRESS), loc)


@query("scd2_quarantine")
def q_scd2_quarantine(spark, sf):
    return _pipeline().null_key_quarantine(spark, sf)


# SCD2 recipes on driver tables: version 1 = the whole table, loaded
# 2024-01-01; snapshot 2 = the whole table again, loaded 2024-02-01, with a
# column changed (key % 3) or NULLed (key % 13), and the rows of key % 7 = 3
# under new keys (negative ones): their old keys vanish, the new ones appear.
SCD_RECIPES = {
    "customer": ("c_custkey", ["c_name", "c_mktsegment", "c_nationkey"], "c_mktsegment"),
    "part": ("p_partkey", ["p_name", "p_type", "p_size"], "p_type"),
    "supplier": ("s_suppkey", ["s_name", "s_nationkey"], "s_name"),
    "nation": ("n_nationkey", ["n_name", "n_regionkey"], "n_name"),
}


def scd_inputs(spark, sf, table):
    from quillmart.operators.scd import ScdSpec
    key, tracked, ch = SCD_RECIPES[table]
    src = tbl(spark, sf, table).select(key, *tracked)
    k = F.col(key)
    chv = F.when(k % 13 == 0, F.lit(None)).when(k % 3 == 0, F.concat(F.col(ch), F.lit("-X"))).otherwise(F.col(ch))
    snap = src.withColumn(ch, chv).withColumn(key, F.when(k % 7 == 3, -k).otherwise(k))
    return src, snap, ScdSpec(f"dim_{table}", "sk", (key,), tuple(tracked))


def scd_merged(spark, sf, table):
    from quillmart.operators import scd
    v1, snap, spec = scd_inputs(spark, sf, table)
    cur = scd.scd2_initial(v1, spec, "2024-01-01")
    return scd.scd2_merge(cur, snap, spec, "2024-02-01")


@query("scd2_initial")
def q_scd2_initial(spark, sf):
    from quillmart.operators import scd
    v1, _, spec = scd_inputs(spark, sf, "customer")
    return scd.scd2_initial(v1, spec, "2024-01-01")


@query("scd2_merge")
def q_scd2_merge(spark, sf):
    return scd_merged(spark, sf, "customer")


@query("scd2_expire")
def q_scd2_expire(spark, sf):
    m = scd_merged(spark, sf, "customer")
    return m.where(~F.col("is_current"))


@query("scd2_insert")
def q_scd2_insert(spark, sf):
    m = scd_merged(spark, sf, "customer")
    return m.where(F.col("valid_from") == F.lit("2024-02-01").cast("date"))


@query("scd2_current_view")
def q_scd2_current_view(spark, sf):
    from quillmart.operators import scd
    return scd.current_view(scd_merged(spark, sf, "customer"))


for _tb in ["part", "supplier", "nation"]:
    def _mkscd(t):
        return lambda spark, sf: scd_merged(spark, sf, t)
    QUERIES[f"scd2_{_tb}"] = _mkscd(_tb)


for _d in ["location", "user", "product", "merchant", "staff", "campaign", "issuing_bank"]:
    def _mkr(d):
        return lambda spark, sf: _pipeline().reloaded_dimension(spark, sf, f"dim_{d}")
    QUERIES[f"scd2_reload_{_d}"] = _mkr(_d)


@query("scd2_dimensions")
def q_scd2_dimensions(spark, sf):
    """Row and current-version counts of the seven pipeline dimensions."""
    p = _pipeline()
    dims = p.dimensions(spark, sf)
    out = None
    for n, d in dims.items():
        r = d.agg(F.lit(n).alias("dimension"), F.count(F.lit(1)).cast("bigint").alias("versions"),
                  F.count_if(F.col("is_current")).cast("bigint").alias("current_versions"),
                  F.max(p.SCD_SPECS[n].sk).cast("bigint").alias("max_sk"))
        out = r if out is None else out.unionByName(r)
    return out


@query("scd2_stored_loads")
def q_scd2_stored_loads(spark, sf):
    """The customer dimension on disk after three loads: the table, the second
    snapshot of the recipe, and the table again with some segments renamed."""
    from quillmart.operators.stored_scd import StoredDimension
    v1, snap, spec = scd_inputs(spark, sf, "customer")
    third = v1.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, F.lit("OTHER")).otherwise(F.col("c_mktsegment")))
    dim = StoredDimension(spark, run_folder(spark, "dim_customer"), spec, buckets=16)
    for day, rows in (("2024-01-01", v1), ("2024-02-01", snap), ("2024-03-01", third)):
        dim.load(rows, day)
    return dim.all_versions()


# -------------------------------------------------------------------- facts

@query("fact_orders")
def q_fact_orders(spark, sf):
    return _pipeline().fact_orders(spark, sf)


@query("fact_line_items")
def q_fact_line_items(spark, sf):
    _, fli = _pipeline().facts(spark, sf)
    return fli


@query("fact_orders_composite_key")
def q_fact_orders_composite_key(spark, sf):
    return _pipeline().fact_orders_composite_key(spark, sf)


@query("fact_orders_incremental")
def q_fact_orders_incremental(spark, sf):
    """Second load: orders dated before 1998 are in the stored fact table; only
    the others are appended (anti join on the order ids of the files that may
    hold one of them)."""
    from quillmart.sources.stored_fact import StoredFact
    p = _pipeline()
    dims = p.dimensions(spark, sf, p.ORDER_DIMS)
    base, chosen = run_folder(spark, "fact"), [dims[n] for n in p.ORDER_DIMS]
    deduped(spark, sf, "order").write.parquet(f"{base}/orders")  # read by both loads and the comparison
    orders = spark.read.parquet(f"{base}/orders")
    fact = StoredFact(spark, f"{base}/fact_orders", "order_id")
    fact.load(S.fact_orders(orders, *chosen).where("date_sk < 19980101"), "truncate")
    return S.fact_orders(orders, *chosen, existing=fact.loaded(orders.select("order_id"), ["order_id"]))


@query("fact_line_items_incremental")
def q_fact_line_items_incremental(spark, sf):
    """Second load: lines of orders dated before 1998 are in the stored fact
    table; only the other (order, line) pairs are appended (anti join with the
    files that may hold one of the orders). The facts are cut once and written
    beside the table, for both loads and the comparison."""
    from quillmart.sources.stored_fact import StoredFact
    p = _pipeline()
    _, lines = p.facts(spark, sf, p.dimensions(spark, sf, [*p.ORDER_DIMS, "dim_product"]))
    base = run_folder(spark, "fact")
    lines.write.parquet(f"{base}/cut")
    lines = spark.read.parquet(f"{base}/cut")
    fact = StoredFact(spark, f"{base}/fact_line_items", "order_sk")
    fact.load(lines.where("date_sk < 19980101"), "truncate")
    return S.not_loaded(lines, fact.loaded(lines.select("order_sk"), ["order_sk", "line_item_id"]))


@query("segment_revenue_pipeline")
def q_segment_revenue_pipeline(spark, sf):
    return _pipeline().flagship(spark, sf)


# ------------------------------------------------------------------- merges

def _merges():
    from quillmart.plans import merges
    return merges


@query("broadcast_index_join")
def q_broadcast_index_join(spark, sf):
    m = _merges()
    prices, products = m.line_item_files(spark, sf)
    return m.index_join(prices, products)


@query("outer_merge_keep_left")
def q_outer_merge_keep_left(spark, sf):
    return _merges().outer_merge_periods(spark, sf)


@query("order_period_union")
def q_order_period_union(spark, sf):
    return _merges().order_period_union(spark, sf)


@query("left_join_keep_left")
def q_left_join_keep_left(spark, sf):
    return _merges().left_join_chain(spark, sf, keep_left=True)


@query("left_join_coalesce")
def q_left_join_coalesce(spark, sf):
    return _merges().left_join_chain(spark, sf, keep_left=False)


# ------------------------------------------------------------ data quality

def _dq():
    from quillmart.plans import quality_suite
    return quality_suite


def _mkdq(n):
    return lambda spark, sf: _dq().run_suite(spark, sf, n)


for _n in ["dq_row_count", "dq_null_counts", "dq_max_length", "dq_business_rules", "dq_digits_only",
           "dq_allowed_values", "dq_missing_ratio", "dq_range", "dq_nonnegative", "dq_order_thresholds",
           "dq_bank_pattern", "dq_state_coverage"]:
    QUERIES[_n] = _mkdq(_n)


@query("dq_duplicate_keys")
def q_dq_duplicate_keys(spark, sf):
    return _dq().duplicate_keys(spark, sf)


@query("dq_surplus_duplicates")
def q_dq_surplus_duplicates(spark, sf):
    return _dq().surplus_duplicates(spark, sf)


@query("dq_row_reconcile")
def q_dq_row_reconcile(spark, sf):
    return _dq().row_reconcile(spark, sf)


def star_tables(spark, sf) -> dict[str, DataFrame]:
    """All ten tables of the star."""
    p = _pipeline()
    dims = p.dimensions(spark, sf)
    # Both facts are read for several checks: cut once.
    fo = p.fact_orders(spark, sf, dims).checkpoint()
    fli = S.fact_line_items(deduped(spark, sf, "line_item"), fo, dims["dim_product"]).checkpoint()
    return {**dims, "dim_date": S.dim_date_spanning(tbl(spark, sf, "orders"), "o_orderdate"),
            "fact_orders": fo, "fact_line_items": fli}


@query("dq_primary_key")
def q_dq_primary_key(spark, sf):
    p = _pipeline()
    tables = star_tables(spark, sf)
    sks = {n: [s.sk] for n, s in p.SCD_SPECS.items()} | {
        "dim_date": ["date_sk"], "fact_orders": ["order_id"], "fact_line_items": ["order_sk", "line_item_id"]}
    return _dq().primary_keys(tables, sks, {n: s.key for n, s in p.SCD_SPECS.items() if s.required == s.key})


@query("dq_foreign_keys")
def q_dq_foreign_keys(spark, sf):
    return _dq().foreign_keys(star_tables(spark, sf))


@query("dq_verdict")
def q_dq_verdict(spark, sf):
    from quillmart.operators.quality import verdict
    return verdict(_dq().full_report(spark, sf))


@query("dq_schema_contract")
def q_dq_schema_contract(spark, sf):
    """The nine cleaned tables against their column contracts, over the rows."""
    from quillmart.operators.quality import contract_rows, union_reports
    return union_reports([contract_rows(cleaned(spark, sf, t), t, contracts.CLEANED[t]) for t in contracts.CLEANED])


@query("dq_stored_contract")
def q_dq_stored_contract(spark, sf):
    return _dq().stored_contract(spark, sf)


@query("dq_unnamed_columns")
def q_dq_unnamed_columns(spark, sf):
    """Customers exported with two leftover index columns, as read and as
    cleaned: a check row each for columns that begin with ``unnamed``."""
    from quillmart.operators.quality import union_reports, unnamed_columns
    from quillmart.plans.clean import drop_all_unnamed
    from quillmart.sources.files import normalise_index_column
    c = tbl(spark, sf, "customer")
    raw = normalise_index_column(c.select(F.col("c_custkey").alias("Unnamed: 0"), F.col("c_nationkey").alias("unnamed_extra"), "c_name"))
    return union_reports([unnamed_columns(raw, "raw_customer"), unnamed_columns(drop_all_unnamed(raw), "customer")])


# ---------------------------------------------------------- ingest, formats

@query("raw_text_stamp")
def q_raw_text_stamp(spark, sf):
    from quillmart.plans.standins import STAMP1
    from quillmart.sources.files import as_raw
    return as_raw(tbl(spark, sf, "orders"), STAMP1)


MESSY_HEADERS = {"c_custkey": "C Custkey", "c_name": "c-Name!!", "c_nationkey": "  C__NationKey ",
                 "c_acctbal": "C.AcctBal", "c_mktsegment": "C MKT Segment"}


@query("sanitize_columns")
def q_sanitize_columns(spark, sf):
    from quillmart.sources.files import sanitize_columns
    c = tbl(spark, sf, "customer")
    messy = c.select(*[F.col(k).alias(v) for k, v in MESSY_HEADERS.items()])
    return sanitize_columns(messy)


@query("drop_sensitive")
def q_drop_sensitive(spark, sf):
    """Credit-card export with sensitive columns under display names: they
    are caught after sanitising ('CVV' -> 'cvv')."""
    from quillmart.sources.files import drop_sensitive, sanitize_columns
    c = tbl(spark, sf, "customer")
    src = c.select(F.col("c_custkey").alias("User ID"), F.col("c_name").alias("Name"),
                   F.col("c_mktsegment").alias("Issuing Bank"),
                   F.concat(F.lit("4111"), F.lpad(F.col("c_custkey").cast("string"), 12, "0")).alias(
                       "Credit Card Number"),
                   (F.col("c_custkey") % 1000).alias("CVV"))
    return drop_sensitive(sanitize_columns(src))


@query("drop_unnamed")
def q_drop_unnamed(spark, sf):
    from quillmart.plans.clean import drop_all_unnamed
    from quillmart.sources.files import normalise_index_column
    c = tbl(spark, sf, "customer")
    src = c.select(F.col("c_custkey").alias("Unnamed: 0"), F.col("c_nationkey").alias("unnamed_extra"),
                   "c_name", "c_acctbal", "c_mktsegment")
    return drop_all_unnamed(normalise_index_column(src))


@query("row_index_column")
def q_row_index_column(spark, sf):
    """Parquet row position within its file as the ``unnamed_0`` index."""
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return li.select(F.col("_metadata.row_index").alias("unnamed_0"), F.col("_metadata.file_name").alias("file"),
                     "l_orderkey", "l_linenumber")


@query("ingest_audit_upsert")
def q_ingest_audit_upsert(spark, sf):
    """Audit after two ingest runs: run 1 logged the events with value < 50,
    run 2 the rest plus a new table (orders); per (schema, table) the
    newest stamp survives."""
    from quillmart.sources.sinks import audit_entries, audit_upsert
    ev = tbl(spark, sf, "events")
    first = audit_entries(ev.where(F.col("value") < 50), "raw", "event_type", "ts")
    second = audit_entries(ev.where(~(F.col("value") < 50) | F.col("value").isNull()), "raw", "event_type", "ts")
    orders = tbl(spark, sf, "orders").select(F.lit("orders").alias("t"), F.col("o_orderdate").alias("ts"))
    second = second.unionByName(audit_entries(orders, "raw", "t", "ts"))
    return audit_upsert(first, second)


@query("ingest_audit_table")
def q_ingest_audit_table(spark, sf):
    """The same two runs and a third one that repeats the first, committed to
    the stored audit table as three versions."""
    from quillmart.sources.sinks import audit_entries, commit_audit, read_audit
    path = run_folder(spark, "audit")
    ev = tbl(spark, sf, "events")
    orders = tbl(spark, sf, "orders").select(F.lit("orders").alias("t"), F.col("o_orderdate").alias("ts"))
    first = audit_entries(ev.where(F.col("value") < 50), "raw", "event_type", "ts")
    second = audit_entries(ev.where(~(F.col("value") < 50) | F.col("value").isNull()), "raw", "event_type", "ts")
    for entries in (first, second.unionByName(audit_entries(orders, "raw", "t", "ts")), first):
        commit_audit(entries, path)
    return read_audit(spark, path)


@query("raw_append_two_batches")
def q_raw_append_two_batches(spark, sf):
    """Two appends to one raw table; batch 2 brings a new column. Read back
    with schema merging: batch-1 rows have NULL in the new column."""
    from quillmart.plans.standins import STAMP1, STAMP2
    from quillmart.sources.files import as_raw
    from quillmart.sources.sinks import append_raw, read_raw
    path = run_folder(spark, "raw") + "/orders"
    o = tbl(spark, sf, "orders")
    append_raw(as_raw(o.drop("o_orderpriority"), STAMP1), path)
    append_raw(as_raw(o, STAMP2), path)
    return read_raw(spark, path)


@query("dedup_sink")
def q_dedup_sink(spark, sf):
    """Deduplicated orders replace the staging table, twice, and are read back."""
    from quillmart.sources.sinks import overwrite
    path = run_folder(spark, "dedup") + "/order"
    overwrite(cleaned(spark, sf, "order").drop("ingested_at"), path)
    overwrite(deduped(spark, sf, "order"), path)
    return spark.read.parquet(path)


@query("snapshot_sink")
def q_snapshot_sink(spark, sf):
    from quillmart.sources.sinks import overwrite
    path = run_folder(spark, "snapshot") + "/dim_user"
    overwrite(QUERIES["dim_user_snapshot"](spark, sf), path)
    return spark.read.parquet(path)


@query("calendar_sink")
def q_calendar_sink(spark, sf):
    from quillmart.sources.sinks import overwrite
    path = run_folder(spark, "calendar") + "/dim_date"
    overwrite(q_dim_date(spark, sf), path)
    return spark.read.parquet(path)


@query("fact_orders_reload")
def q_fact_orders_reload(spark, sf):
    """Truncate-load of the orders before 1998, then an append of the others
    (those the table does not have): the whole fact table, once."""
    from quillmart.sources.sinks import load_fact
    p, path = _pipeline(), run_folder(spark, "fact") + "/fact_orders"
    dims = p.dimensions(spark, sf, p.ORDER_DIMS)
    cut = run_folder(spark, "orders") + "/order"
    deduped(spark, sf, "order").write.parquet(cut)  # read by both loads
    orders, chosen = spark.read.parquet(cut), [dims[n] for n in p.ORDER_DIMS]
    load_fact(S.fact_orders(orders, *chosen).where("date_sk < 19980101"), path, "truncate")
    load_fact(S.fact_orders(orders, *chosen, existing=spark.read.parquet(path)), path, "append")
    return spark.read.parquet(path)


@query("staging_overwrite")
def q_staging_overwrite(spark, sf):
    """Truncate-and-load twice: the second load fully replaces the first."""
    from quillmart.sources.sinks import overwrite
    path = run_folder(spark, "staging") + "/line_item"
    overwrite(C.clean_line_item(raw_table(spark, sf, "raw_line_item", batches=False)), path)
    overwrite(cleaned(spark, sf, "line_item"), path)
    return spark.read.parquet(path)


@query("preview_sample")
def q_preview_sample(spark, sf):
    """Ordered preview of the deduplicated campaigns (unique key, so the
    first 10 are well defined; the limit is the feature)."""
    return deduped(spark, sf, "campaign").orderBy("campaign_id").limit(10)


def _customer_text(spark, sf):
    c = tbl(spark, sf, "customer")
    return c.select(*[F.col(x).cast("string").alias(x) for x in ["c_custkey", "c_nationkey", "c_acctbal",
                                                                "c_mktsegment"]],
                    F.concat(F.col("c_name"), F.lit(', "'), F.col("c_mktsegment"), F.lit('"')).alias("c_label"))


@query("csv_delimiter_fallback")
def q_csv_delimiter_fallback(spark, sf):
    """The same export written comma-, TAB- (named .csv) and ';'-separated,
    with quoted fields holding commas and doubled quotes; each read back
    with the delimiter fallback."""
    from quillmart.sources.files import read_source
    from quillmart.sources.formats import write_delimited
    base = run_folder(spark, "csv")
    src = _customer_text(spark, sf)
    out = None
    for label, sep in [("comma", ","), ("tab", "\t"), ("semicolon", ";")]:
        p = f"{base}/{label}.csv"
        write_delimited(src, p, sep)
        df = read_source(spark, p).withColumn("source", F.lit(label))
        out = df if out is None else out.unionByName(df)
    return out


JSON_COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("json_column_orient_scan")
def q_json_column_orient_scan(spark, sf):
    """Orders exported as column-oriented JSON documents (1,000 rows each,
    keyed by order key) and as records, each read back into rows."""
    from quillmart.sources.files import read_source
    from quillmart.sources.formats import column_docs
    path = run_folder(spark, "json")
    o = tbl(spark, sf, "orders").withColumn("_chunk", F.floor(F.col("o_orderkey") / 1000))
    column_docs(o, "_chunk", "o_orderkey", JSON_COLUMNS).write.text(f"{path}/columns.json")
    records = o.select(F.col("o_orderkey").alias("unnamed_0"), *JSON_COLUMNS)
    records.select([F.col(c).cast("string") for c in records.columns]).write.json(f"{path}/records.json")
    cols = ["unnamed_0", *JSON_COLUMNS]
    return (read_source(spark, f"{path}/columns.json").select(F.lit("columns").alias("form"), *cols)
            .unionByName(read_source(spark, f"{path}/records.json").select(F.lit("lines").alias("form"), *cols)))


@query("csv_line_breaks")
def q_csv_line_breaks(spark, sf):
    """Customers with line breaks, delimiters and doubled quotes inside fields,
    read back from files that are cut into splits of 16 KB."""
    from quillmart.sources.files import read_source
    from quillmart.sources.formats import write_delimited
    path = run_folder(spark, "csv") + "/customer.csv"
    c = tbl(spark, sf, "customer")
    label = F.concat(F.col("c_name"), F.lit(',\n"'), F.col("c_mktsegment"), F.lit('"\n'), F.col("c_acctbal").cast("string"))
    write_delimited(c.select(F.col("c_custkey").cast("string").alias("c_custkey"), label.alias("c_label"), "c_mktsegment"), path, ",")
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(key, 1 << 14)
    try:
        return read_source(spark, path).checkpoint()
    finally:
        spark.conf.set(key, before)


@query("json_column_layouts")
def q_json_column_layouts(spark, sf):
    """Orders as column-oriented documents on one line each and pretty-printed
    over many lines: both give the same rows."""
    from quillmart.sources.files import read_source
    from quillmart.sources.formats import column_docs
    path = run_folder(spark, "json")
    o = tbl(spark, sf, "orders").withColumn("_chunk", F.floor(F.col("o_orderkey") / 1000))
    out = []
    for form in ("line", "pretty"):
        column_docs(o, "_chunk", "o_orderkey", JSON_COLUMNS, pretty=form == "pretty").write.text(f"{path}/{form}.json")
        out.append(read_source(spark, f"{path}/{form}.json").select(F.lit(form).alias("form"), "unnamed_0", *JSON_COLUMNS))
    return out[0].unionByName(out[1])


HTML_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]


@query("html_table_scan")
def q_html_table_scan(spark, sf):
    """Orders published as HTML pages (500 rows per <table>, with line breaks
    inside the pages and an empty cell in place of status F) and scanned back."""
    from quillmart.sources.files import read_source
    from quillmart.sources.formats import html_pages
    path = run_folder(spark, "html") + "/orders.html"
    o = tbl(spark, sf, "orders").withColumn("_chunk", F.floor(F.col("o_orderkey") / 500))
    o = o.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus")))
    pages = html_pages(o, "_chunk", HTML_COLUMNS)
    pages.select(F.regexp_replace("value", "<tr>", "\n  <tr>").alias("value")).write.text(path)
    return read_source(spark, path)


@query("html_data_frame_scan")
def q_html_data_frame_scan(spark, sf):
    """Orders published the way a data frame exports itself: the row index in
    a header cell of each row, below an empty one; every other page has its
    tags in upper case."""
    from quillmart.sources.files import normalise_index_column, read_source
    from quillmart.sources.formats import html_pages
    path = run_folder(spark, "html") + "/frames.html"
    o = tbl(spark, sf, "orders").withColumn("_chunk", F.floor(F.col("o_orderkey") / 500))
    pages = html_pages(o, "_chunk", HTML_COLUMNS[1:], row_header="o_orderkey").withColumn("n", F.length("value") % 2)
    value = F.col("value")
    for tag in ("html", "body", "table", "tr", "td", "th"):
        for mark in (f"<{tag}", f"</{tag}"):
            value = F.replace(value, F.lit(mark), F.lit(mark.upper()))
    pages.select(F.when(F.col("n") == 0, value).otherwise(F.col("value")).alias("value")).write.text(path)
    return normalise_index_column(read_source(spark, path))


@query("html_hand_written_scan")
def q_html_hand_written_scan(spark, sf):
    """One hand-written page per part: mixed case, end tags left out, nested
    tags and a nested table, a cell over two columns and one over two rows, two
    header rows, and a second table that is not read."""
    from quillmart.sources.files import read_source
    path = run_folder(spark, "html") + "/parts.html"
    p = tbl(spark, sf, "part")
    lit = F.lit
    page = F.concat(
        lit("<HTML>\n<Body><p>1 > 0</p><TABLE border=1>\n<tr><th rowspan=2>key<th colspan=2>part\n<TR><th>name<th><i>type</i>"
            "<tr><td rowspan='2'>"), F.col("p_partkey").cast("string"), lit("<td><b>"), F.col("p_name"), lit("</b>\n<td> "), F.col("p_type"),
        lit("\n<tr><td colspan=2>size <table><tr><td>"), F.col("p_size").cast("string"),
        lit("</td></tr></table></TABLE><table><tr><td>other</table></body></HTML >"))
    p.select(page.alias("value")).write.text(path)
    return read_source(spark, path)


@query("ingest_quarantine")
def q_ingest_quarantine(spark, sf):
    """Exports of the tables with bad records among the good ones: customers as
    CSV with surplus fields and misplaced quotes, orders as JSON lines that
    break off, suppliers as HTML pages some of which have no table, an empty
    export and an unsupported one: rows read, records left out, reasons."""
    from quillmart.sources.files import quarantine_report
    from quillmart.sources.formats import html_pages
    base = run_folder(spark, "quarantine")
    k = F.col("c_custkey")
    bad = F.when(k % 17 == 0, F.concat("c_name", F.lit(",more"))).when(k % 19 == 0, F.concat(F.lit('"'), "c_name", F.lit('"x')))
    customers = tbl(spark, sf, "customer").select(k.cast("string").alias("c_custkey"), bad.otherwise(F.col("c_name")).alias("c_name"))
    customers.write.option("header", True).option("quote", "\u0000").csv(f"{base}/customer.csv")
    orders = tbl(spark, sf, "orders")
    line = F.to_json(F.struct("o_orderkey", "o_orderstatus"))
    orders.select(F.when(F.col("o_orderkey") % 13 == 0, F.substr(line, F.lit(1), F.length(line) - 1)).otherwise(line).alias("value")) \
        .write.text(f"{base}/orders.json")
    s = tbl(spark, sf, "supplier").withColumn("_chunk", F.col("s_suppkey") % 50)
    pages = html_pages(s, "_chunk", ["s_suppkey", "s_name"]).withColumn("first", F.regexp_extract("value", "<td>(\\d+)</td>", 1).cast("int"))
    pages.select(F.when(F.col("first") % 50 % 7 == 0, F.replace("value", F.lit("table"), F.lit("div"))).otherwise(F.col("value")).alias("value")) \
        .write.text(f"{base}/supplier.html")
    tbl(spark, sf, "region").where("false").write.parquet(f"{base}/region.parquet")
    return quarantine_report(spark, {n: f"{base}/{n}" for n in ("customer.csv", "orders.json", "supplier.html", "region.parquet", "nation.xlsx")})


@query("stream_latest_wins")
def q_stream_latest_wins(spark, sf):
    """Latest-wins over a stream: the cleaned orders arrive as files in three
    parts, in no order of their stamps, and are merged into a stored table
    after each arrival; at the end it equals the batch dedup."""
    from quillmart.streaming.latest import LatestTable, ingest_latest
    base = run_folder(spark, "latest")
    cols = contracts.columns("order")
    table = LatestTable(spark, f"{base}/orders", ["order_id"], [c for c in cols if c != "order_id"], "ingested_at", buckets=16)
    rows = cleaned(spark, sf, "order").withColumn("part", F.pmod(F.xxhash64("order_id", "ingested_at"), F.lit(3)))
    for part in range(3):
        rows.where(F.col("part") == part).drop("part").write.mode("append").parquet(f"{base}/arrived")
        ingest_latest(spark, f"{base}/arrived", table, f"{base}/checkpoint")
    return table.read().select(*cols)


@query("incremental_file_ingest")
def q_incremental_file_ingest(spark, sf):
    """Three availableNow runs over a folder: half of the events, then the
    other half arrives, then nothing new: each event is ingested exactly once."""
    from quillmart.streaming.incremental import ingest_once, read_ingested
    base = run_folder(spark, "stream")
    events = tbl(spark, sf, "events")
    for half in (0, 1, None):
        if half is not None:
            events.where(F.pmod("event_id", F.lit(2)) == half).write.mode("append").parquet(f"{base}/landing")
        ingest_once(spark, f"{base}/landing", "*.parquet", f"{base}/raw_events", f"{base}/_checkpoint")
    return read_ingested(spark, f"{base}/raw_events").drop("ingested_at", "source_file")
