"""Data-quality reports and require()."""

import tempfile

import pytest
from pyspark.sql import functions as F

from quillmart.operators import quality as Q
from quillmart.operators.quality import Check


def test_run_checks_one_aggregate(spark):
    df = spark.createDataFrame([("1", "United States", -1.0), (None, "Canada", 2.0), ("2x", None, None)],
                               "phone string, country string, price double")
    checks = [Check("rows", None, 0, ">"), Check("non_digits", "phone", 0), Check("negative", "price", 0),
              Check("not_value", "country", 0, value="United States"), Check("missing_ratio", "phone", 0.3)]
    rep = Q.run_checks(df, "t", checks)
    plan = rep._jdf.queryExecution().executedPlan().toString()  # before execution: one plan
    assert plan.count("Exchange") <= 1
    got = {r.check_name: (r.observed, r.passed) for r in rep.collect()}
    assert got["rows"] == (3.0, True)
    assert got["non_digits"] == (1.0, False)
    assert got["negative"] == (1.0, False)
    assert got["not_value"] == (2.0, False)          # NULL counts as a violation
    assert got["missing_ratio"][1] is False
    with pytest.raises(AssertionError):
        Q.require(rep)
    v = Q.verdict(rep).collect()[0]
    assert v.critical_failed == 4 and v.table_passed is False


def test_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3), (None, 3)], "k string, v int")
    assert Q.duplicate_keys(df, "t", ["k"]).collect()[0].observed == 1.0
    assert Q.surplus_duplicates(df, "t").collect()[0].observed == 2.0
    assert Q.surplus_duplicates(df.withColumn("v", df.v * 0), "t", ["k"]).collect()[0].observed == 2.0


def test_reports_that_can_fail(spark):
    from quillmart.plans import quality_suite as suite
    good, short = spark.range(5), spark.range(4)
    got = {r.table_name: r.matched for r in suite.reconcile({"a": good, "b": good, "c": good}, {"a": good, "b": short}).collect()}
    assert got == {"a": True, "b": False, "c": False}
    one = spark.createDataFrame([(1, 2, 3)], "location_sk long, user_sk long, user_id long")
    tables = {t: one for t in ("dim_location", "dim_user", "dim_merchant", "dim_staff", "dim_issuing_bank", "dim_campaign", "dim_product")}
    for t, c in {"dim_merchant": "merchant_sk", "dim_staff": "staff_sk", "dim_campaign": "campaign_sk", "dim_product": "product_sk"}.items():
        tables[t] = one.selectExpr("*", f"1L AS {c}")
    tables["dim_date"] = spark.createDataFrame([(20240101,)], "date_sk int")
    tables["fact_orders"] = spark.createDataFrame([("o", 2, 1, 1, 1, 20240101), ("p", 9, 1, 1, 0, None)],
                                                  "order_id string, user_sk long, merchant_sk long, staff_sk long, campaign_sk long, date_sk int")
    tables["fact_line_items"] = spark.createDataFrame([("o", 1, 1, 2, 20240101), ("gone", 1, 1, 2, 20250101)],
                                                      "order_sk string, product_sk long, merchant_sk long, user_sk long, date_sk int")
    rep = {(r.table_name, r.check_name, r.column_name): r.observed for r in suite.foreign_keys(tables).collect()}
    bad = {k for k, v in rep.items() if k[1] == "orphans" and v}
    assert bad == {("fact_orders", "orphans", "user_sk"), ("fact_orders", "orphans", "campaign_sk"),
                   ("fact_line_items", "orphans", "order_sk"), ("fact_line_items", "orphans", "date_sk")}
    assert rep["fact_orders", "zero_refs", "campaign_sk"] == 1 and len([k for k in rep if k[1] == "orphans"]) == 14
    df = spark.createDataFrame([("x", "y"), (None, "z")], "id string, n string")
    got = {r.column_name: (r.rows, r.missing, r.other_type) for r in Q.contract_rows(
        df, "t", [("id", "string", 9), ("n", "int", None), ("absent", "int", None)]).collect()}
    assert got == {"id": (2, 1, 0), "n": (2, 0, 2), "absent": (2, None, None)}
    other = Q.run_checks(spark.createDataFrame([("United States",), (None,), ("Canada",)], "country string"), "t",
                         [Check("other_value", "country", 0, value="United States")])
    assert other.collect()[0].observed == 1.0


def test_reconcile_compares_contents(spark):
    from quillmart.plans import quality_suite as suite
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    same = a.repartition(3).select("v", "k")
    cases = {"same": same, "value": a.replace("x", "y"), "copies": spark.createDataFrame([(1, "x"), (2, None), (2, None)], a.schema),
             "null": a.fillna(""), "column": a.withColumnRenamed("v", "w"), "two_swapped": spark.createDataFrame([(2, "x"), (1, "x"), (1, None)], a.schema)}
    got = {r.table_name: (r.source_rows, r.target_rows, r.matched) for r in suite.reconcile({n: a for n in cases}, cases).collect()}
    assert got == {n: (3, 3, n == "same") for n in cases}


def test_stored_contract_sees_place_type_and_length(spark):
    from quillmart.plans.quality_suite import broken_products
    contract = [("product_id", "string", 3), ("product_name", "string", 9), ("product_type", "string", 5), ("price", "decimal(10,2)", None)]
    df = spark.createDataFrame([("P1", "n", "t", "1.50"), ("P2000", None, "t", None)], "product_id string, product_name string, product_type string, price string")
    df = df.withColumn("price", df.price.cast("decimal(10,2)"))
    got = {r.column_name: (r.ordinal, r.type, r.rows, r.missing, r.longest, r.passed) for r in Q.stored_contract_rows(df, "t", contract).collect()}
    assert got == {"product_id": (1, "string", 2, 0, 5, False), "product_name": (2, "string", 2, 1, 1, True), "product_type": (3, "string", 2, 0, 1, True),
                   "price": (4, "decimal(10,2)", 2, 1, None, True)}
    broken = {r.column_name: (r.ordinal, r.type, r.passed) for r in Q.stored_contract_rows(broken_products(df), "t", contract).collect()}
    assert broken == {"product_id": (2, "string", False), "product_name": (1, "string", False), "product_type": (0, None, False), "price": (3, "decimal(6,1)", False)}


def test_unnamed_columns(spark):
    df = spark.createDataFrame([(1, None, "a")], "`Unnamed: 0` int, unnamed_x string, b string")
    assert Q.unnamed_columns(df, "t").first().asDict() == {"table_name": "t", "check_name": "unnamed_columns", "column_name": "Unnamed: 0,unnamed_x",
                                                           "observed": 1.0, "threshold": 0.0, "passed": False, "severity": "critical"}
    assert Q.unnamed_columns(df.select("b"), "t").first().passed


def test_foreign_keys_read_each_table_once(spark):
    from quillmart.plans import quality_suite as suite
    tables = {}
    for t in dict.fromkeys([t for t, *_ in suite.FOREIGN_KEYS] + [o for *_, o, _ in suite.FOREIGN_KEYS]):
        cols = dict.fromkeys([c for x, c, *_ in suite.FOREIGN_KEYS if x == t] + [k for *_, o, k in suite.FOREIGN_KEYS if o == t])
        path = f"{tempfile.mkdtemp(dir='/tmp')}/{t}"
        spark.range(5).select(*[F.col("id").alias(c) for c in cols]).write.parquet(path)
        tables[t] = spark.read.parquet(path)
    plan = suite.foreign_keys(tables)._jdf.queryExecution().optimizedPlan().toString()
    uses = {t: len({c for x, c, *_ in suite.FOREIGN_KEYS if x == t}) for t in tables}
    assert uses["fact_line_items"] == 5 and plan.count("Relation [") <= sum(1 for t in uses if uses[t]) + 9
    assert suite.foreign_keys(tables).where("check_name = 'orphans' AND NOT passed").count() == 0


def test_reconciliation_makes_the_linked_orders_once(spark, monkeypatch):
    from quillmart.plans import quality_suite, standins
    made, linked = [], standins.orders_linked
    monkeypatch.setattr(standins, "orders_linked", lambda *a: made.append(a) or linked(*a))
    got = {r.table_name: r for r in quality_suite.row_reconcile(spark, "/root/testdata/sf0.001").collect()}
    assert len(made) == 1 and all(r.matched for r in got.values())
    assert got["raw_order"].source_rows == standins.raw_table(spark, "/root/testdata/sf0.001", "raw_order").count()
