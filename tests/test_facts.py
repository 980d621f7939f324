"""Fact loads: unknown member, expired versions, idempotent re-load."""

import datetime as dt
from decimal import Decimal

from quillmart.plans import star as S


def dim(spark, name, key, rows):
    return spark.createDataFrame(rows, f"{key} string, {name}_sk long, is_current boolean")


def orders(spark):
    return spark.createDataFrame([
        ("O1", "U1", "M1", "S1", "C1", dt.date(2024, 1, 5), 3, 1, True),
        ("O2", "U9", "M1", "S1", "C1", dt.date(2024, 1, 6), 3, None, None),
        ("O3", "U2", None, "S1", "C1", None, None, 2, False),
    ], "order_id string, user_id string, merchant_id string, staff_id string, campaign_id string, "
       "transaction_date date, estimated_arrival int, delay_in_days int, availed boolean")


def star(spark):
    return dict(
        dim_user=dim(spark, "user", "user_id", [("U1", 1, True), ("U2", 2, False), ("U2", 3, True)]),
        dim_merchant=dim(spark, "merchant", "merchant_id", [("M1", 1, True)]),
        dim_staff=dim(spark, "staff", "staff_id", [("S1", 1, True)]),
        dim_campaign=dim(spark, "campaign", "campaign_id", [("C1", 5, True)]),
    )


def test_fact_orders(spark):
    fo = {r.order_id: r for r in S.fact_orders(orders(spark), **star(spark)).collect()}
    assert fo["O1"].user_sk == 1 and fo["O1"].date_sk == 20240105 and fo["O1"].campaign_availed is True
    assert fo["O2"].user_sk == 0 and fo["O2"].campaign_availed is False       # unmatched -> 0
    assert fo["O3"].user_sk == 3 and fo["O3"].merchant_sk == 0                # expired version ignored
    assert fo["O3"].date_sk is None


def test_fact_orders_incremental(spark):
    st = star(spark)
    full = S.fact_orders(orders(spark), **st)
    existing = full.where("order_id = 'O1'")
    new = S.fact_orders(orders(spark), **st, existing=existing)
    assert sorted(r.order_id for r in new.collect()) == ["O2", "O3"]
    assert S.fact_orders(orders(spark), **st, existing=full).count() == 0


def test_fact_line_items(spark):
    fo = S.fact_orders(orders(spark), **star(spark))
    li = spark.createDataFrame([
        ("O1", Decimal("5.00"), 2, "b", "P2"), ("O1", Decimal("3.00"), 1, "a", "P1"),
        ("O1", Decimal("1.00"), 1, "a", "P1"), ("OX", Decimal("1.00"), 1, "a", "P1"),
    ], "order_id string, price decimal(10,2), quantity int, product_name string, product_id string")
    dp = spark.createDataFrame([("P1", 10, True)], "product_id string, product_sk long, is_current boolean")
    out = sorted((r.order_sk, r.line_item_id, r.product_sk, str(r.price)) for r in
                 S.fact_line_items(li, fo, dp).collect())
    assert out == [("O1", 1, 10, "1.00"), ("O1", 2, 10, "3.00"), ("O1", 3, 0, "5.00")]  # OX dropped
    existing = S.fact_line_items(li, fo, dp)
    assert S.fact_line_items(li, fo, dp, existing=existing).count() == 0


def test_composite_user_key_needs_id_and_name(spark):
    # J-11: the user is found by id AND name; a missing or different name
    # falls to the unknown member 0 even when the id exists
    du = spark.createDataFrame([("U1", "Ann", 1, True), ("U2", "Bo", 3, True)],
                               "user_id string, name string, user_sk long, is_current boolean")
    o = orders(spark).join(spark.createDataFrame(
        [("O1", "Ann", "Sam"), ("O2", "Cy", "Sam"), ("O3", None, "Tom")],
        "order_id string, user_name string, staff_name string"), "order_id")
    d = star(spark)
    ds = spark.createDataFrame([("S1", "Sam", 4, True)], "staff_id string, name string, staff_sk long, is_current boolean")
    got = {r.order_id: (r.user_sk, r.staff_sk) for r in S.fact_orders(
        o, du, d["dim_merchant"], ds, d["dim_campaign"], user_name="user_name", staff_name="staff_name").collect()}
    assert got == {"O1": (1, 4), "O2": (0, 4), "O3": (0, 0)}


def test_a_fact_with_key_0_finds_its_dimension_row(spark):
    from quillmart.operators import scd
    spec = scd.ScdSpec("dim_user", "user_sk", ("user_id",), ("name",), ("user_id",))
    snap = spark.createDataFrame([("U1", "Ann"), (None, "nobody")], "user_id string, name string")
    dim = scd.with_unknown_member(scd.scd2_initial(scd.without_null_keys(snap, spec), spec, "2024-01-01"), spec)
    assert scd.null_key_rows(snap, spec).count() == 1
    facts = spark.createDataFrame([("O1", 1), ("O2", 0)], "order_id string, user_sk long")
    got = {r.order_id: r.name for r in facts.join(dim, "user_sk").collect()}
    assert got == {"O1": "Ann", "O2": None}
