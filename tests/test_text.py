"""Golden edge rows for the cleaning expressions."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from quillmart.functions import text as T


def one_col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_percent_fraction(spark):
    vals = ["1%", "1pct", "10%%", "5%", "1percent", "10pct", "20pct", "12.5%", "x", None]
    got = one_col(spark, vals, T.percent_fraction)
    want = ["0.01", "0.01", "0.10", "0.05", "0.01", "0.10", "0.20", "0.12", None, None]
    assert got == [None if w is None else Decimal(w) for w in want]


def test_first_int(spark):
    assert one_col(spark, ["3PC", "15days", "none", None], T.first_int) == [3, 15, None, None]


def test_digits_only(spark):
    assert one_col(spark, ["+1 (555) 01-02", "none", ""], T.digits_only) == ["15550102", None, None]


def test_state_name(spark):
    got = one_col(spark, ["AL", " ca ", "Texas", " ", None], T.us_state_name)
    assert got == ["Alabama", "California", "Texas", None, None]


def test_default_country(spark):
    assert one_col(spark, [None, "Philippines"], T.default_country) == ["United States", "Philippines"]


def test_parse_date(spark):
    got = one_col(spark, ["2024-01-05", "2024-02-30", "bad", "03/04/2021", None], T.parse_date)
    assert got == [dt.date(2024, 1, 5), None, None, dt.date(2021, 3, 4), None]


def test_product_type(spark):
    got = one_col(spark, ["home_decor", " Toys ", "N/A", None, "nan"], T.product_type)
    assert got == ["home decor", "toys", "unknown", "unknown", "unknown"]


def test_money(spark):
    assert one_col(spark, ["9.999", "x", " 12.5 "], T.to_money) == [Decimal("10.00"), None, Decimal("12.50")]


def test_title_case(spark):
    got = one_col(spark, ["front-end o'neil mcDONALD", "", None], T.title_case)
    assert got == ["Front-End O'Neil Mcdonald", "Unknown", "Unknown"]


def test_bank_name(spark):
    got = one_col(spark, ["bpi", "  city   savings ", "nan", "", "BDO unibank"], T.bank_name)
    assert got == ["BPI", "City Savings", None, None, "BDO Unibank"]


def test_to_bool(spark):
    assert one_col(spark, ["true", "false", "1.0", None], T.to_bool) == [True, False, None, None]
