"""Cleaning: leftover index columns, required columns, a product file without prices."""

import pytest

from quillmart.plans import clean


def test_only_a_leading_index_column_is_dropped(spark):
    df = spark.createDataFrame([(0, "a", 5)], "`Unnamed: 0` int, b string, unnamed_late int")
    assert clean.drop_leading_unnamed(df).columns == ["b", "unnamed_late"]
    assert clean.drop_leading_unnamed(df.select("b", "Unnamed: 0")).columns == ["b", "Unnamed: 0"]
    assert clean.drop_all_unnamed(df).columns == ["b"]


def test_missing_required_columns_are_an_error(spark):
    df = spark.createDataFrame([("a", 1)], "campaign_id string, other int")
    with pytest.raises(ValueError, match="campaign_name"):
        clean.clean_campaign(df)
    assert clean.require_columns(df, ["other"]) is df


def test_a_product_file_without_prices(spark):
    df = spark.createDataFrame([(0, "P1", "readymade shoes", "toys")], "unnamed_0 int, product_id string, product_name string, product_type string")
    out = clean.clean_product(df)
    assert out.columns == ["product_id", "product_name", "product_type", "price"]
    assert dict(out.dtypes)["price"] == "decimal(10,2)" and out.first()["price"] is None
    with pytest.raises(ValueError, match="product_name"):
        clean.clean_product(df.drop("product_name"))
