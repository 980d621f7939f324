"""The nine cleaning pipelines: raw text table -> typed, normalised table.

Each is one ``select`` of native expressions over the raw table (drop index
columns, check required columns, parse, normalise), so Catalyst fuses the
whole cleaning into the scan's code-generated stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmart.functions import text as T
from quillmart.plans import contracts


def drop_leading_unnamed(df: DataFrame) -> DataFrame:
    """Drop the first column when it is a leftover row index ('unnamed...')."""
    if df.columns and df.columns[0].lower().startswith("unnamed"):
        return df.drop(df.columns[0])
    return df


def drop_all_unnamed(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.lower().startswith("unnamed")])


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def _finish(df: DataFrame, table: str, exprs: dict) -> DataFrame:
    """Project to the contract order, casting to the contract types; an empty
    text is NULL in every text column."""
    out = []
    for c, typ, _ in contracts.CLEANED[table]:
        e = exprs.get(c, F.col(c)).cast(typ)
        out.append((F.nullif(e, F.lit("")) if typ == "string" else e).alias(c))
    if "ingested_at" in df.columns:
        out.append(F.col("ingested_at"))
    return df.select(*out)


def _prepare(df: DataFrame, table: str, all_unnamed: bool = False) -> DataFrame:
    df = drop_all_unnamed(df) if all_unnamed else drop_leading_unnamed(df)
    return require_columns(df, contracts.required(table))


def clean_campaign(df: DataFrame) -> DataFrame:
    df = _prepare(df, "campaign")
    return _finish(df, "campaign", {"discount": T.percent_fraction("discount")})


def clean_line_item(df: DataFrame) -> DataFrame:
    df = _prepare(df, "line_item", all_unnamed=True)
    return _finish(df, "line_item", {
        "price": T.to_money("price", 10, 2),
        "quantity": T.first_int("quantity"),
    })


def _address(prefix: dict | None = None) -> dict:
    return {
        "state": T.us_state_name("state"),
        "country": T.default_country("country"),
    }


def clean_merchant(df: DataFrame) -> DataFrame:
    df = _prepare(df, "merchant")
    return _finish(df, "merchant", {
        "creation_date": T.parse_date("creation_date"),
        "contact_number": T.digits_only("contact_number"),
        **_address(),
    })


def clean_staff(df: DataFrame) -> DataFrame:
    df = _prepare(df, "staff")
    return _finish(df, "staff", {
        "creation_date": T.parse_date("creation_date"),
        "contact_number": T.digits_only("contact_number"),
        **_address(),
    })


def clean_user(df: DataFrame) -> DataFrame:
    df = _prepare(df, "user")
    return _finish(df, "user", {
        "creation_date": T.parse_date("creation_date"),
        "birthdate": T.parse_timestamp("birthdate"),
        **_address(),
    })


def clean_order(df: DataFrame) -> DataFrame:
    df = _prepare(df, "order")
    return _finish(df, "order", {
        "estimated_arrival": T.first_int("estimated_arrival"),
        "delay_in_days": T.first_int("delay_in_days"),
        "transaction_date": T.parse_date("transaction_date"),
        "availed": T.to_bool("availed"),
    })


def clean_product(df: DataFrame) -> DataFrame:
    df = drop_leading_unnamed(df)
    if "price" not in df.columns:  # a product file without prices
        df = df.withColumn("price", F.lit(None).cast("string"))
    df = require_columns(df, contracts.required("product"))
    return _finish(df, "product", {
        "product_type": T.product_type("product_type"),
        "price": T.to_money("price", 10, 2),
    })


def clean_credit_card(df: DataFrame) -> DataFrame:
    df = _prepare(df, "credit_card", all_unnamed=True)
    return _finish(df, "credit_card", {
        "user_id": T.blank_or_nan_to_null("user_id"),
        "name": T.blank_or_nan_to_null("name"),
        "issuing_bank": T.bank_name("issuing_bank"),
    })


def clean_user_job(df: DataFrame) -> DataFrame:
    df = _prepare(df, "user_job")
    return _finish(df, "user_job", {
        "name": T.title_case("name"),
        "job_title": T.title_case("job_title"),
        "job_level": T.title_case("job_level"),
    })


CLEANERS = {
    "campaign": clean_campaign,
    "line_item": clean_line_item,
    "merchant": clean_merchant,
    "order": clean_order,
    "product": clean_product,
    "staff": clean_staff,
    "credit_card": clean_credit_card,
    "user": clean_user,
    "user_job": clean_user_job,
}

RAW_OF = {
    "campaign": "raw_campaign", "line_item": "raw_line_item", "merchant": "raw_merchant",
    "order": "raw_order", "product": "raw_product", "staff": "raw_staff",
    "credit_card": "raw_credit_card", "user": "raw_user", "user_job": "raw_user_job",
}
