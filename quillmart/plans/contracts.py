"""Column contracts of the cleaned layer: names in order, Spark types, and the
maximum text lengths the staging tables declare (checked, not enforced)."""

from __future__ import annotations

# (column, spark type, max length for text or None)
CLEANED = {
    "campaign": [
        ("campaign_id", "string", 13), ("campaign_name", "string", 60),
        ("campaign_description", "string", 150), ("discount", "decimal(5,4)", None),
    ],
    "line_item": [
        ("order_id", "string", 36), ("price", "decimal(10,2)", None), ("quantity", "int", None),
        ("product_name", "string", 100), ("product_id", "string", 12),
    ],
    "merchant": [
        ("merchant_id", "string", 13), ("creation_date", "date", None), ("name", "string", 40),
        ("street", "string", 40), ("state", "string", 27), ("city", "string", 20),
        ("country", "string", 52), ("contact_number", "string", 20),
    ],
    "order": [
        ("order_id", "string", 36), ("campaign_id", "string", 13), ("user_id", "string", 9),
        ("merchant_id", "string", 13), ("staff_id", "string", 12), ("transaction_date", "date", None),
        ("estimated_arrival", "int", None), ("delay_in_days", "int", None), ("availed", "boolean", None),
    ],
    "product": [
        ("product_id", "string", 12), ("product_name", "string", 100), ("product_type", "string", 50),
        ("price", "decimal(10,2)", None),
    ],
    "staff": [
        ("staff_id", "string", 12), ("name", "string", 40), ("job_level", "string", 20),
        ("street", "string", 40), ("state", "string", 27), ("city", "string", 20),
        ("country", "string", 52), ("contact_number", "string", 20), ("creation_date", "date", None),
    ],
    "credit_card": [
        ("user_id", "string", 9), ("name", "string", 40), ("issuing_bank", "string", 20),
    ],
    "user": [
        ("user_id", "string", 9), ("creation_date", "date", None), ("name", "string", 40),
        ("street", "string", 40), ("state", "string", 27), ("city", "string", 20),
        ("country", "string", 52), ("birthdate", "timestamp_ntz", None), ("gender", "string", 6),
        ("device_address", "string", 17), ("user_type", "string", 8),
    ],
    "user_job": [
        ("user_id", "string", 9), ("name", "string", 40), ("job_title", "string", 20),
        ("job_level", "string", 20),
    ],
}


def columns(table: str) -> list[str]:
    return [c for c, _, _ in CLEANED[table]]


def required(table: str) -> list[str]:
    return columns(table)


# Latest-wins dedup: key, business columns (all but the key).
LATEST_WINS = {
    "campaign": ["campaign_id"],
    "merchant": ["merchant_id"],
    "order": ["order_id"],
    "product": ["product_id"],
}
