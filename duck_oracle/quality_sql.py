"""DuckDB SQL for the data-quality reports. The check lists stand here on
their own, so a check that goes missing from the library shows."""

from __future__ import annotations

from collections import namedtuple

from duck_oracle import CONTRACT, ORACLE
from duck_oracle.clean_sql import cleaned_sql
from duck_oracle.star_sql import fact_ctes, with_

Check = namedtuple("Check", "kind column threshold op severity value", defaults=(None, None, None, "critical", None))

MAX_LENGTH = {
    "campaign": {"campaign_id": 13, "campaign_name": 60, "campaign_description": 150},
    "line_item": {"order_id": 36, "product_name": 100, "product_id": 12},
    "merchant": {"merchant_id": 13, "name": 40, "street": 40, "state": 27, "city": 20, "country": 52, "contact_number": 20},
    "order": {"order_id": 36, "campaign_id": 13, "user_id": 9, "merchant_id": 13, "staff_id": 12},
    "product": {"product_id": 12, "product_name": 100, "product_type": 50},
    "staff": {"staff_id": 12, "name": 40, "job_level": 20, "street": 40, "state": 27, "city": 20, "country": 52,
              "contact_number": 20},
    "credit_card": {"user_id": 9, "name": 40, "issuing_bank": 20},
    "user": {"user_id": 9, "name": 40, "street": 40, "state": 27, "city": 20, "country": 52, "gender": 6,
             "device_address": 17, "user_type": 8},
    "user_job": {"user_id": 9, "name": 40, "job_title": 20, "job_level": 20},
}


def info(kind, column=None):
    return Check(kind, column, None, None, "info")


SUITES = {
    "dq_row_count": {t: [Check("rows", None, 0, ">")] for t in MAX_LENGTH},
    "dq_null_counts": {
        "credit_card": [info("nulls", c) for c in ("user_id", "name", "issuing_bank")],
        "user_job": [info("nulls", c) for c in ("user_id", "name", "job_title", "job_level")],
        "user": [info("nulls", c) for c in ("user_id", "creation_date", "name", "street", "state", "city", "country",
                                            "birthdate", "gender", "device_address", "user_type")]},
    "dq_max_length": {t: [Check("max_length", c, n, "<=") for c, n in cols.items()] for t, cols in MAX_LENGTH.items()},
    "dq_business_rules": {t: [Check("all_not_null", f"{t}_id", 1, "=="), Check("nulls", f"{t}_id", 0, "<=")]
                          for t in ("merchant", "staff")},
    "dq_digits_only": {t: [Check("non_digits", "contact_number", 0, "<=")] for t in ("merchant", "staff")},
    "dq_allowed_values": {
        "merchant": [Check("not_value", "country", 0, "<=", value="United States")],
        "staff": [Check("other_value", "country", 0, "<=", value="United States")],
        "user": [Check("not_value", "country", 0, "<=", value="United States")]},
    "dq_missing_ratio": {
        "merchant": [Check("missing_ratio", c, 0.30, "<=") for c in (
            "merchant_id", "creation_date", "name", "street", "state", "city", "country", "contact_number")],
        "staff": [Check("missing_ratio", c, 0.30, "<=") for c in (
            "staff_id", "name", "job_level", "street", "state", "city", "country", "contact_number", "creation_date")]},
    "dq_range": {"campaign": [Check("out_of_range_01", "discount", 0, "<=", "info")]},
    "dq_nonnegative": {"product": [Check("negative", "price", 0, "<=")]},
    "dq_order_thresholds": {"order": [
        Check("rows", None, 0, ">"), Check("null_ratio", "merchant_id", 0.10, "<="), info("nulls", "estimated_arrival"),
        info("nulls", "delay_in_days"), Check("null_ratio", "transaction_date", 0.05, "<=")]},
    "dq_bank_pattern": {"credit_card": [Check("has_digits", "issuing_bank", 0, "<=", "info")]},
    "dq_state_coverage": {"user": [info("rows"), info("non_null", "state"), info("nulls", "state")]},
}
DUPLICATE_KEYS = {"merchant": (["merchant_id"], "critical"), "staff": (["staff_id"], "critical"),
                  "credit_card": (["user_id"], "info")}
SURPLUS = {"user": "user_id", "user_job": "user_id"}


def lit(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def obs(ch) -> str:
    c, k = ch.column, ch.kind
    return {
        "rows": "COUNT(*)",
        "nulls": f"COUNT(*) FILTER (WHERE {c} IS NULL)",
        "non_null": f"COUNT({c})",
        "missing_ratio": f"AVG(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)",
        "null_ratio": f"AVG(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)",
        "max_length": f"COALESCE(MAX(length({c})), 0)",
        "negative": f"COUNT(*) FILTER (WHERE {c} < 0)",
        "out_of_range_01": f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND NOT ({c} BETWEEN 0 AND 1))",
        "non_digits": f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND NOT regexp_full_match({c}, '[0-9]+'))",
        "not_value": f"COUNT(*) FILTER (WHERE {c} IS NULL OR {c} <> {lit(ch.value)})",
        "other_value": f"COUNT(*) FILTER (WHERE {c} <> {lit(ch.value)})",
        "has_digits": f"COUNT(*) FILTER (WHERE regexp_matches({c}, '[0-9]'))",
        "all_not_null": f"CAST(bool_and({c} IS NOT NULL) AS INTEGER)",
    }[k]


def check_row(table: str, src: str, ch) -> str:
    o = f"CAST(({obs(ch)}) AS DOUBLE)"
    if ch.op is None or ch.threshold is None:
        passed = "TRUE"
    else:
        op = "=" if ch.op == "==" else ch.op
        passed = f"COALESCE({o} {op} {float(ch.threshold)}, TRUE)"
    return (f"SELECT '{table}' AS table_name, '{ch.kind}' AS check_name, CAST({lit(ch.column)} AS VARCHAR) AS "
            f"column_name, {o} AS observed, CAST({lit(ch.threshold)} AS DOUBLE) AS threshold, {passed} AS passed, "
            f"'{ch.severity}' AS severity FROM {src} s")


def suite_sql(name: str) -> str:
    return "\nUNION ALL\n".join(check_row(t, cleaned_sql(t), ch)
                                for t, checks in SUITES[name].items() for ch in checks)


for _n in SUITES:
    ORACLE[_n] = suite_sql(_n)


def dup_keys_sql(table: str, src: str, keys: list[str], severity: str, thr=0) -> str:
    ks = ", ".join(keys)
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    passed = "TRUE" if thr is None else f"observed <= {float(thr)}"
    return f"""SELECT '{table}' AS table_name, 'duplicate_keys' AS check_name, '{','.join(keys)}' AS column_name,
        observed, CAST({lit(thr)} AS DOUBLE) AS threshold, {passed} AS passed, '{severity}' AS severity
        FROM (SELECT CAST(COUNT(*) FILTER (WHERE n > 1) AS DOUBLE) AS observed
              FROM (SELECT {ks}, COUNT(*) AS n FROM {src} s WHERE {nn} GROUP BY {ks}) g) x"""


ORACLE["dq_duplicate_keys"] = "\nUNION ALL\n".join(
    dup_keys_sql(t, cleaned_sql(t), k, sev) for t, (k, sev) in DUPLICATE_KEYS.items())


def surplus_sql(table: str, key: str) -> str:
    return f"""SELECT '{table}' AS table_name, 'surplus_duplicates' AS check_name, '{key}' AS column_name,
        CAST(COALESCE(SUM(n - 1), 0) AS DOUBLE) AS observed, CAST(NULL AS DOUBLE) AS threshold, TRUE AS passed,
        'info' AS severity FROM (SELECT {key}, COUNT(*) AS n FROM {cleaned_sql(table)} s GROUP BY {key}) g"""


ORACLE["dq_surplus_duplicates"] = "\nUNION ALL\n".join(surplus_sql(t, k) for t, k in SURPLUS.items())


def _reconcile() -> str:
    from duck_oracle.clean_sql import RAW_OF
    from quillmart.plans.standins import raw_table_sql
    return " UNION ALL ".join(f"""SELECT '{r}' AS table_name, COUNT(*) AS source_rows, COUNT(*) AS target_rows,
        TRUE AS matched FROM {raw_table_sql(r)} r""" for r in RAW_OF.values())


ORACLE["dq_row_reconcile"] = _reconcile()

STAR_CTES = [*fact_ctes(), f"cal AS ({ORACLE['dim_date']})"]
KEYS = {"f_dim_location": ["location_sk"], "f_dim_user": ["user_sk"], "f_dim_product": ["product_sk"],
        "f_dim_merchant": ["merchant_sk"], "f_dim_staff": ["staff_sk"], "f_dim_campaign": ["campaign_sk"],
        "f_dim_issuing_bank": ["issuing_bank_sk"], "cal": ["date_sk"], "fo": ["order_id"], "fli": ["order_sk", "line_item_id"]}
NATURAL = {"f_dim_user": ["user_id"], "f_dim_product": ["product_id"], "f_dim_merchant": ["merchant_id"],
           "f_dim_staff": ["staff_id"], "f_dim_campaign": ["campaign_id"]}


def table_name(t: str) -> str:
    return {"cal": "dim_date", "fo": "fact_orders", "fli": "fact_line_items"}.get(t, t[2:])


ORACLE["dq_primary_key"] = with_(STAR_CTES, "\nUNION ALL\n".join(
    [dup_keys_sql(table_name(t), t, k, "critical") for t, k in KEYS.items()]
    + [dup_keys_sql(table_name(t), f"(SELECT * FROM {t} WHERE is_current)", k, "critical") for t, k in NATURAL.items()]))

REFERENCES = [
    ("f_dim_user", "location_sk", "f_dim_location", "location_sk"), ("f_dim_issuing_bank", "user_id", "f_dim_user", "user_id"),
    ("f_dim_merchant", "location_sk", "f_dim_location", "location_sk"), ("f_dim_staff", "location_sk", "f_dim_location", "location_sk"),
    ("fo", "user_sk", "f_dim_user", "user_sk"), ("fo", "merchant_sk", "f_dim_merchant", "merchant_sk"),
    ("fo", "staff_sk", "f_dim_staff", "staff_sk"), ("fo", "campaign_sk", "f_dim_campaign", "campaign_sk"),
    ("fo", "date_sk", "cal", "date_sk"), ("fli", "order_sk", "fo", "order_id"), ("fli", "product_sk", "f_dim_product", "product_sk"),
    ("fli", "merchant_sk", "f_dim_merchant", "merchant_sk"), ("fli", "user_sk", "f_dim_user", "user_sk"), ("fli", "date_sk", "cal", "date_sk")]


def _reference_rows() -> list[str]:
    out = []
    for t, c, other, key in REFERENCES:
        name = table_name(t)
        out.append(f"""SELECT '{name}' AS table_name, 'orphans' AS check_name, '{c}' AS column_name, CAST(count(*) AS DOUBLE) AS observed,
            CAST(0 AS DOUBLE) AS threshold, count(*) <= 0 AS passed, 'critical' AS severity
            FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {key} FROM {other} WHERE {key} IS NOT NULL)""")
        if c not in ("date_sk", "order_sk", "user_id"):
            out.append(f"""SELECT '{name}', 'zero_refs', '{c}', CAST(count(*) AS DOUBLE), NULL, TRUE, 'info' FROM {t} WHERE {c} = 0""")
    return out


ORACLE["dq_foreign_keys"] = with_(STAR_CTES, "\nUNION ALL\n".join(_reference_rows()))

TYPES = {"discount": "DECIMAL(5,4)", "price": "DECIMAL(10,2)", "quantity": "INTEGER", "creation_date": "DATE", "transaction_date": "DATE",
         "estimated_arrival": "INTEGER", "delay_in_days": "INTEGER", "availed": "BOOLEAN", "birthdate": "TIMESTAMP"}
ORACLE["dq_schema_contract"] = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, {i + 1} AS ordinal, '{c}' AS column_name, count(*) AS rows,
        count(*) FILTER (WHERE {c} IS NULL) AS missing,
        count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST(CAST({c} AS VARCHAR) AS {TYPES.get(c, 'VARCHAR')}) IS NULL) AS other_type
        FROM {cleaned_sql(t)} s""" for t, cols in CONTRACT.items() for i, c in enumerate(cols))


def _full() -> str:
    parts = [check_row(t, cleaned_sql(t), ch) for suite in SUITES.values() for t, checks in suite.items() for ch in checks]
    parts.append(ORACLE["dq_duplicate_keys"])
    parts.append(ORACLE["dq_surplus_duplicates"])
    return "\nUNION ALL\n".join(parts)


ORACLE["dq_verdict"] = f"""
SELECT table_name, CAST(COUNT(*) AS BIGINT) AS checks,
       CAST(COUNT(*) FILTER (WHERE severity = 'critical' AND NOT passed) AS BIGINT) AS critical_failed,
       CAST(COUNT(*) FILTER (WHERE severity <> 'critical' AND NOT passed) AS BIGINT) AS info_failed,
       bool_and(severity <> 'critical' OR passed) AS table_passed
FROM ({_full()}) r GROUP BY table_name"""

# The stored tables: declared lengths and Spark's type names; of the broken copy what is stored.
LENGTHS = {
    "campaign": {"campaign_id": 13, "campaign_name": 60, "campaign_description": 150}, "product": {"product_id": 12, "product_name": 100, "product_type": 50},
    "line_item": {"order_id": 36, "product_name": 100, "product_id": 12},
    "merchant": {"merchant_id": 13, "name": 40, "street": 40, "state": 27, "city": 20, "country": 52, "contact_number": 20},
    "order": {"order_id": 36, "campaign_id": 13, "user_id": 9, "merchant_id": 13, "staff_id": 12},
    "staff": {"staff_id": 12, "name": 40, "job_level": 20, "street": 40, "state": 27, "city": 20, "country": 52, "contact_number": 20},
    "credit_card": {"user_id": 9, "name": 40, "issuing_bank": 20}, "user_job": {"user_id": 9, "name": 40, "job_title": 20, "job_level": 20},
    "user": {"user_id": 9, "name": 40, "street": 40, "state": 27, "city": 20, "country": 52, "gender": 6, "device_address": 17, "user_type": 8}}
SPARK_TYPE = {"DECIMAL(5,4)": "decimal(5,4)", "DECIMAL(10,2)": "decimal(10,2)", "INTEGER": "int", "DATE": "date", "BOOLEAN": "boolean",
              "TIMESTAMP": "timestamp_ntz"}
STORED_BROKEN = {"product_id": (2, "string"), "product_name": (1, "string"), "price": (3, "decimal(6,1)")}


def _stored(table: str, i: int, c: str, place: int, kind: str | None, name: str) -> str:
    expected = SPARK_TYPE.get(TYPES.get(c), "string")
    longest = f"coalesce(max(length({c})), 0)" if kind == "string" else "CAST(NULL AS BIGINT)"
    fits = f"{longest} <= {LENGTHS[table][c]}" if kind == "string" else "TRUE"
    return f"""SELECT '{name}' AS table_name, '{c}' AS column_name, {i + 1} AS expected_ordinal, {place} AS ordinal, '{expected}' AS expected_type,
        {f"'{kind}'" if kind else 'CAST(NULL AS VARCHAR)'} AS type, count(*) AS rows,
        {f"count(*) FILTER (WHERE {c} IS NULL)" if kind else 'CAST(NULL AS BIGINT)'} AS missing, {longest} AS longest,
        {str(place == i + 1 and kind == expected).upper()} AND {fits} AS passed FROM {cleaned_sql(table)} s"""


ORACLE["dq_stored_contract"] = " UNION ALL ".join(
    [_stored(t, i, c, i + 1, SPARK_TYPE.get(TYPES.get(c), "string"), t) for t, cols in CONTRACT.items() for i, c in enumerate(cols)]
    + [_stored("product", i, c, *STORED_BROKEN.get(c, (0, None)), "product_broken") for i, c in enumerate(CONTRACT["product"])])

ORACLE["dq_unnamed_columns"] = """
SELECT 'raw_customer' AS table_name, 'unnamed_columns' AS check_name, 'unnamed_0,unnamed_extra' AS column_name,
       CAST((count(c_custkey) > 0)::INT + (count(c_nationkey) > 0)::INT AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS threshold,
       count(c_custkey) = 0 AND count(c_nationkey) = 0 AS passed, 'critical' AS severity FROM customer
UNION ALL SELECT 'customer', 'unnamed_columns', NULL, 0, 0, TRUE, 'critical' FROM (SELECT count(*) FROM customer) c"""
