"""DuckDB SQL for the cleaning rules, written independently of the Spark
expressions (same documented semantics)."""

from __future__ import annotations

from quillmart.plans.standins import raw_table_sql

# FIXED VALUES, stated here again so that a wrong entry in the library shows.
DEFAULT_COUNTRY = "United States"
NULL_TOKENS = ["", "nan", "none", "null", "n/a", "<na>"]
BANK_ACRONYMS = "BDO BPI PNB DBP RCBC UCPB CHINABANK METROBANK MAYABANK ROBINSONSBANK SECURITYBANK EASTWEST".split()
US_STATES = dict(x.split(" ", 1) for x in """AL Alabama, AK Alaska, AZ Arizona, AR Arkansas, CA California, CO Colorado,
CT Connecticut, DE Delaware, FL Florida, GA Georgia, HI Hawaii, ID Idaho, IL Illinois, IN Indiana, IA Iowa, KS Kansas,
KY Kentucky, LA Louisiana, ME Maine, MD Maryland, MA Massachusetts, MI Michigan, MN Minnesota, MS Mississippi,
MO Missouri, MT Montana, NE Nebraska, NV Nevada, NH New Hampshire, NJ New Jersey, NM New Mexico, NY New York,
NC North Carolina, ND North Dakota, OH Ohio, OK Oklahoma, OR Oregon, PA Pennsylvania, RI Rhode Island, SC South Carolina,
SD South Dakota, TN Tennessee, TX Texas, UT Utah, VT Vermont, VA Virginia, WA Washington, WV West Virginia, WI Wisconsin,
WY Wyoming, DC District of Columbia""".replace("\n", " ").split(", "))


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def blank_to_null(c: str) -> str:
    return f"NULLIF(trim({c}), '')"


def first_int(c: str) -> str:
    return f"TRY_CAST(regexp_extract(CAST({c} AS VARCHAR), '\\d+') AS INTEGER)"


def percent_fraction(c: str) -> str:
    return f"TRY_CAST(CAST({first_int(c)} AS DECIMAL(10,0)) / 100 AS DECIMAL(5,4))"


def digits_only(c: str) -> str:
    return f"NULLIF(regexp_replace({c}, '\\D', '', 'g'), '')"


def state_name(c: str) -> str:
    t = blank_to_null(c)
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in US_STATES.items())
    return f"COALESCE(CASE upper({t}) {whens} END, {t})"


def country(c: str) -> str:
    return f"COALESCE({blank_to_null(c)}, {q(DEFAULT_COUNTRY)})"


DATE_FORMATS = ["%Y-%m-%d", "%m/%d/%Y", "%Y/%m/%d", "%d-%m-%Y"]
TS_FORMATS = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%m/%d/%Y %H:%M:%S", "%Y-%m-%d"]


def parse_date(c: str) -> str:
    t = blank_to_null(c)
    return "COALESCE(" + ", ".join(f"CAST(try_strptime({t}, {q(f)}) AS DATE)" for f in DATE_FORMATS) + ")"


def parse_ts(c: str) -> str:
    t = blank_to_null(c)
    return "COALESCE(" + ", ".join(f"CAST(try_strptime({t}, {q(f)}) AS TIMESTAMP)" for f in TS_FORMATS) + ")"


def product_type(c: str) -> str:
    t = f"lower(trim(replace({c}, '_', ' ')))"
    toks = ", ".join(q(x) for x in NULL_TOKENS)
    return f"(CASE WHEN {c} IS NULL OR {t} IN ({toks}) THEN 'unknown' ELSE {t} END)"


def money(c: str) -> str:
    return f"TRY_CAST(TRY_CAST({blank_to_null(c)} AS DECIMAL(38,10)) AS DECIMAL(10,2))"


def to_bool(c: str) -> str:
    return f"TRY_CAST({blank_to_null(c)} AS BOOLEAN)"


def title_case(c: str) -> str:
    t = f"trim({c})"
    runs = f"regexp_extract_all({t}, '(\\p{{L}}+|[^\\p{{L}}]+)', 1)"
    body = f"array_to_string(list_transform({runs}, lambda w: upper(w[1]) || lower(w[2:])), '')"
    return f"(CASE WHEN {t} IS NULL OR {t} = '' THEN 'Unknown' ELSE {body} END)"


def nan_null(c: str) -> str:
    t = f"trim({c})"
    return f"(CASE WHEN {t} IS NULL OR {t} = '' OR {t} = 'nan' THEN NULL ELSE {t} END)"


def bank(c: str) -> str:
    t = nan_null(c)
    acr = ", ".join(q(a) for a in BANK_ACRONYMS)
    words = f"regexp_split_to_array({t}, '\\s+')"
    fix = f"list_transform({words}, lambda w: CASE WHEN upper(w) IN ({acr}) THEN upper(w) ELSE upper(w[1]) || lower(w[2:]) END)"
    return f"(CASE WHEN {t} IS NULL THEN NULL ELSE array_to_string({fix}, ' ') END)"


CLEAN_SELECT = {
    "campaign": "campaign_id, campaign_name, campaign_description, "
                f"{percent_fraction('discount')} AS discount, ingested_at",
    "line_item": f"order_id, {money('price')} AS price, {first_int('quantity')} AS quantity, "
                 "product_name, product_id, ingested_at",
    "merchant": f"merchant_id, {parse_date('creation_date')} AS creation_date, name, street, "
                f"{state_name('state')} AS state, city, {country('country')} AS country, "
                f"{digits_only('contact_number')} AS contact_number, ingested_at",
    "order": f"order_id, campaign_id, user_id, merchant_id, staff_id, "
             f"{parse_date('transaction_date')} AS transaction_date, "
             f"{first_int('estimated_arrival')} AS estimated_arrival, {first_int('delay_in_days')} AS delay_in_days, "
             f"{to_bool('availed')} AS availed, ingested_at",
    "product": f"product_id, product_name, {product_type('product_type')} AS product_type, "
               f"{money('price')} AS price, ingested_at",
    "staff": f"staff_id, name, job_level, street, {state_name('state')} AS state, city, "
             f"{country('country')} AS country, {digits_only('contact_number')} AS contact_number, "
             f"{parse_date('creation_date')} AS creation_date, ingested_at",
    "credit_card": f"{nan_null('user_id')} AS user_id, {nan_null('name')} AS name, "
                   f"{bank('issuing_bank')} AS issuing_bank, ingested_at",
    "user": f"user_id, {parse_date('creation_date')} AS creation_date, name, street, "
            f"{state_name('state')} AS state, city, {country('country')} AS country, "
            f"{parse_ts('birthdate')} AS birthdate, NULLIF(gender, '') AS gender, device_address, user_type, ingested_at",
    "user_job": f"user_id, {title_case('name')} AS name, {title_case('job_title')} AS job_title, "
                f"{title_case('job_level')} AS job_level, ingested_at",
}

RAW_OF = {
    "campaign": "raw_campaign", "line_item": "raw_line_item", "merchant": "raw_merchant",
    "order": "raw_order", "product": "raw_product", "staff": "raw_staff",
    "credit_card": "raw_credit_card", "user": "raw_user", "user_job": "raw_user_job",
}


def cleaned_sql(table: str) -> str:
    """Sub-query text of the cleaned table."""
    return f"(SELECT {CLEAN_SELECT[table]} FROM {raw_table_sql(RAW_OF[table])} r)"
