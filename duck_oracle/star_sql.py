"""DuckDB SQL for snapshots, SCD2 loads, keys and fact loads.

A chain of common table expressions: deduplicated tables with their stamps,
snapshots, one newest row per natural key, numbered dimensions, facts. A query
selects from the chain; what it does not use is not run.
"""

from __future__ import annotations

from duck_oracle import ORACLE, dedup_sql

ADDRESS = ["street", "city", "state", "country"]
# Dimension: (surrogate key, natural key, tracked columns, key columns that must be given).
DIMS = {
    "dim_location": ("location_sk", ADDRESS, [], []),
    "dim_user": ("user_sk", ["user_id"], ["name", "birthdate", "gender", "device_address", "user_type", "job_title",
                                          "job_level", "location_sk"], ["user_id"]),
    "dim_product": ("product_sk", ["product_id"], ["product_name", "product_type", "price"], ["product_id"]),
    "dim_merchant": ("merchant_sk", ["merchant_id"], ["name", "contact_number", "location_sk"], ["merchant_id"]),
    "dim_staff": ("staff_sk", ["staff_id"], ["name", "job_level", "contact_number", "location_sk"], ["staff_id"]),
    "dim_campaign": ("campaign_sk", ["campaign_id"], ["campaign_name", "campaign_description", "discount"], ["campaign_id"]),
    "dim_issuing_bank": ("issuing_bank_sk", ["user_id", "issuing_bank"], [], ["user_id"]),
}
SNAPSHOT_COLUMNS = {
    "dim_location": ADDRESS,
    "dim_user": ["user_id", "name", "birthdate", "gender", "device_address", "creation_date", "user_type", "job_title",
                 "job_level", *ADDRESS],
    "dim_product": ["product_id", "product_name", "product_type", "price"],
    "dim_merchant": ["merchant_id", "name", "contact_number", "creation_date", *ADDRESS],
    "dim_staff": ["staff_id", "name", "job_level", "contact_number", "creation_date", *ADDRESS],
    "dim_campaign": ["campaign_id", "campaign_name", "campaign_description", "discount"],
    "dim_issuing_bank": ["user_id", "issuing_bank"],
}
SOURCE = {"dim_product": "product", "dim_merchant": "merchant", "dim_staff": "staff", "dim_campaign": "campaign",
          "dim_issuing_bank": "credit_card"}
LOAD_DATE = "2024-03-01"


def nf(cols) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in cols)


def same(a: str, b: str, cols) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


def snapshots(p: str, until: str | None) -> list[str]:
    """Deduplicated tables and snapshots with their stamps, names prefixed."""
    out = [f"{p}{t} AS ({dedup_sql(t, until, keep_stamp=True)})" for t in
           ["user", "user_job", "merchant", "staff", "product", "campaign", "credit_card"]]
    addresses = " UNION ALL ".join(f"SELECT {', '.join(ADDRESS)} FROM {p}{t}" for t in ["user", "merchant", "staff"])
    out.append(f"{p}s_dim_location AS (SELECT * FROM ({addresses}) a WHERE street IS NOT NULL)")
    user = ", ".join({"birthdate": "CAST(u.birthdate AS DATE) AS birthdate", "job_title": "j.job_title",
                      "job_level": "j.job_level"}.get(c, f"u.{c}") for c in SNAPSHOT_COLUMNS["dim_user"])
    out.append(f"""{p}s_dim_user AS (SELECT {user}, u.ingested_at AS at1, j.ingested_at AS at2
        FROM {p}user u LEFT JOIN {p}user_job j ON j.user_id = u.user_id)""")
    out += [f"{p}s_{d} AS (SELECT {', '.join(SNAPSHOT_COLUMNS[d])}, ingested_at AS at1, NULL AS at2 FROM {p}{t})"
            for d, t in SOURCE.items()]
    return out


def newest(p: str, name: str, locations: str) -> str:
    """The newest row per natural key; ties go to the greatest tracked tuple."""
    _, key, tracked, given = DIMS[name]
    if not tracked:
        cond = "".join(f" WHERE {g} IS NOT NULL" for g in given)
        return f"{p}n_{name} AS (SELECT DISTINCT {', '.join(key)} FROM {p}s_{name}{cond})"
    rows = f"SELECT s.* FROM {p}s_{name} s"
    if "location_sk" in tracked:
        rows = f"""SELECT s.*, COALESCE(l.location_sk, 0) AS location_sk FROM {p}s_{name} s
            LEFT JOIN (SELECT * FROM {locations} WHERE is_current AND location_sk > 0) l ON {same('s', 'l', ADDRESS)}"""
    best = ", ".join(f"{c} DESC NULLS LAST" for c in ["at1", "at2", *tracked])
    return f"""{p}n_{name} AS (SELECT {', '.join(key + tracked)} FROM ({rows}) r WHERE {key[0]} IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY {best}) = 1)"""


def first_load(p: str, name: str, day: str) -> str:
    """Numbered in key order, all current, and the unknown member 0."""
    sk, key, tracked, _ = DIMS[name]
    cols = key + tracked
    return f"""{p}{name} AS (
        SELECT row_number() OVER (ORDER BY {nf(cols)}) AS {sk}, {', '.join(cols)}, DATE '{day}' AS valid_from,
               CAST(NULL AS DATE) AS valid_to, TRUE AS is_current FROM {p}n_{name}
        UNION ALL SELECT 0, {', '.join('NULL' for _ in cols)}, DATE '1900-01-01', NULL, TRUE)"""


def loaded(p: str, until: str | None, day: str) -> list[str]:
    out = snapshots(p, until)
    for name in DIMS:
        out += [newest(p, name, f"{p}dim_location"), first_load(p, name, day)]
    return out


def merged(name: str, old: str, new: str, day: str, out: str) -> list[str]:
    """Old versions, expired where a tracked column changed, and a version for
    every new or changed key, numbered after the largest key."""
    sk, key, tracked, _ = DIMS[name]
    return merge_ctes(sk, key, tracked, old, new, day, out)


def merge_ctes(sk, key, tracked, old, new, day, out) -> list[str]:
    cols = key + tracked
    diff = " OR ".join(f"o.{t} IS DISTINCT FROM n.{t}" for t in tracked) or "FALSE"
    return [
        f"{out}_changed AS (SELECT o.{sk} FROM {old} o JOIN {new} n ON {same('o', 'n', key)} WHERE o.is_current AND ({diff}))",
        f"""{out}_fresh AS (SELECT n.* FROM {new} n WHERE NOT EXISTS (
            SELECT 1 FROM {old} o WHERE o.is_current AND {same('o', 'n', key)} AND NOT ({diff})))""",
        f"""{out} AS (
            SELECT {sk}, {', '.join(cols)}, valid_from, CASE WHEN c THEN DATE '{day}' ELSE valid_to END AS valid_to,
                   is_current AND NOT c AS is_current
            FROM (SELECT *, {sk} IN (SELECT {sk} FROM {out}_changed) AS c FROM {old}) o
            UNION ALL SELECT (SELECT max({sk}) FROM {old}) + row_number() OVER (ORDER BY {nf(cols)}), {', '.join(cols)},
                   DATE '{day}', NULL, TRUE FROM {out}_fresh)"""]


def with_(ctes: list[str], query: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + query


FULL = loaded("f_", None, LOAD_DATE)

for _n, _cols in SNAPSHOT_COLUMNS.items():
    ORACLE[f"{_n}_snapshot"] = with_(snapshots("f_", None), f"SELECT {', '.join(_cols)} FROM f_s_{_n}")

ORACLE["surrogate_keys"] = """
SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) AS user_sk FROM customer"""

ORACLE["location_sk_lookup"] = with_(FULL, f"""
SELECT u.user_id, {', '.join('u.' + c for c in ADDRESS)}, COALESCE(max(l.location_sk), 0) AS location_sk
FROM (SELECT row_number() OVER () AS r, * FROM ({dedup_sql('user')}) d) u
LEFT JOIN f_dim_location l ON {same('u', 'l', ADDRESS)} AND l.location_sk > 0 GROUP BY u.r, u.user_id, {', '.join('u.' + c for c in ADDRESS)}""")

ORACLE["scd2_quarantine"] = with_(snapshots("f_", None), " UNION ALL ".join(f"""
SELECT '{n}' AS dimension, (SELECT count(*) FROM f_s_{n} WHERE {given[0]} IS NULL) AS null_key_rows,
       (SELECT count(*) FROM (
          SELECT {', '.join(key)} FROM (SELECT DISTINCT {', '.join([*key, 'at1', 'at2', *[t for t in tracked if t != 'location_sk']])}
                                       FROM f_s_{n} WHERE {given[0]} IS NOT NULL
                                       QUALIFY rank() OVER (PARTITION BY {', '.join(key)} ORDER BY at1 DESC NULLS LAST, at2 DESC NULLS LAST) = 1) x
          GROUP BY {', '.join(key)} HAVING count(*) > 1) t) AS tied_keys"""
    for n, (_, key, tracked, given) in DIMS.items() if given))

# ------------------------------------------------------------------ SCD2
RECIPES = {
    "customer": ("c_custkey", ["c_name", "c_mktsegment", "c_nationkey"], "c_mktsegment"),
    "part": ("p_partkey", ["p_name", "p_type", "p_size"], "p_type"),
    "supplier": ("s_suppkey", ["s_name", "s_nationkey"], "s_name"),
    "nation": ("n_nationkey", ["n_name", "n_regionkey"], "n_name"),
}


def scd_ctes(table: str) -> list[str]:
    key, tracked, ch = RECIPES[table]
    values = ", ".join(f"CASE WHEN {key} % 13 = 0 THEN NULL WHEN {key} % 3 = 0 THEN {ch} || '-X' ELSE {ch} END AS {ch}"
                       if c == ch else c for c in tracked)
    return [f"""cur AS (SELECT row_number() OVER (ORDER BY {key}) AS sk, {', '.join([key, *tracked])},
                DATE '2024-01-01' AS valid_from, CAST(NULL AS DATE) AS valid_to, TRUE AS is_current FROM {table})""",
            f"snap AS (SELECT CASE WHEN {key} % 7 = 3 THEN -{key} ELSE {key} END AS {key}, {values} FROM {table})",
            *merge_ctes("sk", [key], tracked, "cur", "snap", "2024-02-01", "done")]


ORACLE["scd2_initial"] = with_(scd_ctes("customer")[:1], "SELECT * FROM cur")
for _n, _where in {"merge": "TRUE", "expire": "NOT is_current", "insert": "valid_from = DATE '2024-02-01'",
                   "current_view": "is_current"}.items():
    ORACLE[f"scd2_{_n}"] = with_(scd_ctes("customer"), f"SELECT * FROM done WHERE {_where}")
_key, _tracked, _ch = RECIPES["customer"]
ORACLE["scd2_stored_loads"] = with_(scd_ctes("customer") + [
    f"""third AS (SELECT {_key}, {', '.join(f"CASE WHEN {_key} % 5 = 0 THEN 'OTHER' ELSE {c} END AS {c}" if c == _ch else c for c in _tracked)}
        FROM customer)""", *merge_ctes("sk", [_key], _tracked, "done", "third", "2024-03-01", "done3")], "SELECT * FROM done3")
for _tb in ["part", "supplier", "nation"]:
    ORACLE[f"scd2_{_tb}"] = with_(scd_ctes(_tb), "SELECT * FROM done")


def reload_sql(name: str) -> str:
    """First batch on 2024-01-02, all batches on 2024-02-02; addresses are
    looked up in the locations of the same day."""
    ctes = loaded("a_", "2024-01-01 00:00:00", "2024-01-02") + snapshots("b_", None)
    ctes += [newest("b_", "dim_location", "")] + merged("dim_location", "a_dim_location", "b_n_dim_location", "2024-02-02", "places")
    if name == "dim_location":
        return with_(ctes, "SELECT * FROM places")
    ctes += [newest("b_", name, "places")] + merged(name, f"a_{name}", f"b_n_{name}", "2024-02-02", "done")
    return with_(ctes, "SELECT * FROM done")


for _n in DIMS:
    ORACLE[f"scd2_reload_{_n[4:]}"] = reload_sql(_n)

ORACLE["scd2_dimensions"] = with_(FULL, " UNION ALL ".join(
    f"""SELECT '{n}' AS dimension, CAST(count(*) AS BIGINT) AS versions, CAST(count(*) FILTER (WHERE is_current) AS BIGINT)
        AS current_versions, CAST(max({sk}) AS BIGINT) AS max_sk FROM f_{n}""" for n, (sk, _, _, _) in DIMS.items()))

# ------------------------------------------------------------------ facts
# A surrogate key is looked up per id; ids are unique among a dimension's current versions.


def key_of(dim: str, sk: str, natural: str, more: str = "") -> str:
    return f"COALESCE((SELECT max({sk}) FROM f_{dim} d WHERE d.is_current AND d.{natural} = o.{natural}{more}), 0) AS {sk}"


NAMES = """SELECT o.*,
    (SELECT max(c_name) FROM customer WHERE 'U' || c_custkey = o.user_id AND c_custkey % 29 <> 0) AS user_name,
    (SELECT max('Staff ' || s_suppkey) FROM supplier WHERE 'S' || s_suppkey = o.staff_id AND s_suppkey % 23 <> 0) AS staff_name
    FROM orders_clean o"""


def fact_ctes(composite: bool = False) -> list[str]:
    by_name = {"user": " AND d.name = o.user_name", "staff": " AND d.name = o.staff_name"} if composite else {}
    return [*FULL, f"orders_clean AS ({dedup_sql('order')})", f"lines_clean AS ({dedup_sql('line_item')})",
            f"named AS ({NAMES})",
            f"""fo AS (SELECT order_id, {key_of('dim_user', 'user_sk', 'user_id', by_name.get('user', ''))},
                {key_of('dim_merchant', 'merchant_sk', 'merchant_id')},
                {key_of('dim_staff', 'staff_sk', 'staff_id', by_name.get('staff', ''))},
                {key_of('dim_campaign', 'campaign_sk', 'campaign_id')},
                CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS date_sk, estimated_arrival, delay_in_days,
                COALESCE(availed, FALSE) AS campaign_availed FROM {'named' if composite else 'orders_clean'} o)""",
            """numbered AS (SELECT *, row_number() OVER (PARTITION BY order_id
                ORDER BY product_id, price, quantity, product_name) AS line_item_id FROM lines_clean)""",
            f"""fli AS (SELECT o.line_item_id, o.order_id AS order_sk, {key_of('dim_product', 'product_sk', 'product_id')},
                fo.merchant_sk, fo.user_sk, fo.staff_sk, fo.date_sk, o.price, o.quantity
                FROM numbered o JOIN fo ON fo.order_id = o.order_id)"""]


LATER = "date_sk >= 19980101 OR date_sk IS NULL"
ORACLE["fact_orders"] = with_(fact_ctes(), "SELECT * FROM fo")
ORACLE["fact_orders_composite_key"] = with_(fact_ctes(composite=True), "SELECT * FROM fo")
ORACLE["fact_line_items"] = with_(fact_ctes(), "SELECT * FROM fli")
ORACLE["fact_orders_incremental"] = with_(fact_ctes(), f"SELECT * FROM fo WHERE {LATER}")
ORACLE["fact_line_items_incremental"] = with_(fact_ctes(), f"SELECT * FROM fli WHERE {LATER}")
ORACLE["segment_revenue_pipeline"] = with_(fact_ctes(), """
SELECT user_type, job_level, CAST(count(DISTINCT order_sk) AS BIGINT) AS number_of_orders,
       CAST(sum(price * quantity) AS DECIMAL(38,2)) AS total_revenue
FROM fli JOIN f_dim_user u ON u.user_sk = fli.user_sk AND u.is_current GROUP BY ALL""")
