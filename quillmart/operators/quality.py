"""Data-quality checks that return report rows instead of printing.

A report row: table_name, check_name, column_name, observed, threshold,
passed, severity. All simple checks on one table run in ONE aggregate (one
scan, no shuffle beyond the final single-row merge) and are unpivoted with
``explode``; duplicate checks are one grouped aggregate each. ``require``
raises when a critical check failed; nothing is ever deleted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = ["table_name", "check_name", "column_name", "observed", "threshold", "passed", "severity"]
DIGITS = r"^[0-9]+$"


@dataclass(frozen=True)
class Check:
    """kind: rows | nulls | missing_ratio | max_length | negative | out_of_range_01
    | non_digits | not_value | other_value | has_digits | null_ratio | non_null | all_not_null.
    ``op`` compares observed with threshold for ``passed`` (None: always passes)."""

    kind: str
    column: str | None = None
    threshold: float | None = None
    op: str | None = "<="
    severity: str = "critical"
    value: str | None = None


def observed(check: Check) -> Column:
    c = F.col(check.column) if check.column else None
    k = check.kind
    if k == "rows":
        return F.count(F.lit(1))
    if k == "nulls":
        return F.count_if(c.isNull())
    if k == "non_null":
        return F.count(c)
    if k in ("missing_ratio", "null_ratio"):
        return F.avg(c.isNull().cast("int"))
    if k == "max_length":
        return F.coalesce(F.max(F.length(c)), F.lit(0))
    if k == "negative":
        return F.count_if(c < 0)
    if k == "out_of_range_01":
        return F.count_if(c.isNotNull() & ~c.between(0, 1))
    if k == "non_digits":
        return F.count_if(c.isNotNull() & ~c.rlike(DIGITS))
    if k == "not_value":  # the pandas form: NULL counts as a violation
        return F.count_if(c.isNull() | (c != F.lit(check.value)))
    if k == "other_value":  # NULL is ignored
        return F.count_if(c != F.lit(check.value))
    if k == "has_digits":
        return F.count_if(c.rlike("[0-9]"))
    if k == "all_not_null":
        return F.bool_and(c.isNotNull()).cast("int")
    raise ValueError(k)


def _passed(obs: Column, check: Check) -> Column:
    if check.op is None or check.threshold is None:
        return F.lit(True)
    t = F.lit(float(check.threshold))
    return {"<=": obs <= t, "<": obs < t, ">=": obs >= t, ">": obs > t, "==": obs == t}[check.op]


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """All checks of one table in a single aggregate, unpivoted to rows."""
    aggs = [observed(ch).cast("double").alias(f"_o{i}") for i, ch in enumerate(checks)]
    one = df.agg(*aggs)
    rows = []
    for i, ch in enumerate(checks):
        obs = F.col(f"_o{i}")
        rows.append(F.struct(
            F.lit(table).alias("table_name"), F.lit(ch.kind).alias("check_name"),
            F.lit(ch.column).cast("string").alias("column_name"), obs.alias("observed"),
            F.lit(ch.threshold).cast("double").alias("threshold"),
            F.coalesce(_passed(obs, ch), F.lit(True)).alias("passed"), F.lit(ch.severity).alias("severity")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def duplicate_keys(df: DataFrame, table: str, keys: Sequence[str], severity: str = "critical",
                   threshold: float | None = 0) -> DataFrame:
    """Number of key values held by more than one row (NULL keys ignored)."""
    keys = list(keys)
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    per_key = df.where(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    obs = per_key.agg(F.count_if(F.col("n") > 1).cast("double").alias("observed"))
    return single(obs, table, "duplicate_keys", ",".join(keys), threshold, severity)


def surplus_duplicates(df: DataFrame, table: str, cols: Sequence[str] | None = None,
                       severity: str = "info") -> DataFrame:
    """Rows beyond the first of each group with equal ``cols`` (default: all
    columns; NULL is a value)."""
    cols = list(cols or df.columns)
    per = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    obs = per.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("double").alias("observed"))
    return single(obs, table, "surplus_duplicates", ",".join(cols), None, severity)


def single(obs: DataFrame, table, check, column, threshold, severity) -> DataFrame:
    passed = F.lit(True) if threshold is None else (F.col("observed") <= F.lit(float(threshold)))
    return obs.select(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
                      F.lit(column).cast("string").alias("column_name"), "observed",
                      F.lit(threshold).cast("double").alias("threshold"), passed.alias("passed"),
                      F.lit(severity).alias("severity"))


def union_reports(reports: Sequence[DataFrame]) -> DataFrame:
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def verdict(report: DataFrame) -> DataFrame:
    """Per table: failed critical / failed informational checks, and whether
    the table passes (no critical failure)."""
    crit = F.col("severity") == "critical"
    return report.groupBy("table_name").agg(
        F.count(F.lit(1)).cast("bigint").alias("checks"),
        F.count_if(crit & ~F.col("passed")).cast("bigint").alias("critical_failed"),
        F.count_if(~crit & ~F.col("passed")).cast("bigint").alias("info_failed"),
        F.bool_and(~crit | F.col("passed")).alias("table_passed"))


def require(report: DataFrame) -> DataFrame:
    """Raise when any critical check failed (a small collect: report rows)."""
    bad = report.where((F.col("severity") == "critical") & ~F.col("passed")).collect()
    if bad:
        msg = "; ".join(f"{r.table_name}.{r.check_name}({r.column_name})={r.observed}" for r in bad)
        raise AssertionError(f"critical data-quality checks failed: {msg}")
    return report


def contract_rows(df: DataFrame, table: str, contract: Sequence[tuple]) -> DataFrame:
    """Per contract column, from the rows: how many there are, how many of
    their values are missing, and how many don't have the contract's type
    (the value, as text, no longer casts to it). One aggregate a table."""
    rows = []
    for i, (c, t, _) in enumerate(contract):
        missing = F.lit(None) if c not in df.columns else F.count_if(F.col(c).isNull())
        lost = F.lit(None) if c not in df.columns else F.count_if(
            F.col(c).isNotNull() & F.col(c).cast("string").try_cast(t).isNull())
        rows.append(F.struct(F.lit(table).alias("table_name"), F.lit(i + 1).alias("ordinal"), F.lit(c).alias("column_name"),
                             F.count(F.lit(1)).cast("bigint").alias("rows"), missing.cast("bigint").alias("missing"),
                             lost.cast("bigint").alias("other_type")))
    return df.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def stored_contract_rows(df: DataFrame, table: str, contract: Sequence[tuple]) -> DataFrame:
    """Per contract column of a stored table: its place and type there beside
    the contract's (place 0, no type: the column is missing), its missing values
    and its longest text beside the allowed length. ``passed``: place and type
    are the contract's and no text is too long. One aggregate a table."""
    found, rows = dict(df.dtypes), []
    for i, (c, t, length) in enumerate(contract):
        there = c in found
        at = df.columns.index(c) + 1 if there else 0
        longest = F.coalesce(F.max(F.length(c)), F.lit(0)) if there and found[c] == "string" else F.lit(None)
        fits = F.lit(True) if length is None or not there else F.coalesce(longest <= F.lit(length), F.lit(True))
        rows.append(F.struct(
            F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.lit(i + 1).alias("expected_ordinal"), F.lit(at).alias("ordinal"),
            F.lit(t).alias("expected_type"), F.lit(found.get(c)).cast("string").alias("type"), F.count(F.lit(1)).cast("bigint").alias("rows"),
            (F.count_if(F.col(c).isNull()) if there else F.lit(None)).cast("bigint").alias("missing"),
            longest.cast("bigint").alias("longest"), (F.lit(at == i + 1 and found.get(c) == t) & fits).alias("passed")))
    return df.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def unnamed_columns(df: DataFrame, table: str) -> DataFrame:
    """A check row: how many columns with a leftover name (``unnamed...``) hold
    values."""
    left = [c for c in df.columns if c.lower().startswith("unnamed")]
    used = [(F.count(F.col(f"`{c}`")) > 0).cast("int") for c in left]
    total = sum(used[1:], used[0]) if used else F.count(F.lit(1)) * 0
    return single(df.agg(total.cast("double").alias("observed")), table, "unnamed_columns", ",".join(left) or None, 0, "critical")
