"""The three deduplication policies of the staging layer.

* ``latest_wins``   — newest stamp per key; disagreement at that stamp drops the key.
* ``exact_rows``    — identical business rows collapse; NULLs are values.
* ``exact_rows_no_nulls`` — same, but any row with a NULL field is dropped.

All three start with a hash aggregate over whole rows, whose partial step
collapses copies (a hot key's too) before the exchange; nothing is sorted or
joined before that. ``latest_wins`` then decides on the distinct rows left.
Stamps are compared as they are, so the session time zone plays no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _not_null(cols: Sequence[str]):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def latest_wins(df: DataFrame, keys: Sequence[str], business: Sequence[str], ts: str,
                keep_stamp: bool = False) -> DataFrame:
    """Latest-wins dedup with conflicting keys rejected.

    Per key: keep the business row at the newest ``ts``; if rows at that
    stamp differ in any business column (NULL equal to NULL) the key is
    dropped. Rows with a NULL key or NULL stamp are dropped first. Output:
    keys + business (and the stamp with ``keep_stamp``).

    Distinct (key, business, stamp) rows first; they are one exchange that
    both uses read: the newest stamp per key, and the rows at it, of which a
    key must have one."""
    keys, business = list(keys), list(business)
    versions = df.where(_not_null([*keys, ts])).select(*keys, *business, ts).distinct()
    newest = versions.groupBy(*keys).agg(F.max(ts).alias("_newest"))
    top = versions.join(newest, keys).where(F.col(ts) == F.col("_newest"))
    rest = [*business, *([ts] if keep_stamp else [])]
    one = top.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in rest])
    return one.where("_n = 1").select(*keys, *rest)


def exact_rows(df: DataFrame, business: Sequence[str], ts: str | None = None) -> DataFrame:
    """Identical business rows collapse to one; NULL counts as a value. With
    ``ts`` the newest stamp of the identical rows comes along."""
    if ts:
        return df.groupBy(*business).agg(F.max(ts).alias(ts))
    return df.select(*business).distinct()


def exact_rows_no_nulls(df: DataFrame, business: Sequence[str], ts: str | None = None) -> DataFrame:
    """Identical rows collapse; any row with a NULL business field (or NULL
    stamp) is dropped — the null-unsafe join policy of the line-item dedup."""
    subset = list(business) + ([ts] if ts else [])
    return df.dropna(subset=subset).select(*business).distinct()


def ranked_stamps(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Per (key, stamp) the number of rows and the stamp's rank, newest
    first. Rows are counted per stamp before the ranking window, so a window
    partition holds one row per distinct stamp of a key."""
    counted = df.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("rows_at_stamp"))
    newest_first = Window.partitionBy(*keys).orderBy(F.col(ts).desc_nulls_last())
    return counted.withColumn("stamp_rank", F.row_number().over(newest_first))


def conflict_stats(df: DataFrame, keys: Sequence[str], business: Sequence[str], ts: str) -> DataFrame:
    """Per (key, ts): row count and number of distinct business tuples (a
    tuple with NULL fields counts as a value): counted distinct rows first,
    then the two totals."""
    distinct = df.groupBy(*keys, ts, *business).agg(F.count(F.lit(1)).alias("_n"))
    return distinct.groupBy(*keys, ts).agg(F.sum("_n").alias("rows_at_stamp"),
                                           F.count(F.lit(1)).alias("distinct_rows"))
