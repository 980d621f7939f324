"""The merge joins of the order/line-item assembly. No side is forced to
broadcast: adaptive execution decides from the measured size of the finished
stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_keep_left(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join where columns present on both sides keep the left value: only the
    right side's new columns are brought over (no suffix columns to drop)."""
    on = list(on)
    new = [c for c in right.columns if c not in left.columns]
    return left.join(right.select(*on, *new), on=on, how=how)


def join_coalesce(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join where shared columns take the left value, else the right one
    (fills gaps instead of discarding the right side's values)."""
    on = list(on)
    shared = [c for c in right.columns if c in left.columns and c not in on]
    r = right.select(*on, *[F.col(c).alias(f"_r_{c}") for c in shared],
                     *[c for c in right.columns if c not in left.columns])
    j = left.join(r, on=on, how=how)
    for c in shared:
        j = j.withColumn(c, F.coalesce(F.col(c), F.col(f"_r_{c}"))).drop(f"_r_{c}")
    return j


def outer_merge_keep_left(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer join of several frames on ``key`` (folded left to right);
    the key is coalesced and a column already present keeps the left value."""
    out = frames[0]
    for f in frames[1:]:
        new = [c for c in f.columns if c not in out.columns]
        r = f.select(F.col(key).alias("_rk"), *new)
        out = (out.join(r, out[key] == r["_rk"], "full_outer")
               .withColumn(key, F.coalesce(F.col(key), F.col("_rk"))).drop("_rk"))
    return out


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Row concatenation by column name; missing columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
