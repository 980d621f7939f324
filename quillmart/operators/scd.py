"""Slowly changing dimensions, type 2.

A dimension version row is: sk, natural key columns, tracked columns,
valid_from, valid_to (NULL while open), is_current. Validity is half-open:
[valid_from, valid_to).

Surrogate key 0 is the unknown member, a row of its own in every loaded
dimension, so facts that point to it find it.

``scd2_merge`` joins the current versions FULL OUTER with the snapshot on the
natural key, once (the joined rows are checkpointed); each joined row yields
the old version (expired when a tracked column changed, NULL-safe) and/or a
new version (new key, or changed key). History rows pass through untouched.
Only the inserted versions are then numbered (``dense_number``), starting
after the largest existing key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmart.operators.keys import current_max, number_tables, surrogate_keys
from quillmart.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class ScdSpec:
    """Configuration of one type-2 dimension. ``required``: the key columns
    that may not be NULL (rows without them are quarantined)."""

    name: str
    sk: str
    key: tuple
    tracked: tuple
    required: tuple = ()

    @property
    def columns(self) -> list[str]:
        return [*self.key, *self.tracked]


def _date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, (dt.date, dt.datetime)):
        d = d.isoformat()[:10]
    return F.lit(d).cast("date")


def changed_any(tracked: Sequence[str], left: str, right: str) -> Column:
    """OR over columns of NULL-safe inequality (IS DISTINCT FROM)."""
    cond = F.lit(False)
    for t in tracked:
        cond = cond | ~F.col(f"{left}.{t}").eqNullSafe(F.col(f"{right}.{t}"))
    return cond


def without_null_keys(snapshot: DataFrame, spec: ScdSpec) -> DataFrame:
    """The rows that have their natural key."""
    return snapshot.dropna(subset=list(spec.required)) if spec.required else snapshot


def null_key_rows(snapshot: DataFrame, spec: ScdSpec) -> DataFrame:
    """The quarantine: rows that lack a required part of their key."""
    cond = F.lit(False)
    for k in spec.required:
        cond = cond | F.col(k).isNull()
    return snapshot.where(cond)


def one_version_per_key(snapshot: DataFrame, spec: ScdSpec, stamps: Sequence[str]) -> DataFrame:
    """Make a snapshot unique per natural key: the newest row by its stamps
    wins; between different rows of the same stamps (see ``stamp_ties``) the
    greatest tracked tuple, NULL lowest."""
    if not spec.tracked:
        return snapshot.select(*spec.key).distinct()
    newest = F.max(F.struct(*[F.col(c) for c in [*stamps, *spec.tracked]])).alias("_v")
    agg = snapshot.groupBy(*spec.key).agg(newest)
    return agg.select(*spec.key, *[F.col(f"_v.{t}").alias(t) for t in spec.tracked])


def stamp_ties(snapshot: DataFrame, spec: ScdSpec, stamps: Sequence[str]) -> DataFrame:
    """Keys whose newest stamps carry several different tracked tuples, with
    their number: what ``one_version_per_key`` had to choose between."""
    rows = snapshot.select(*spec.key, *stamps, *spec.tracked).distinct()
    per = rows.groupBy(*spec.key, *stamps).agg(F.count(F.lit(1)).alias("candidates"))
    best = per.groupBy(*spec.key).agg(F.max(F.struct(*stamps, "candidates")).alias("_v"))
    return best.select(*spec.key, F.col("_v.candidates").alias("candidates")).where("candidates > 1")


def unknown_member(like: DataFrame, spec: ScdSpec) -> DataFrame:
    """The row with key 0: everything NULL, valid from the beginning."""
    fixed = {spec.sk: F.lit(0), "valid_from": _date("1900-01-01"), "is_current": F.lit(True)}
    one = like.sparkSession.range(1)
    return one.select(*[fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def with_unknown_member(dim: DataFrame, spec: ScdSpec) -> DataFrame:
    return dim.unionByName(unknown_member(dim, spec))


def _first_versions(keyed: DataFrame, spec: ScdSpec, load_date) -> DataFrame:
    return keyed.select(
        F.col(spec.sk), *spec.columns, _date(load_date).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))


def scd2_initial(snapshot: DataFrame, spec: ScdSpec, load_date) -> DataFrame:
    """First load: every snapshot row becomes a current version; keys 1..n
    in natural-key order."""
    keyed = surrogate_keys(snapshot.select(*spec.columns), spec.columns, spec.sk, offset=0)
    return _first_versions(keyed, spec, load_date)


def scd2_initial_many(snapshots: dict[str, DataFrame], specs: dict[str, ScdSpec], load_date) -> dict[str, DataFrame]:
    """The first load of several dimensions, numbered together by
    ``number_tables``. Each gets the keys that ``scd2_initial`` gives."""
    numbered = number_tables({n: snap.select(*specs[n].columns) for n, snap in snapshots.items()}, "_sk")
    return {n: _first_versions(d.withColumnRenamed("_sk", specs[n].sk), specs[n], load_date) for n, d in numbered.items()}


def scd2_merge(current: DataFrame, snapshot: DataFrame, spec: ScdSpec, load_date,
               max_sk: int | None = None) -> DataFrame:
    """Apply one snapshot to a versioned dimension (see module doc).

    Unchanged keys and keys missing from the snapshot keep their current
    version; changed keys get the old version expired (valid_to=load_date,
    is_current=false) and a new current version; new keys get a version."""
    key, tracked = list(spec.key), list(spec.tracked)
    ld = _date(load_date)
    out_cols = [spec.sk, *key, *tracked, "valid_from", "valid_to", "is_current"]
    history = current.where(~F.col("is_current")).select(*out_cols)
    cur = current.where(F.col("is_current")).select(*out_cols).alias("c")
    snap = snapshot.select(*key, *tracked).withColumn("_in", F.lit(True)).alias("s")

    cond = None
    for k in key:  # NULL-safe: a NULL part of a natural key (an address) is a value
        e = F.col(f"c.{k}").eqNullSafe(F.col(f"s.{k}"))
        cond = e if cond is None else cond & e
    j = cur.join(snap, cond, "full_outer")
    c_in = F.col(f"c.{spec.sk}").isNotNull()
    s_in = F.col("s._in").isNotNull()
    changed = c_in & s_in & changed_any(tracked, "c", "s")
    keycols = [F.coalesce(F.col(f"c.{k}"), F.col(f"s.{k}")).alias(k) for k in key]
    old = F.when(c_in, F.struct(
        F.col(f"c.{spec.sk}").alias(spec.sk), *keycols,
        *[F.col(f"c.{t}").alias(t) for t in tracked],
        F.col("c.valid_from").alias("valid_from"),
        F.when(changed, ld).otherwise(F.col("c.valid_to")).alias("valid_to"),
        (~changed).alias("is_current")))
    new = F.when(s_in & (~c_in | changed), F.struct(
        F.lit(None).cast("long").alias(spec.sk), *keycols,
        *[F.col(f"s.{t}").alias(t) for t in tracked],
        ld.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current")))
    ensure_checkpoint_dir(current.sparkSession)
    rows = j.select(F.explode(F.filter(F.array(old, new), lambda x: x.isNotNull())).alias("v")).select("v.*").checkpoint()

    kept = rows.where(F.col(spec.sk).isNotNull())
    inserts = rows.where(F.col(spec.sk).isNull()).drop(spec.sk)
    base = current_max(current, spec.sk) if max_sk is None else max_sk
    numbered = surrogate_keys(inserts, [*key, *tracked], spec.sk, offset=base)
    return history.unionByName(kept.select(*out_cols)).unionByName(numbered.select(*out_cols))


def current_view(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current"))


def as_of(dim: DataFrame, day) -> DataFrame:
    """Versions valid on ``day`` under half-open validity."""
    d = _date(day)
    return dim.where((F.col("valid_from") <= d) & (F.col("valid_to").isNull() | (F.col("valid_to") > d)))
