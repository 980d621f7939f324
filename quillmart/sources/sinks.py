"""Writes at the edges: raw append, staging overwrite, ingest audit upsert.

Parquet has no transactions; a replaced table is written to a new folder
first, which takes the old one's place once it is complete, so a failed write
leaves the old table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.sources import versions


def append_raw(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append one ingest batch. New columns in later batches are allowed;
    readers use ``mergeSchema`` (missing columns read as NULL)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """Truncate-and-load of a table: write beside it, then switch."""
    incoming = f"{path.rstrip('/')}_incoming_{uuid.uuid4().hex[:12]}"
    df.write.parquet(incoming)
    sc = df.sparkSession.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path
    fs = folder(path).getFileSystem(sc._jsc.hadoopConfiguration())
    fs.delete(folder(path), True)
    if not fs.rename(folder(incoming), folder(path)):
        raise OSError(f"could not move {incoming} to {path}")


def load_fact(df: DataFrame, path: str, mode: str) -> None:
    """Load fact rows: ``truncate`` replaces the table, ``append`` adds to it
    (the rows must be those not loaded yet)."""
    if mode not in ("truncate", "append"):
        raise ValueError(f"mode {mode!r}")
    (overwrite if mode == "truncate" else append_raw)(df, path)


def audit_entries(raw: DataFrame, schema: str, table_col: str, ts_col: str) -> DataFrame:
    """Newest ingest stamp per (schema, table) of a batch."""
    return raw.groupBy(F.col(table_col).alias("table_name")).agg(F.max(ts_col).alias("last_ingested_at")) \
        .select(F.lit(schema).alias("schema_name"), "table_name", "last_ingested_at")


def audit_upsert(audit: DataFrame, entries: DataFrame) -> DataFrame:
    """Insert new (schema, table) rows, keep GREATEST(old, new) for existing
    ones: a union and one grouped max (partial aggregation before the shuffle)."""
    return (audit.unionByName(entries).groupBy("schema_name", "table_name")
            .agg(F.max("last_ingested_at").alias("last_ingested_at")))


def commit_audit(entries: DataFrame, path: str, attempts: int = 20) -> int:
    """Merge entries into the stored audit table and commit the result as its
    next version; when another run committed meanwhile, merge again with what
    it left, so no run's entries get lost. The version's number."""
    spark = entries.sparkSession
    for _ in range(attempts):
        number, now = versions.latest(spark, path)
        merged = audit_upsert(spark.read.parquet(f"{path}/{now['rows']}"), entries) if number else audit_upsert(entries.limit(0), entries)
        folder = versions.new_folder(path, "rows")
        merged.write.parquet(f"{path}/{folder}")
        try:
            return versions.commit(spark, path, number, {"rows": folder})
        except versions.Conflict:
            continue
    raise versions.Conflict(f"{path}: {attempts} other commits came first")


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    number, now = versions.latest(spark, path)
    if not number:
        raise FileNotFoundError(f"{path} has no committed version")
    return spark.read.parquet(f"{path}/{now['rows']}")
