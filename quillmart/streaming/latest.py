"""Streaming latest-wins: a stored table that always equals the batch dedup of
all rows that have arrived.

Per key the table keeps the newest stamp, the row at it, and whether different
rows came with that stamp (such a key is out until a newer stamp settles it).
That is all that later rows can change: a newer stamp replaces, the same stamp
confirms or contradicts, an older one (late) does nothing. A micro-batch reads
and rewrites the buckets its keys fall into and commits them as the next
version together with the batch's number, so a batch that is run again after a
failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillmart.sources import versions


class LatestTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], business: Sequence[str], ts: str, buckets: int = 64):
        self.spark, self.path, self.keys, self.business, self.ts = spark, path.rstrip("/"), list(keys), list(business), ts
        self.buckets = buckets

    def _state(self, version: dict, buckets: set[str] | None = None) -> DataFrame | None:
        folders = [f"{self.path}/{f}" for b, f in version.get("current", {}).items() if buckets is None or b in buckets]
        return self.spark.read.schema(StructType.fromJson(version["schema"])).parquet(*folders) if folders else None

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Merge the rows of a micro-batch; rows without a key or stamp are
        dropped. For ``foreachBatch``."""
        number, version = versions.latest(self.spark, self.path)
        if version.get("batch", -1) >= batch_id:
            return
        row = F.struct(*self.business)
        rows = batch.dropna(subset=[*self.keys, self.ts]).select(*self.keys, self.ts, *self.business, F.lit(False).alias("conflict"))
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        touched = {str(r[0]) for r in rows.select(bucket).distinct().collect()}
        before = self._state(version, touched)
        both = rows if before is None else rows.unionByName(before)
        # The same stamp with different rows is a conflict.
        stamped = both.groupBy(*self.keys, self.ts).agg(F.min(row).alias("lo"), F.max(row).alias("hi"), F.max("conflict").alias("conflict"))
        stamped = stamped.withColumn("conflict", F.col("conflict") | ~F.col("lo").eqNullSafe(F.col("hi")))
        newest = stamped.groupBy(*self.keys).agg(F.max(F.struct(self.ts, "lo", "conflict")).alias("v"))
        after = newest.select(*self.keys, F.col(f"v.{self.ts}").alias(self.ts), *[F.col(f"v.lo.{c}").alias(c) for c in self.business],
                              F.col("v.conflict").alias("conflict"))
        changed = {}
        if touched:
            folder = versions.new_folder(self.path, "state")
            after.withColumn("_bucket", bucket).repartition(self.buckets, "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
            changed = {b: f"{folder}/_bucket={b}" for b in touched}
        versions.commit(self.spark, self.path, number, {
            "schema": after.schema.jsonValue(), "current": {**version.get("current", {}), **changed}, "batch": batch_id})

    def read(self, keep_stamp: bool = False) -> DataFrame:
        """The rows that latest-wins keeps."""
        number, version = versions.latest(self.spark, self.path)
        state = self._state(version) if number else None
        if state is None:
            raise FileNotFoundError(f"{self.path} has no rows yet")
        return state.where("NOT conflict").select(*self.keys, *self.business, *([self.ts] if keep_stamp else []))


def ingest_latest(spark: SparkSession, source: str, table: LatestTable, checkpoint: str, max_files: int = 1000) -> int:
    """One availableNow run over the files that arrived in a folder since the
    last one. Returns the number of micro-batches."""
    stream = (spark.readStream.format("parquet").schema(spark.read.parquet(source).schema)
              .option("maxFilesPerTrigger", max_files).load(source))
    query = (stream.writeStream.foreachBatch(table.upsert).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return len(query.recentProgress)
