"""A fact table on disk whose loads know which files may hold a key.

Each load writes its rows in ranges of the key and notes every file's lowest
and highest key beside it. What an incremental load has to be compared with
are the files whose range meets a range of the new keys; the others are neither
opened nor listed. Loads are committed versions, so a load that fails leaves
the table as it was, and of two loads at a time one starts again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.sources import versions


SPANS = 64  # ranges that the keys of a load are cut into


class StoredFact:
    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def _version(self) -> tuple[int, dict]:
        number, now = versions.latest(self.spark, self.path)
        return number, now or {"rows": [], "ranges": []}

    def load(self, rows: DataFrame, mode: str = "append") -> int:
        """Write rows as a new version: after those there are (``append``), or
        in their place (``truncate``)."""
        if mode not in ("truncate", "append"):
            raise ValueError(f"mode {mode!r}")
        number, now = self._version()
        folder, ranges = versions.new_folder(self.path, "rows"), versions.new_folder(self.path, "ranges")
        rows.repartitionByRange(F.col(self.key)).sortWithinPartitions(self.key).write.parquet(f"{self.path}/{folder}")
        written = self.spark.read.parquet(f"{self.path}/{folder}")
        (written.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"))
         .coalesce(1).write.parquet(f"{self.path}/{ranges}"))
        before = now if mode == "append" else {"rows": [], "ranges": []}
        return versions.commit(self.spark, self.path, number, {"rows": [*before["rows"], folder], "ranges": [*before["ranges"], ranges]})

    def read(self) -> DataFrame:
        _, now = self._version()
        return self.spark.read.parquet(*[f"{self.path}/{f}" for f in now["rows"]])

    def files_for(self, keys: DataFrame) -> list[str]:
        """The files that may hold one of the keys (a column named like the
        table's key): their ranges against those of the new keys, one range per
        partition. Both are a row per file or partition, not per key."""
        _, now = self._version()
        if not now["ranges"]:
            return []
        spans = (keys.select(F.col(self.key).alias("k")).where("k IS NOT NULL").repartitionByRange(SPANS, F.col("k"))
                 .groupBy(F.spark_partition_id().alias("p")).agg(F.min("k").alias("from"), F.max("k").alias("to")))
        ranges = self.spark.read.parquet(*[f"{self.path}/{f}" for f in now["ranges"]])
        met = ranges.join(spans, (F.col("low") <= F.col("to")) & (F.col("high") >= F.col("from")), "left_semi")
        return sorted(r["file"] for r in met.select("file").collect())

    def loaded(self, keys: DataFrame, columns: Sequence[str]) -> DataFrame:
        """The given columns of the rows that may match the keys."""
        files = self.files_for(keys)
        rows = self.spark.read.parquet(*files) if files else self.read().where("false")
        return rows.select(*columns)
