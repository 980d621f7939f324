"""A type-2 dimension kept on disk.

Current versions lie in folders per bucket of the natural key's hash, closed
versions (the history) in one folder per load. A load reads the current
versions only, finds what is new or changed by one join with the snapshot, and
rewrites the buckets in which something changed; all other buckets and the whole
history stay as they are. Which folders make up the table says the committed
version (``sources.versions``): a load that fails leaves the old one, and of two
loads at a time one is told to start again.

Versions, keys and numbering are those of ``scd.scd2_merge``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillmart.operators.keys import surrogate_keys
from quillmart.operators.scd import ScdSpec, _date, changed_any
from quillmart.session import ensure_checkpoint_dir
from quillmart.sources import versions

BUCKETS = 64


class StoredDimension:
    def __init__(self, spark: SparkSession, path: str, spec: ScdSpec, buckets: int = BUCKETS):
        self.spark, self.path, self.spec, self.buckets = spark, path.rstrip("/"), spec, buckets

    # ------------------------------------------------------------- reading
    def _columns(self) -> list[str]:
        return [self.spec.sk, *self.spec.columns, "valid_from", "valid_to", "is_current"]

    def _read(self, folders: Sequence[str], schema: StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def current(self, buckets: Sequence[int] | None = None, version: dict | None = None) -> DataFrame:
        """Current versions, of all buckets or of some; only their folders are
        listed and read."""
        version = version or versions.latest(self.spark, self.path)[1]
        folders = [f for b, f in version["current"].items() if buckets is None or int(b) in set(buckets)]
        return self._read(folders, StructType.fromJson(version["schema"]))

    def history(self) -> DataFrame:
        version = versions.latest(self.spark, self.path)[1]
        return self._read(version["history"], StructType.fromJson(version["schema"]))

    def all_versions(self) -> DataFrame:
        return self.current().unionByName(self.history())

    # ------------------------------------------------------------- writing
    def _bucket(self):
        return F.pmod(F.xxhash64(*self.spec.key), F.lit(self.buckets)).cast("int")

    def _write_buckets(self, rows: DataFrame) -> dict[str, str]:
        """Write rows by bucket; the folder of each bucket that has rows."""
        folder = versions.new_folder(self.path, "current")
        by = rows.withColumn("_bucket", self._bucket())
        by.repartition(self.buckets, "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        fs, p = versions._fs(self.spark, f"{self.path}/{folder}")
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return {n.split("=")[1]: f"{folder}/{n}" for n in names if n.startswith("_bucket=")}

    def load(self, snapshot: DataFrame, load_date) -> int:
        """Apply a snapshot (unique per natural key); the number of the version
        that has it. Conflict if another load committed meanwhile."""
        spec, key = self.spec, list(self.spec.key)
        number, version = versions.latest(self.spark, self.path)
        day = _date(load_date)
        snap = snapshot.select(*spec.columns)
        if number:
            cur = self.current(version=version).alias("c")
            cond = reduce(lambda a, b: a & b, [F.col(f"c.{k}").eqNullSafe(F.col(f"s.{k}")) for k in key])
            joined = snap.alias("s").join(cur, cond, "left")
            known = F.col(f"c.{spec.sk}").isNotNull()
            picked = joined.where(~known | changed_any(spec.tracked, "c", "s"))
            delta = picked.select(*[F.col(f"s.{c}").alias(c) for c in spec.columns], F.col(f"c.{spec.sk}").alias("_old"))
            ensure_checkpoint_dir(self.spark)
            delta = delta.checkpoint()
        else:
            delta = snap.withColumn("_old", F.lit(None).cast("long"))
        keyed = surrogate_keys(delta, spec.columns, spec.sk, offset=version.get("max_sk", 0))
        new = keyed.select(F.col(spec.sk).cast("long").alias(spec.sk), *spec.columns, day.alias("valid_from"),
                           F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
        if not number:
            changed = {str(b): f for b, f in self._write_buckets(new).items()}
            found = self._read(list(changed.values()), new.schema)
            history = []
        else:
            touched = [r[0] for r in delta.select(self._bucket()).distinct().collect()]
            if not touched:
                return number
            before = self.current(touched, version)
            gone = delta.where("_old IS NOT NULL").select(F.col("_old").alias(spec.sk))
            changed = self._write_buckets(before.join(gone, spec.sk, "left_anti").unionByName(new))
            folder = versions.new_folder(self.path, "history")
            closed = before.join(gone, spec.sk, "left_semi").withColumn("valid_to", day).withColumn("is_current", F.lit(False))
            closed.select(*self._columns()).write.parquet(f"{self.path}/{folder}")
            found = self._read(list(changed.values()), new.schema)
            history = [*version["history"], folder]
        top = found.agg(F.max(spec.sk)).first()[0]
        return versions.commit(self.spark, self.path, number, {
            "schema": new.schema.jsonValue(), "current": {**version.get("current", {}), **changed}, "history": history,
            "max_sk": max(int(top or 0), version.get("max_sk", 0))})
