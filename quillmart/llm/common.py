"""Helpers shared by the text operators: per-task Arrow mapping, lineage cuts
and stable row keys."""

from __future__ import annotations

import gc
import re
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quillmart.session import ensure_checkpoint_dir
from quillmart.session import ship_package as ship

ROWS_PER_CALL = 256
_PUNCTUATION = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
_TO_SPACES = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))
_WIDE_PUNCTUATION = re.compile("[\u00a1\u00a7\u00ab\u00b7\u00bb\u00bf\u2010-\u2027\u2030-\u205e\u3001-\u3003\u3008-\u3011\uff01-\uff0f]")


def words_of(text: str) -> list[str]:
    """Lower-case words without punctuation."""
    text = text.lower().encode().translate(_TO_SPACES).decode()
    return (text if text.isascii() else _WIDE_PUNCTUATION.sub(" ", text)).split()


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """The id as long ``doc_id`` and the whole text as ``text`` (null: empty);
    every other column of ``docs`` is left out, whatever its name."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *more)


def map_batches(df: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str,
                rows_per_call: int = ROWS_PER_CALL) -> DataFrame:
    """Apply a batch function on the executors, without a shuffle.

    ``make()`` runs once per task and returns ``fn(columns) -> columns``, where
    ``columns`` maps a name to a list of values. ``fn`` sees at most
    ``rows_per_call`` rows at once and may return another number of rows, so
    the memory of a call is bounded whatever the partition holds."""
    ship(df.sparkSession)
    out = StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows_per_call):
                part = batch.slice(at, rows_per_call)
                cols = {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}
                got = fn(cols)
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)


def filter_rows(docs: DataFrame, make: Callable[[], Callable[[list[str]], list[bool]]], text_col: str = "text",
                rows_per_call: int = ROWS_PER_CALL) -> DataFrame:
    """The rows whose whole text (null: empty) passes a test, all columns as
    they are, without a shuffle. ``make()`` runs once per task and returns the
    test of a list of texts."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = make()
        for batch in batches:
            for start in range(0, batch.num_rows, rows_per_call):
                part = batch.slice(start, rows_per_call)
                texts = [t or "" for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(passes(texts), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder of the
    session; it survives lost executors and Spark's cleaner removes it when
    the DataFrame is no longer used."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def drop_cut(*frames: DataFrame) -> None:
    """Remove the checkpoint files of cuts that nothing will read again (what
    was made from them is itself cut)."""
    for df in frames:
        path = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if path.isDefined():
            sc = df.sparkSession.sparkContext
            folder = sc._jvm.org.apache.hadoop.fs.Path(path.get())
            folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def smallest_hashes(rows: DataFrame, n: int, *order: str) -> DataFrame:
    """The ``n`` rows with the smallest hashes of the first ``order`` column,
    ties by the others: a sample that stays the same whatever the layout. The
    rows below each of a row of bounds, halving from all hashes on, are counted
    first; those above the lowest bound with at least ``n`` rows are dropped,
    so a task hands on a few rows, however many tasks there are."""
    h = F.xxhash64(order[0])
    bounds = [-2 ** 63 + 2 ** (64 - k) for k in range(1, 41)]
    below = rows.agg(*[F.count_if(h < F.lit(b)) for b in bounds]).first()
    enough = [b for b, found in zip(bounds, below) if found >= n]
    return (rows.where(h < F.lit(enough[-1])) if enough else rows).orderBy(h, *order).limit(n)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of plans that were cut and
    are no longer held: it follows the driver's garbage collection, which on
    its own may come long after they are useless. Python's side lets go of its
    objects in the background, hence a second round."""
    for _ in range(2):
        gc.collect()
        time.sleep(0.5)
        spark.sparkContext._jvm.System.gc()


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Two hashes (128 bits) of a document row's id and text, ``k1`` and
    ``k2``. Documents are found again by them, null ids included; repeated
    rows share a key and with it everything computed from the row."""
    i = F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("null"))
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return [F.xxhash64(i, t).alias("k1"), F.xxhash64(t, F.lit("|"), i).alias("k2")]
