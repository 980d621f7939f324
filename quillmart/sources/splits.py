"""Files as ordered pieces, and records that cross the splits of a file.

Spark cuts a file into splits and, given a separator, each split into pieces
(rows); a piece belongs to the split it begins in. Where a record is not one
piece (a CSV field with line breaks, an HTML page), it is put together from
its pieces inside the task that reads the split. Only the pieces at the two
ends of a split can belong to a record that crosses it: these go on as
fragments, at most two a split, and are joined by file and position. So files
stay splittable, and a task holds one record.

What the driver keeps is a few values per split, as it keeps the splits
themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quillmart.session import ship_package

ROWS_AT_ONCE = 4096
TEXT_BYTES = 8192
WHOLE, HEAD, TAIL, MIDDLE = "whole", "head", "tail", "middle"


class Reader(Protocol):
    """Takes the pieces of one split in order; both methods yield rows."""

    def piece(self, value: str) -> Iterator[tuple]: ...

    def end(self) -> Iterator[tuple]: ...


def pieces(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(file, block, value): the pieces of the files of a path; within a task
    they come in the order of the file."""
    text = spark.read.option("lineSep", sep).text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def texts(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(file, size, block, at, value): the pieces of the files of a path, put
    together again to texts of some 8 KB, which are cheaper to move; with ``sep``
    between them, the texts of a file in order of (block, at) are the file.
    ``size`` is the file's."""
    cut = pieces(spark, path, sep).withColumn("size", F.col("_metadata.file_size")).select("file", "size", "block", "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, (file, _, block, value) = batch.num_rows, batch.columns
            if not n:
                continue
            text = pc.binary_length(value).to_numpy().cumsum(dtype="int64") // TEXT_BYTES
            begins = np.ones(n, dtype=bool)
            begins[1:] = (text[1:] != text[:-1]) | pc.not_equal(block[1:], block[:-1]).to_numpy(False) | pc.not_equal(file[1:], file[:-1]).to_numpy(False)
            first = np.flatnonzero(begins)
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, n), pa.int32()), value)
            kept = [c.take(pa.array(first)) for c in batch.columns[:3]]
            yield pa.RecordBatch.from_arrays([*kept, pc.binary_join(lists, pa.scalar(sep, value.type))], names=["file", "size", "block", "value"])

    return cut.mapInArrow(run, cut.schema).withColumn("at", F.monotonically_increasing_id())


def map_splits(found: DataFrame, make: Callable[[str, int], Reader], schema: str, at_once: int = ROWS_AT_ONCE) -> DataFrame:
    """One ``make(file, block)`` reader per split; its rows, handed on when
    there are ``at_once``."""
    ship_package(found.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reader, rows = None, None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(arrow), arrow)], schema=arrow)

        for batch in batches:
            for file, block, value in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, block) != now:
                    if reader:
                        rows += reader.end()
                    now, reader = (file, block), make(file, block)
                rows += reader.piece(value)
                if len(rows) >= at_once:
                    yield out()
                    rows = []
        if reader:
            rows += reader.end()
        yield out()

    return found.select("file", "block", "value").mapInArrow(run, StructType.fromDDL(schema))


def joined_fragments(fragments: DataFrame, sep: str) -> DataFrame:
    """(file, block, text) of the records that cross splits, from fragments
    (file, block, kind, text): a tail, any splits that lie wholly inside, and
    the head of the split where the record ends. ``block`` is where it begins."""
    order = Window.partitionBy("file").orderBy("block", "kind")  # a split's head sorts before its tail
    begins = (F.col("kind") == TAIL) | (F.lag("kind").over(order) == HEAD)
    numbered = fragments.withColumn("begins", F.coalesce(begins, F.lit(False)).cast("int")).withColumn("record", F.sum("begins").over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", "text")))
    return numbered.groupBy("file", "record").agg(F.min("block").alias("block"), F.array_join(F.transform(parts, lambda x: x["text"]), sep).alias("text")) \
        .select("file", "block", "text")
