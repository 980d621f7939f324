"""Distributed dense numbering: surrogate keys and per-group line numbers.

``row_number()`` over a window without PARTITION BY moves every row into one
task, and a window PARTITIONED BY a hot key puts that key's rows into one
task. ``dense_number`` has one way for every input:

1. range-partition on (group, order) with an explicit partition count (so AQE
   never coalesces it and partition ids stay stable), sort inside each
   partition and checkpoint the rows (range bounds are sampled from an input
   whose row order after a shuffle is not reproducible, so both uses read one
   copy);
2. each partition reports its first and last group and how many of its rows the
   last one has: one row per partition, from which the driver, which keeps the
   partitions anyway, knows how many rows of its first group come earlier;
3. each partition numbers its rows as they pass in order, batch by batch.

So the rows are shuffled once, and nothing is joined or held per group. A group
is compared with its neighbour in the order by two hashes (128 bits). Without
groups a row's number is its place in its partition and the rows of earlier
partitions, so steps 2 and 3 are a count and an addition.

``number_tables`` numbers several tables, each on its own, by one such
partitioning; what it writes can be read table by table and column by column.

``number_small_groups`` is for groups that are small as a rule (the lines of an
order): they are numbered by a window, whose partitioning a join on the group
goes on to use, and without Python. Groups that turn out to be large go to
``dense_number``.

The result equals ``row_number() OVER (PARTITION BY group ORDER BY order)``
when ``order`` is a total order (ties only between identical rows).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmart.session import ensure_checkpoint_dir, run_folder, ship_package

_TASK_BITS = 33  # of monotonically_increasing_id(): the place in the partition


def _runs(batch: pa.RecordBatch, last: tuple | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The two group hashes of a batch and where a group begins; ``last``: the
    hashes of the row before."""
    a, b = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("_a", "_b"))
    begins = np.ones(len(a), bool)
    begins[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    begins[0] = last != (a[0], b[0])
    return a, b, begins


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for a partition that has rows: its number, first and last group,
    the rows of the last one, and whether it is the only one."""
    first = last = pid = None
    rows, single = 0, True
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, begins = _runs(batch, last)
        if first is None:
            first, pid = (int(a[0]), int(b[0])), batch.column("_pid")[0].as_py()
            begins[0] = False
        at = np.flatnonzero(begins)
        rows = rows + len(a) if not len(at) else len(a) - int(at[-1])
        single, last = single and not len(at), (int(a[-1]), int(b[-1]))
    if first is not None:
        yield pa.RecordBatch.from_pydict(dict(zip(("_pid", "fa", "fb", "la", "lb", "n", "single"), ([v] for v in (pid, *first, *last, rows, single)))))


def _rows_before(ends: list) -> dict[int, int]:
    """Per partition the rows of its first group in earlier partitions."""
    before, group, rows = {}, None, 0
    for e in sorted(ends, key=lambda e: e["_pid"]):
        before[e["_pid"]] = rows if group == (e["fa"], e["fb"]) else 0
        group, rows = (e["la"], e["lb"]), e["n"] + (before[e["_pid"]] if e["single"] else 0)
    return before


def dense_number(df: DataFrame, order: Sequence[str | Column], name: str,
                 group: Sequence[str] = (), start: int | Column = 1,
                 num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = start - 1 + row_number() OVER (PARTITION BY group ORDER BY order)."""
    group, cols, spark = list(group), df.columns, df.sparkSession
    keys = [*map(F.col, group), *(F.col(o) if isinstance(o, str) else o for o in order)]
    n = num_partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    ensure_checkpoint_dir(spark)
    start_col = start if isinstance(start, Column) else F.lit(start)
    if not group:
        placed = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                  .withColumn("_at", F.monotonically_increasing_id()).checkpoint(eager=True))
        number = _place(_places(placed, []).get((), []))
        return placed.select(*cols, (number - 1 + start_col).cast("long").alias(name))
    ship_package(spark)
    ordered = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
               .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))
    nulls = [F.col(g).isNull() for g in group]  # NULL group keys are a group of their own
    hashed = {"_a": F.xxhash64(F.lit(1), *group, *nulls), "_b": F.xxhash64(F.lit(2), *nulls, *group)}
    ends = ordered.select("_pid", *[c.alias(k) for k, c in hashed.items()]).mapInArrow(
        _ends, "_pid long, fa long, fb long, la long, lb long, n long, single boolean")
    before = _rows_before(ends.collect())

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows = None, 0  # the row before: its group, and its number there
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is None:
                rows = before[batch.column("_pid")[0].as_py()]
            a, b, begins = _runs(batch, last)
            if last is None:
                begins[0] = False
            at = np.arange(len(a))
            since = np.maximum.accumulate(np.where(begins, at, -1))  # -1: the group began before the batch
            numbers = np.where(since < 0, at + 1 + rows, at - since + 1)
            last, rows = (a[-1], b[-1]), int(numbers[-1])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(cols))), pa.array(numbers, pa.int64())], names=[*cols, "_number"])

    schema = ordered.select(*cols, F.lit(0).cast("long").alias("_number")).schema
    numbered = ordered.select(*cols, "_pid", *[c.alias(k) for k, c in hashed.items()]).mapInArrow(number, schema)
    return numbered.select(*cols, (F.col("_number") - 1 + start_col).cast("long").alias(name))


HOT_ROWS, BUCKETS = 100_000, 1 << 16


def _key(column: str) -> Column:
    return F.col(f"`{column}`")


def _hot_groups(rows: DataFrame, group: Sequence[str], hot_rows: int) -> DataFrame | None:
    """The groups with more than ``hot_rows`` rows, or None. Rows are counted by
    bucket of the group's hash first, so the groups themselves are counted only
    in buckets with as many rows as a hot group has."""
    bucket = F.pmod(F.xxhash64(*map(_key, group)), F.lit(BUCKETS)).alias("_bucket")
    large = rows.select(bucket).groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    buckets = [r["_bucket"] for r in large.collect()]
    if not buckets:
        return None
    some = rows.select(*map(_key, group), bucket).where(F.col("_bucket").isin(buckets)).drop("_bucket")
    found = some.groupBy(*map(_key, group)).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).drop("_n").checkpoint()
    return found if found.take(1) else None


def number_small_groups(df: DataFrame, order: Sequence[str], name: str, group: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """As ``dense_number``, for groups that are small as a rule. The rows are
    written once, their groups counted from there; a window numbers those of up
    to ``hot_rows`` rows, ``dense_number`` the others, if there are any."""
    spark, cols = df.sparkSession, df.columns
    ensure_checkpoint_dir(spark)
    path = run_folder(spark, "groups") + "/rows"
    df.toDF(*[f"_{i}" for i in range(len(cols))]).write.parquet(path)
    rows = spark.read.parquet(path).toDF(*cols)
    place = F.row_number().over(Window.partitionBy(*map(_key, group)).orderBy(*map(_key, order))).cast("long").alias(name)
    hot = _hot_groups(rows, group, hot_rows)
    if hot is None:
        return rows.select(*map(_key, cols), place)
    same = reduce(and_, [F.col(f"r.`{g}`").eqNullSafe(F.col(f"h.`{g}`")) for g in group])
    part = {how: rows.alias("r").join(hot.alias("h"), same, how) for how in ("left_anti", "left_semi")}
    return part["left_anti"].select(*map(_key, cols), place).unionByName(dense_number(part["left_semi"], order, name, group))


def _places(placed: DataFrame, group: Sequence[str]) -> dict[tuple, list]:
    """Per group (a few of them) the partitions that hold its rows, in order:
    partition, first place, rows."""
    task = F.shiftright("_at", _TASK_BITS)
    found = placed.groupBy(*group, task.alias("_task")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")).collect()
    out: dict[tuple, list] = {}
    for r in sorted(found, key=lambda r: r["_task"]):
        out.setdefault(tuple(r[g] for g in group), []).append((r["_task"], r["_first"], r["_rows"]))
    return out


def _place(spans: list) -> Column:
    """A row's number (from 1) within its group, from its ``_at``."""
    shifts, before = [0] * (spans[-1][0] - spans[0][0] + 1 if spans else 1), 1
    for task, first, rows in spans:
        shifts[task - spans[0][0]] = before - first
        before += rows
    at = F.shiftright("_at", _TASK_BITS) - F.lit(spans[0][0] if spans else 0)
    return F.col("_at") + F.get(F.array(*[F.lit(s).cast("long") for s in shifts]), at.cast("int"))


def number_tables(tables: dict[str, DataFrame], name: str) -> dict[str, DataFrame]:
    """Every table with ``name`` = row_number() OVER (ORDER BY all its columns).

    The tables are stacked, columns of one position and type one below the
    other, so that one range partitioning and one write serve them all. Their
    rows lie together in the files, so a table reads its own row groups."""
    stacked, columns, slots = None, {}, set()
    for i, (table, df) in enumerate(tables.items()):
        columns[table] = {c: f"_{at}_{t}" for at, (c, t) in enumerate(df.dtypes)}
        slots |= {(at, slot) for at, slot in enumerate(columns[table].values())}
        part = df.select(F.lit(i).alias("_table"), *[F.col(f"`{c}`").alias(slot) for c, slot in columns[table].items()])
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    spark, path = stacked.sparkSession, run_folder(stacked.sparkSession, "numbered") + "/rows"
    keys = ["_table", *[f"`{slot}`" for _, slot in sorted(slots)]]
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    (stacked.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
     .withColumn("_at", F.monotonically_increasing_id()).write.parquet(path))
    placed = spark.read.schema(stacked.withColumn("_at", F.lit(0).cast("long")).schema).parquet(path)
    places, out = _places(placed, ["_table"]), {}
    for i, table in enumerate(tables):
        number = _place(places.get((i,), []))
        out[table] = placed.where(F.col("_table") == i).select(
            *[F.col(f"`{slot}`").alias(c) for c, slot in columns[table].items()], number.alias(name))
    return out


def surrogate_keys(df: DataFrame, order: Sequence[str | Column], name: str,
                   offset: int | Column = 0) -> DataFrame:
    """Dense surrogate keys offset+1, offset+2, ... in ``order`` (0 is
    reserved for the unknown member)."""
    start = (offset + 1) if not isinstance(offset, Column) else (offset + F.lit(1))
    return dense_number(df, order, name, group=(), start=start)


def current_max(df: DataFrame, name: str) -> int:
    """Largest existing key (0 for an empty table): a one-number action."""
    v = df.agg(F.max(name)).first()[0]
    return int(v or 0)
