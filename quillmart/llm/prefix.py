"""Running sums within ordered groups, for groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmart.llm.common import cut


def running(df: DataFrame, group: list[str], order: list[str], values: list[str]) -> DataFrame:
    """``df`` with ``idx`` (place in its group, from 0) and ``<value>_before``
    (sum of the value over the rows before) per value.

    The rows are range-partitioned on group and order, so a hot group spreads
    over many partitions, and checkpointed (range bounds are sampled). Sums run
    within a (partition, group); each such fragment then gets the totals of the
    group's fragments before it, of which there are at most as many as
    partitions. Ties in ``order`` must be repeated rows."""
    keys = [F.col(c) for c in group + order]
    spread = cut(df.repartitionByRange(*keys).sortWithinPartitions(*keys)).withColumn("__p", F.spark_partition_id())
    local = Window.partitionBy("__p", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = spread.withColumns({"idx": F.coalesce(F.count(F.lit(1)).over(local), F.lit(0))}
                                | {f"{v}_before": F.coalesce(F.sum(v).over(local), F.lit(0)) for v in values})
    earlier = Window.partitionBy(*group).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    totals = spread.groupBy("__p", *group).agg(F.count("*").alias("__n"), *(F.sum(v).alias(f"__{v}") for v in values))
    offsets = totals.select("__p", *group, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__n"),
                            *(F.coalesce(F.sum(f"__{v}").over(earlier), F.lit(0)).alias(f"__{v}") for v in values))
    out = inside.join(offsets, ["__p", *group])
    return out.select(*df.columns, (F.col("idx") + F.col("__n")).alias("idx"),
                      *((F.col(f"{v}_before") + F.col(f"__{v}")).alias(f"{v}_before") for v in values))
