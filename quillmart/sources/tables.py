"""Reading the warehouse's input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table ``<sf_dir>/<name>.parquet``, as Spark splits it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_for_row_work(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows are worked on one by one right after the scan. A
    deployment whose inputs come as a few large row groups may name the number
    of partitions to deal them out to (``spark.quillmart.inputPartitions``);
    unset, which is the default, the table stays as Spark splits it."""
    df, n = read_table(spark, sf_dir, name), spark.conf.get("spark.quillmart.inputPartitions", None)
    return df.repartition(int(n)) if n else df
