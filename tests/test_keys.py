"""Distributed dense numbering equals the window definition."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quillmart.operators import keys


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("kind", ["mixed", "hot", "calm", "empty"])
def test_dense_number_matches_window(spark, kind):
    ids = spark.range(0, 0 if kind == "empty" else 1100)
    group = {"mixed": F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 50),
             # one group holds 1000 rows, others 10 each
             "hot": F.when(F.col("id") < 1000, F.lit(0)).otherwise(1 + F.col("id") % 10),
             "calm": F.col("id") % 110, "empty": F.col("id")}[kind]
    df = ids.select(group.alias("g"), (F.col("id") * 7919 % 1103).alias("o"))
    got = keys.dense_number(df, ["o"], "n", group=["g"])
    same(got, df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("o")).cast("long")))


def test_hot_group_spreads_over_partitions(spark):
    df = spark.range(0, 20000).select(F.lit(1).alias("g"), "id")
    got = keys.dense_number(df, ["id"], "n", group=["g"], num_partitions=6)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_pid" in plan
    assert [r.n for r in got.orderBy("id").limit(5).collect()] == [1, 2, 3, 4, 5] and got.agg(F.max("n")).first()[0] == 20000


def test_surrogate_keys_offset(spark):
    df = spark.range(0, 500).select((F.col("id") * 13 % 500).alias("k"))
    got = keys.surrogate_keys(df, ["k"], "sk", offset=100).collect()
    assert sorted((r.k, r.sk) for r in got) == [(k, k + 101) for k in range(500)]


def test_checkpoint_folder_must_be_shared():
    from types import SimpleNamespace

    from quillmart.session import ensure_checkpoint_dir
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(fake)


def test_numbering_shuffles_the_rows_once(spark):
    """Groups that cross partitions, NULL parts and values of other types; the
    numbers come without a join or another exchange."""
    df = spark.range(0, 9000).select(
        F.when(F.col("id") % 4 > 0, F.col("id") % 3).alias("g"), F.when(F.col("id") % 5 > 0, F.lit("x")).alias("h"), "id",
        (F.col("id") / 7).cast("decimal(10,2)").alias("price"), F.lit("2024-01-01").cast("timestamp_ntz").alias("at"))
    got = keys.dense_number(df, ["id"], "n", group=["g", "h"], num_partitions=13)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    expected = df.withColumn("n", F.row_number().over(Window.partitionBy("g", "h").orderBy("id")).cast("long"))
    assert got.dtypes == expected.dtypes
    same(got, expected)


def test_tables_are_numbered_without_python_and_read_by_column(spark):
    """Several tables of other types, one empty, numbered on their own; reading
    one takes its own columns from the files and no Python worker."""
    ids = spark.range(0, 3000)
    tables = {"a": ids.select(F.concat(F.lit("k"), (F.col("id") * 7919 % 3001).cast("string")).alias("k"), (F.col("id") % 5).cast("decimal(6,2)").alias("v")),
              "b": ids.where("id < 40").select((F.col("id") * 13 % 41).alias("n"), F.when(F.col("id") % 3 > 0, F.lit("x")).alias("k")),
              "c": ids.where("id < 0").select(F.col("id").alias("n"))}
    got = keys.number_tables(tables, "sk")
    for name, df in tables.items():
        expected = df.withColumn("sk", F.row_number().over(Window.orderBy(*df.columns)).cast("long"))
        assert got[name].dtypes == expected.dtypes
        same(got[name], expected)
    plan = got["a"].select("k", "sk")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Exchange" not in plan and "decimal" not in plan
    assert "MapInArrow" not in keys.surrogate_keys(tables["a"], ["k"], "sk")._jdf.queryExecution().executedPlan().toString()


def test_small_groups_are_numbered_without_python_and_stay_partitioned(spark):
    """No Python worker, and no shuffle of the rows for a join on the group; the
    result is the window's, also for groups that are too large for it."""
    df = spark.range(0, 4000).select(
        F.when(F.col("id") < 900, F.lit("hot")).when(F.col("id") < 1700, F.lit(None)).otherwise((F.col("id") % 300).cast("string")).alias("g"),
        (F.col("id") * 7919 % 4001).alias("o.o"), F.lit("x y").alias("a b"))
    expected = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("`o.o`")).cast("long"))
    got = keys.number_small_groups(df, ["o.o"], "n", ["g"])
    assert got.dtypes == expected.dtypes
    same(got, expected)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = got.join(df.select("g").distinct(), "g")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "MapInArrow" not in plan and plan.count("Exchange") == 2  # the window's, the other side's
    plain = df.toDF("g", "o", "a")
    hot = keys.number_small_groups(plain, ["o"], "n", ["g"], hot_rows=500)
    assert "_pid" in hot._jdf.queryExecution().optimizedPlan().toString()
    same(hot, expected.toDF("g", "o", "a", "n"))
    same(keys.number_small_groups(plain.where("false"), ["o"], "n", ["g"]), expected.where("false").toDF("g", "o", "a", "n"))
