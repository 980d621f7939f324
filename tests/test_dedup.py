"""The three dedup policies: golden cases, properties and plan shape."""

import datetime as dt

from pyspark.sql import functions as F

from quillmart.operators import dedup as D

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
SCHEMA = "k string, a string, b int, ts timestamp_ntz"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_wins_cases(spark):
    data = [
        ("one", "x", 1, T1),                                   # single row
        ("two", "old", 1, T1), ("two", "new", 2, T2),          # two stamps -> newest
        ("same", "x", 1, T2), ("same", "x", 1, T2),            # identical at newest -> one
        ("conf", "x", 1, T2), ("conf", "y", 1, T2),            # disagree at newest -> dropped
        ("oldc", "x", 1, T1), ("oldc", "y", 1, T1), ("oldc", "z", 3, T2),  # conflict only older
        ("nul", None, 1, T2), ("nul", None, 1, T2),            # NULL equal on both -> kept once
        (None, "x", 1, T2),                                    # NULL key -> dropped
    ]
    df = spark.createDataFrame(data, SCHEMA)
    got = rows(D.latest_wins(df, ["k"], ["a", "b"], "ts"))
    assert got == sorted([("one", "x", 1), ("two", "new", 2), ("same", "x", 1), ("oldc", "z", 3),
                          ("nul", None, 1)])


def test_latest_wins_idempotent_and_order_free(spark):
    data = [(f"k{i % 5}", f"v{i % 3}", i % 2, T1 if i % 4 else T2) for i in range(40)]
    df = spark.createDataFrame(data, SCHEMA)
    once = D.latest_wins(df, ["k"], ["a", "b"], "ts")
    again = D.latest_wins(once.withColumn("ts", F.lit(T1)), ["k"], ["a", "b"], "ts")
    assert rows(once) == rows(again)
    shuffled = spark.createDataFrame(list(reversed(data)), SCHEMA).repartition(3)
    assert rows(once) == rows(D.latest_wins(shuffled, ["k"], ["a", "b"], "ts"))


def test_latest_wins_never_sorts_raw_rows(spark):
    df = spark.createDataFrame([("a", "x", 1, T1)], SCHEMA)
    plan = D.latest_wins(df, ["k"], ["a", "b"], "ts")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    scan = [line for line in plan.split("\n") if "Scan" in line]
    below = plan.split("\n")
    for i, line in enumerate(below):  # whatever reads the raw rows aggregates them by hash first
        if "Scan" in line:
            above = [x for x in below[:i] if "Aggregate" in x or "Sort " in x]
            assert "HashAggregate" in above[-1]
    assert scan


def test_stamps_ignore_the_session_zone(spark):
    from quillmart.functions import text as T
    zone = spark.conf.get("spark.sql.session.timeZone")
    gap = [("k", "old", 1, dt.datetime(2024, 3, 10, 2, 30)), ("k", "new", 2, dt.datetime(2024, 3, 10, 3, 30))]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(k, a, b, t.isoformat(" ")) for k, a, b, t in gap], "k string, a string, b int, t string")
        df = df.withColumn("ts", T.parse_timestamp("t"))
        assert sorted(r.ts.isoformat(" ") for r in df.collect()) == ["2024-03-10 02:30:00", "2024-03-10 03:30:00"]
        assert rows(D.latest_wins(df, ["k"], ["a", "b"], "ts")) == [("k", "new", 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_ranked_stamps(spark):
    data = [("a", "x", 1, T1), ("a", "x", 1, T2), ("a", "y", 1, T2), ("b", "x", 1, None)]
    got = rows(D.ranked_stamps(spark.createDataFrame(data, SCHEMA), ["k"], "ts"))
    assert [(k, n, r) for k, _, n, r in got if k == "a"] == [("a", 1, 2), ("a", 2, 1)]


def test_exact_rows_policies(spark):
    data = [("a", None, 1, T1), ("a", None, 1, T2), ("b", "x", 2, T1), ("b", "x", 2, T1)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(D.exact_rows(df, ["k", "a", "b"])) == sorted([("a", None, 1), ("b", "x", 2)])
    assert rows(D.exact_rows_no_nulls(df, ["k", "a", "b"], "ts")) == [("b", "x", 2)]


def test_hot_key(spark):
    """A key holding most rows collapses in the partial aggregate."""
    data = [("hot", "x", 1, T1)] * 500 + [("hot", "x", 1, T2)] * 300 + [("c", "y", 2, T1)]
    df = spark.createDataFrame(data, SCHEMA).repartition(8)
    assert rows(D.latest_wins(df, ["k"], ["a", "b"], "ts")) == [("c", "y", 2), ("hot", "x", 1)]
