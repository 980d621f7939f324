"""Merge joins, and no join forced to broadcast."""

from quillmart.operators import joins


def test_keep_left_and_coalesce(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(1, "y", 10), (2, "z", 20)], "k int, v string, w int")
    assert sorted(map(tuple, joins.join_keep_left(a, b, ["k"]).collect())) == [(1, "x", 10), (2, None, 20)]
    assert sorted(map(tuple, joins.join_coalesce(a, b, ["k"]).select("k", "v", "w").collect())) == [(1, "x", 10), (2, "z", 20)]


def test_outer_merge_keeps_left_values(spark):
    a = spark.createDataFrame([(0, "a0"), (1, "a1")], "i int, v string")
    b = spark.createDataFrame([(1, "b1"), (2, "b2")], "i int, v string")
    got = joins.outer_merge_keep_left([a, b], "i").select("i", "v").collect()
    assert sorted(map(tuple, got)) == [(0, "a0"), (1, "a1"), (2, None)]


def test_no_forced_broadcast():
    import pathlib

    root = pathlib.Path(joins.__file__).parents[1]
    for f in root.rglob("*.py"):
        if "llm" not in f.parts:
            assert "broadcast(" not in f.read_text().replace("q_broadcast_index_join(", ""), f
