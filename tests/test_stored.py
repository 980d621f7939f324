"""Stored tables: committed versions, the stored dimension, the audit."""

import tempfile

import pytest
from pyspark.sql import functions as F

from quillmart.operators import scd
from quillmart.operators.stored_scd import StoredDimension
from quillmart.sources import sinks, versions

SPEC = scd.ScdSpec("dim_t", "sk", ("k",), ("a", "b"))


def folder():
    return tempfile.mkdtemp(dir="/tmp")


def snap(spark, rows):
    return spark.createDataFrame(rows, "k int, a string, b string")


def rows_of(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def test_of_two_writers_one_commits(spark):
    path = folder()
    assert versions.latest(spark, path) == (0, {})
    assert versions.commit(spark, path, 0, {"a": 1}) == 1
    with pytest.raises(versions.Conflict):
        versions.commit(spark, path, 0, {"a": 2})
    assert versions.commit(spark, path, 1, {"a": 3}) == 2 and versions.latest(spark, path) == (2, {"a": 3})
    open(f"{path}/_versions/{3:012d}.json", "w").close()  # another writer is just writing it
    assert versions.latest(spark, path) == (2, {"a": 3})


def test_three_loads_equal_merges_in_memory(spark):
    dim = StoredDimension(spark, folder(), SPEC, buckets=4)
    days = [("2024-01-01", [(i, "x", "p") for i in range(20)] + [(None, "n", None)]),
            ("2024-02-01", [(i, "x" if i % 3 else "y", "p" if i % 5 else None) for i in range(25)] + [(None, "n", None)]),
            ("2024-03-01", [(i, "x", "p") for i in range(10)] + [(None, "m", None)])]
    plain = None
    for day, rows in days:
        dim.load(snap(spark, rows), day)
        plain = scd.scd2_initial(snap(spark, rows), SPEC, day) if plain is None else scd.scd2_merge(plain, snap(spark, rows), SPEC, day)
        plain = plain.checkpoint()
        assert rows_of(dim.all_versions()) == rows_of(plain)
    assert rows_of(dim.current()) == rows_of(plain.where("is_current"))


def test_a_load_rewrites_touched_buckets_and_reads_no_history(spark):
    import shutil
    dim = StoredDimension(spark, folder(), SPEC, buckets=8)
    dim.load(snap(spark, [(i, "x", "p") for i in range(200)]), "2024-01-01")
    dim.load(snap(spark, [(i, "y", "p") for i in range(200)]), "2024-02-01")
    before = versions.latest(spark, dim.path)[1]
    shutil.rmtree(f"{dim.path}/history")  # a load that read it would fail
    assert dim.load(snap(spark, [(7, "z", "p"), (500, "new", "p")]), "2024-03-01") == 3
    after = versions.latest(spark, dim.path)[1]
    touched = {str(r[0]) for r in snap(spark, [(7, "", ""), (500, "", "")]).select(dim._bucket()).collect()}
    assert {b for b in after["current"] if after["current"][b] != before["current"].get(b)} == touched and len(touched) < 8
    assert dim.current().count() == 201 and dim.current().where("k = 7").first()["a"] == "z"
    files = dim.current([int(b) for b in touched]).inputFiles()
    assert files and all(any(after["current"][b] in f for b in touched) for f in files)
    assert after["max_sk"] == 402
    assert dim.load(snap(spark, [(7, "z", "p")]), "2024-04-01") == 3  # nothing changed: no new version


def test_of_two_loads_at_a_time_one_starts_again(spark, monkeypatch):
    dim = StoredDimension(spark, folder(), SPEC, buckets=2)
    dim.load(snap(spark, [(1, "x", "p")]), "2024-01-01")
    old = versions.latest(spark, dim.path)
    dim.load(snap(spark, [(1, "y", "p")]), "2024-02-01")
    real = versions.latest
    monkeypatch.setattr(versions, "latest", lambda *a: old)
    with pytest.raises(versions.Conflict):
        dim.load(snap(spark, [(1, "z", "p")]), "2024-02-02")
    monkeypatch.setattr(versions, "latest", real)
    dim.load(snap(spark, [(1, "z", "p")]), "2024-02-02")
    assert [r["a"] for r in dim.all_versions().orderBy("sk").collect()] == ["x", "y", "z"]


def test_overlapping_audit_runs_keep_both_entries(spark, monkeypatch):
    path = folder()
    schema = "schema_name string, table_name string, last_ingested_at int"
    entries = lambda *rows: spark.createDataFrame(list(rows), schema)
    sinks.commit_audit(entries(("raw", "a", 5)), path)
    real, stale = versions.latest, [versions.latest(spark, path)]
    sinks.commit_audit(entries(("raw", "b", 7), ("raw", "a", 3)), path)
    monkeypatch.setattr(versions, "latest", lambda *a: stale.pop() if stale else real(*a))
    assert sinks.commit_audit(entries(("raw", "c", 1), ("raw", "a", 9)), path) == 3  # read version 1, found 2 committed
    assert rows_of(sinks.read_audit(spark, path)) == [(1, "raw", "c"), (7, "raw", "b"), (9, "raw", "a")]
    with pytest.raises(FileNotFoundError):
        sinks.read_audit(spark, folder())


def test_an_incremental_load_skips_files(spark):
    from quillmart.sources.stored_fact import StoredFact
    fact = StoredFact(spark, folder(), "order_id")
    rows = lambda a, b: spark.range(a, b).select(F.format_string("O%06d", "id").alias("order_id"), "id")
    assert fact.files_for(rows(0, 1)) == []
    for a in (0, 1000, 2000):
        fact.load(rows(a, a + 1000))
    every, met = set(fact.read().inputFiles()), fact.files_for(rows(2990, 3100))
    assert 0 < len(met) <= len(every) / 3
    existing = fact.loaded(rows(2990, 3100), ["order_id"])
    assert len(existing.inputFiles()) == len(met) and existing.count() <= 1000
    new = rows(2990, 3100).join(existing, "order_id", "left_anti")
    assert new.count() == 100
    fact.load(new)
    assert fact.read().count() == 3100 and fact.read().select("order_id").distinct().count() == 3100
    assert fact.loaded(rows(9000, 9001), ["order_id"]).count() == 0
    fact.load(rows(0, 5), "truncate")
    assert fact.read().count() == 5
    with pytest.raises(ValueError):
        fact.load(rows(0, 5), "replace")


def test_streaming_latest_wins_equals_the_batch_form(spark):
    import random
    from quillmart.operators.dedup import latest_wins
    from quillmart.streaming.latest import LatestTable, ingest_latest
    rng = random.Random(3)
    schema = "k int, a string, b int, t int"
    rows = [(rng.choice([None, *range(40)]), rng.choice(["x", "y", None]), rng.choice([1, None]), rng.choice([None, 1, 2, 3])) for _ in range(400)]
    base = folder()
    table = LatestTable(spark, f"{base}/table", ["k"], ["a", "b"], "t", buckets=4)
    with pytest.raises(FileNotFoundError):
        table.read()
    for arrived in (rows[:150], rows[150:300], rows[300:]):
        spark.createDataFrame(arrived, schema).repartition(3).write.mode("append").parquet(f"{base}/in")
        assert ingest_latest(spark, f"{base}/in", table, f"{base}/checkpoint", max_files=2) > 0
        so_far = spark.read.parquet(f"{base}/in")
        assert rows_of(table.read()) == rows_of(latest_wins(so_far, ["k"], ["a", "b"], "t"))
    before = versions.latest(spark, table.path)
    table.upsert(spark.createDataFrame([(1, "other", 9, 99)], schema), before[1]["batch"])  # a batch that is run again
    assert versions.latest(spark, table.path) == before
