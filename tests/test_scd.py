"""SCD type 2: every change kind, vanished keys, idempotence, one version."""

import datetime as dt

from pyspark.sql import functions as F

from quillmart.operators import scd

SPEC = scd.ScdSpec("dim_t", "sk", ("k",), ("a", "b"))
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


def snap(spark, rows):
    return spark.createDataFrame(rows, "k int, a string, b string")


def test_merge_cases(spark):
    v1 = snap(spark, [(1, "x", "p"), (2, "x", "p"), (3, None, "p"), (4, "x", "p"), (5, None, "p"), (6, "gone", "p")])
    cur = scd.scd2_initial(v1, SPEC, "2024-01-01")
    s2 = snap(spark, [(1, "x", "p"),       # unchanged
                      (2, "y", "p"),       # changed
                      (3, "now", "p"),     # NULL -> value
                      (4, None, "p"),      # value -> NULL
                      (5, None, "p"),      # NULL -> NULL (unchanged)
                      (7, "new", "p")])    # new key; 6 vanished
    out = {(r.k, r.valid_from, r.is_current): r for r in scd.scd2_merge(cur, s2, SPEC, "2024-02-01").collect()}
    cur_rows = {r.k: r for r in out.values() if r.is_current}
    assert sorted(cur_rows) == [1, 2, 3, 4, 5, 6, 7]
    assert cur_rows[1].valid_from == D1 and cur_rows[5].valid_from == D1 and cur_rows[6].valid_from == D1
    for k, a in [(2, "y"), (3, "now"), (4, None), (7, "new")]:
        assert cur_rows[k].valid_from == D2 and cur_rows[k].a == a and cur_rows[k].valid_to is None
    expired = sorted((r.k, r.valid_to) for r in out.values() if not r.is_current)
    assert expired == [(2, D2), (3, D2), (4, D2)]
    sks = [r.sk for r in out.values()]
    assert len(sks) == len(set(sks)) and max(sks) == 6 + 4


def test_same_snapshot_twice_changes_nothing(spark):
    v1 = snap(spark, [(1, "x", None), (2, "y", "q")])
    cur = scd.scd2_initial(v1, SPEC, "2024-01-01")
    once = scd.scd2_merge(cur, v1, SPEC, "2024-02-01")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, cur.collect()))


def test_at_most_one_current_and_as_of(spark):
    v1 = snap(spark, [(i, "a", "b") for i in range(20)])
    cur = scd.scd2_initial(v1, SPEC, "2024-01-01")
    s2 = snap(spark, [(i, "a" if i % 2 else "c", "b") for i in range(25)])
    m = scd.scd2_merge(cur, s2, SPEC, "2024-02-01")
    assert m.where("is_current").groupBy("k").count().where("count > 1").count() == 0
    # half-open validity: on the load day only the new version is valid
    assert scd.as_of(m, "2024-02-01").groupBy("k").count().where("count > 1").count() == 0
    assert scd.as_of(m, "2024-01-15").count() == 20


def test_one_version_per_key(spark):
    s = spark.createDataFrame([(1, "z", None, 1), (1, "a", "z", 2), (2, None, "q", 1), (3, "x", None, 5), (3, "x", "y", 5)],
                              "k int, a string, b string, t int")
    got = sorted(map(tuple, scd.one_version_per_key(s, SPEC, ["t"]).collect()))
    assert got == [(1, "a", "z"), (2, None, "q"), (3, "x", "y")]  # the newest; a tie goes to the greatest tuple
    assert [tuple(r) for r in scd.stamp_ties(s, SPEC, ["t"]).collect()] == [(3, 2)]


def test_many_dimensions_numbered_together(spark):
    other = scd.ScdSpec("dim_u", "u_sk", ("id",), ("k",))
    v = snap(spark, [(i, "a", None) for i in range(30)])
    u = spark.createDataFrame([("u%02d" % i, i) for i in range(20)], "id string, k int")
    got = scd.scd2_initial_many({"t": v, "u": u}, {"t": SPEC, "u": other}, "2024-01-01")
    for d, s, spec in ((got["t"], v, SPEC), (got["u"], u, other)):
        assert sorted(map(tuple, d.collect())) == sorted(map(tuple, scd.scd2_initial(s, spec, "2024-01-01").collect()))


def test_staff_and_movers_get_their_versions(spark):
    from quillmart.plans import pipeline as P
    dim = P.reloaded_dimension(spark, "/root/testdata/sf0.01", "dim_staff").collect()
    changed = {r.staff_id for r in dim if r.valid_from == dt.date(2024, 2, 2)}
    assert {f"S{i}" for i in range(0, 100, 10)} <= changed  # every tenth staff member changes level
    assert [r for r in dim if r.staff_sk == 0] and all(r.staff_id for r in dim if r.staff_sk)
    # A new address alone makes a new version.
    from quillmart.plans.star import ADDRESS, with_location_sk
    loc_spec, spec = P.SCD_SPECS["dim_location"], scd.ScdSpec("d", "sk", ("id",), ("location_sk",), ("id",))
    places = spark.createDataFrame([("1 A St", "X", None, "US"), ("2 B St", "Y", "CA", "US")], ", ".join(f"{c} string" for c in ADDRESS))
    loc = scd.with_unknown_member(scd.scd2_initial(places, loc_spec, "2024-01-01"), loc_spec)
    home = spark.createDataFrame([("u", "1 A St", "X", None, "US"), ("v", "9 Z St", "X", None, "US")], "id string, " + ", ".join(f"{c} string" for c in ADDRESS))
    moved = home.selectExpr("id", "'2 B St' AS street", "'Y' AS city", "'CA' AS state", "country")
    first = scd.scd2_initial(with_location_sk(home, loc), spec, "2024-01-01")
    second = scd.scd2_merge(first, with_location_sk(moved, loc), spec, "2024-02-01").collect()
    assert sorted((r.id, r.location_sk, r.is_current) for r in second) == [
        ("u", 1, False), ("u", 2, True), ("v", 0, False), ("v", 2, True)]


def test_null_part_of_natural_key_matches(spark):
    # an address with a NULL part is the same address in the next snapshot
    spec = scd.ScdSpec("dim_loc", "sk", ("street", "state"), ())
    v1 = spark.createDataFrame([("1 Main", None), ("2 Main", "CA")], "street string, state string")
    cur = scd.scd2_initial(v1, spec, "2024-01-01")
    s2 = spark.createDataFrame([("1 Main", None), ("3 Main", None)], "street string, state string")
    rows = scd.scd2_merge(cur, s2, spec, "2024-02-01").collect()
    assert sorted((r.street, r.sk, r.is_current) for r in rows) == [
        ("1 Main", 1, True), ("2 Main", 2, True), ("3 Main", 3, True)]


def test_pipeline_reload_properties(spark):
    from quillmart.plans import pipeline as P

    SF0001 = "/root/testdata/sf0.001"

    for name in ["dim_user", "dim_location"]:
        spec = P.SCD_SPECS[name]
        dim = P.reloaded_dimension(spark, SF0001, name).cache()
        # at most one current version per natural key, keys unique
        stats = dim.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(spec.sk).alias("sks")).first()
        assert stats.n == stats.sks
        assert dim.where("is_current").groupBy(*spec.key).count().where("count > 1").count() == 0
        # applying the same snapshot again changes nothing
        places = P.reloaded_dimension(spark, SF0001, "dim_location")
        snap = P.unique_snapshot(name, P.snapshots(spark, SF0001)[name], places)
        again = scd.scd2_merge(dim, snap, spec, "2024-03-03")
        assert again.exceptAll(dim).union(dim.exceptAll(again)).count() == 0
        dim.unpersist()
