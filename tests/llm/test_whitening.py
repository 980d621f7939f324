import numpy as np
import pytest

from quillmart.llm import queries, whitening
from tests.llm.conftest import SF


def expected(vectors, k=8):
    """n, deviations, whitened coordinates (up to sign) and explained shares
    from the full covariance matrix."""
    x = np.floor(1024 * np.asarray(vectors, float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    value, vector = value[::-1][:k], vector[:, ::-1][:, :k]
    deviation = [sum(int(v) ** 2 for v in n * row - sums) for row in x]
    return deviation, centred @ vector / np.sqrt(value), value / (centred ** 2).sum() * n


def held(got, ids, vectors, k=8):
    deviation, z, share = expected(vectors, k)
    at = {i: p for p, i in enumerate(ids)}
    found = np.zeros_like(z)
    assert len(got) == z.size
    for r in got:
        p, c = at[r["vec_id"]], r["component"] - 1
        found[p, c] = r["whitened"]
        assert r["n"] == len(ids) and r["deviation"] == deviation[p]
        assert r["explained"] == pytest.approx(share[c], rel=1e-9)
    signs = np.sign((found * z).sum(0))
    assert np.abs(found - z * signs).max() < 1e-8


def test_query_against_the_full_matrix(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = queries.op12_embedding_whitening(spark, SF).collect()
    assert max(r["identity_error"] for r in got) < 1e-9
    held(got, [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def test_bad_vectors_extra_columns_and_few_dimensions(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(v) for v in rng.normal(size=3) * [5, 1, 0.2]]) for i in range(40)] + [(40, [1.0, 2.0, 3.0])]
    bad = [(50, None), (51, [1.0, None, 2.0]), (52, [float("nan"), 1.0, 1.0]), (53, [float("inf"), 0.0, 0.0]), (54, []), (55, [1.0]), (56, [1e300, 0.0, 0.0])]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").selectExpr("*", "1 AS x", "2 AS v", "3 AS ids").repartition(4)
    blocks = whitening.blocks(df)
    model = whitening.fit(blocks)
    held(whitening.whitened(blocks, model).collect(), [i for i, _ in good], [v for _, v in good], 3)
    assert whitening.identity_error(blocks, model) < 1e-9


def test_empty_constant_and_repeated_rows(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])] * 3):
        blocks = whitening.blocks(spark.createDataFrame(rows, schema))
        model = whitening.fit(blocks)
        assert whitening.whitened(blocks, model).count() == 0 and whitening.identity_error(blocks, model) == 0
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [3.0, 0.0])]
    blocks = whitening.blocks(spark.createDataFrame(rows, schema))
    got = whitening.whitened(blocks, whitening.fit(blocks)).collect()
    assert sorted((r["vec_id"] or 0, r["component"], round(abs(r["whitened"]), 6)) for r in got) == [(0, 1, 1.414214), (1, 1, 0.707107), (1, 1, 0.707107)]


@pytest.mark.parametrize("d,gap", [(40, 1e-6), (150, 1e-3), (300, 0.0)])
def test_leading_pairs_of_close_eigenvalues(d, gap):
    rng = np.random.default_rng(d)
    q = np.linalg.qr(rng.normal(size=(d, d)))[0]
    values = np.concatenate(([3, 2, 2 - gap, 1.9, 1.5, 1.2, 1.1, 1.05], rng.random(d - 8)))
    a = (q * values) @ q.T
    got, vectors = whitening.leading_pairs(lambda x: a @ x, d, 8)
    assert np.abs(got - values[:8]).max() < 1e-12 and np.abs(a @ vectors - vectors * got).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-13


def test_deviations_beyond_a_long():
    x = np.array([[2 ** 40, 0], [0, 0], [1, 1]])
    assert whitening.deviations(x, 3, x.sum(0)) == [None, None, None]
    assert whitening.deviations(x[1:], 2, x[1:].sum(0)) == [2, 2]
