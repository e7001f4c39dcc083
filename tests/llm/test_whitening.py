import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import whitening as W
from tallyspark.llm.queries import op11_whitening

SCHEMA = "vec_id long, embedding array<float>, n string, component string, x string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "n", "c", "x") for i, v in vectors], SCHEMA)


def check(rows, vectors, k=4):
    """The rows against numpy's eigenvectors of the same covariance."""
    x = {i: np.array([math.floor(256 * float(np.float32(c))) for c in v], object) for i, v in vectors}
    fit = np.array(sorted({tuple(v) for v in x.values()}), np.float64)
    n = len(fit)
    mean = fit.mean(axis=0)
    values, axes = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    values, axes = values[::-1], axes[:, ::-1]
    sums = [sum(int(v) for v in c) for c in fit.T]
    sign = {}
    assert len(rows) == len(vectors) * min(k, int((values > 1e-9 * values[0]).sum()))
    for r in rows:
        v, j = x[r.vec_id], r.component - 1
        want = (v.astype(np.float64) - mean) @ axes[:, j] / math.sqrt(values[j])
        if abs(want) > 1e-6:
            assert sign.setdefault(j, want * r.whitened > 0) == (want * r.whitened > 0)
        assert abs(abs(want) - abs(r.whitened)) < 1e-7
        assert (r.n, int(r.deviation)) == (n, sum((n * int(c) - s) ** 2 for c, s in zip(v, sums, strict=True)))
        assert math.isclose(r.explained, values[j] / values.sum(), rel_tol=1e-9) and r.identity_error < 1e-9


def test_whiten_equals_numpy(spark):
    rnd = np.random.default_rng(5)
    vectors = [(i, (rnd.normal(size=7) * [3, 2, 1.5, 1, 0.8, 0.1, 0.5]).tolist()) for i in range(60)]
    vectors += [(100 + i, vectors[i][1]) for i in range(30)] + [(100, vectors[0][1]), (None, vectors[4][1])]
    odd = [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0, 0.0]), (202, [float("nan")] * 7), (203, [float("inf")] + [0.0] * 6)]
    check(W.whiten(frame(spark, vectors + odd)).collect(), vectors)


def test_whiten_of_large_entries_and_short_vectors(spark):
    rnd = np.random.default_rng(6)
    vectors = [(i, (rnd.normal(size=5) * 2**22).round().tolist()) for i in range(40)]
    check(W.whiten(frame(spark, vectors)).collect(), vectors)
    short = [(i, v[: 5 - i % 3]) for i, v in vectors] + [(90, [])]
    check(W.whiten(frame(spark, short)).collect(), [(i, [*v, *[0.0] * (5 - len(v))]) for i, v in short])


def test_whiten_of_nothing_and_of_one_vector(spark):
    kinds = W.whiten(frame(spark, [])).dtypes
    for vectors in ([], [(1, None)], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])], [(1, [])]):
        found = W.whiten(frame(spark, vectors))
        assert found.collect() == [] and found.dtypes == kinds
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)]  # rank one: one component
    check(W.whiten(frame(spark, line)).collect(), line)


def test_equal_eigenvalues_share_a_null_space(spark):
    corners = [(i, [float(i >> b & 1) for b in range(3)]) for i in range(8)]
    rows = W.whiten(frame(spark, corners), k=3).collect()
    w = np.zeros((8, 3))
    for r in rows:
        w[r.vec_id, r.component - 1] = r.whitened
    assert np.allclose(w.T @ w / 8, np.eye(3), atol=1e-12) and all(math.isclose(r.explained, 1 / 3) for r in rows)


@pytest.mark.parametrize("d", [1, 2, 9])
def test_characteristic_polynomial_and_roots(spark, d):
    rnd = np.random.default_rng(d)
    a = rnd.integers(-50, 50, (d, d)).astype(object)
    m = (a.T @ a).tolist()
    e = W.characteristic(spark, m)
    values = np.linalg.eigvalsh(np.array(m, np.float64))[::-1]
    assert e[0] == 1 and e[1] == sum(m[i][i] for i in range(d))
    assert np.allclose([float(x) for x in e], [1, *[sum(np.prod(c) for c in __import__("itertools").combinations(values, k)) for k in range(1, d + 1)]], rtol=1e-6)
    for i, v in enumerate(values[:4]):
        low, high, shift, above = W.isolate(e, i + 1)
        assert above == i and math.isclose(high / 2**shift, v, rel_tol=1e-6)
        assert W.roots_above([x << shift * k for k, x in enumerate(e)], low) == i + 1


def test_near_equal_eigenvalues_come_apart():
    big = 10**30
    m = [[big, 1, 0], [1, big, 0], [0, 0, 5]]  # roots big + 1, big - 1, 5
    e = [1, 2 * big + 5, big * big - 1 + 10 * big, 5 * (big * big - 1)]
    (r1, v1), (r2, v2), (r3, v3) = (W.component(m, e, i) for i in (1, 2, 3))
    assert (round(r1 - big), round(r2 - big), round(r3)) == (1, -1, 5)
    h = math.sqrt(0.5)
    for v, want in ((v1, [h, h, 0]), (v2, [h, -h, 0]), (v3, [0, 0, 1])):
        assert np.allclose(np.abs(v), np.abs(want), atol=1e-15) and abs(abs(np.dot(v, want)) - 1) < 1e-12


def test_query_on_the_embeddings(spark):
    sf = "/root/testdata/sf0.001"
    got = op11_whitening(spark, sf)
    assert dict(got.dtypes)["deviation"] == "bigint" and dict(got.dtypes)["component"] == "int"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>")).collect()
    check(got.collect(), [(r[0], r[1]) for r in rows])
