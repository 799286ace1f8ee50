"""Whitening against numpy on the whole table, with exact integers in Python."""

import math

import numpy as np
import pytest

from geoscribe.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, id string, x int, n int"


def check(rows, vectors, tol=1e-8):
    """``rows`` of the operator against brute force over ``vectors``: (id, list) pairs in table order."""
    def good(v):
        return v is not None and all(c is not None and math.isfinite(c) for c in v)

    xs = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in vectors if good(v)]
    fit = sorted({tuple(x) for _, x in xs})
    n, d = len(fit), len(fit[0])
    sums = [sum(v[j] for v in fit) for j in range(d)]
    a = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    cov = a.T @ a / n
    values = np.sort(np.linalg.eigvalsh(cov))[::-1]
    k = min(4, int((values > 1e-12 * values[0]).sum()))
    by_id = {}
    for r in rows:
        by_id.setdefault(r.id, []).append(r)
    assert len(rows) == k * len(xs)
    white = {}
    for i, x in xs:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        mine = sorted(by_id[i], key=lambda r: r.component)
        assert {r.component for r in mine} == set(range(1, k + 1))
        for r in mine:
            assert r.n == n and r.deviation_exact == deviation
            assert r.deviation == (deviation if deviation < 1 << 63 else None)
            assert abs(r.explained - values[r.component - 1] / values.sum()) <= 1e-9
            assert r.identity_error < 1e-8
        white[tuple(x)] = [next(r.whitened for r in mine if r.component == c) for c in range(1, k + 1)]
    w = np.array([white[v] for v in fit])
    assert np.abs(w.T @ w / n - np.eye(k)).max() < tol
    # Whitened = centred @ component / sqrt(e): recover the components and hold them against the covariance.
    components = np.linalg.lstsq(a, w * np.sqrt(values[:k]), rcond=None)[0]
    assert np.abs(cov @ components - components * values[:k]).max() < tol * values[0]


def test_whole_table(spark):
    path = "/root/testdata/sf0.001"
    rows = whitening.whiten(spark.read.parquet(f"{path}/embeddings.parquet")).collect()
    vectors = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    check(rows, vectors)
    out = whitening.op11_cholesky_whitening(spark, path)
    assert out.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def awkward(rng, d=6):
    base = rng.normal(size=(300, 2)) @ rng.normal(size=(2, d)) + 1e-3 * rng.normal(size=(300, d))
    vectors = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    for _, v in vectors:
        v[3] = 0.5                                             # no variance
        v[4] = v[1] * 4                                        # nearly dependent
    vectors += [(1000 + i, vectors[0][1]) for i in range(150)]   # a third of all rows alike
    bad = [(2000, None), (2001, [None] + [0.0] * (d - 1)), (2002, [math.nan] * d), (2003, [math.inf] + [0.0] * (d - 1))]
    return vectors, bad


def test_awkward_vectors(spark):
    vectors, bad = awkward(np.random.default_rng(4))
    df = spark.createDataFrame([(i, v, "a", 1, 2) for i, v in vectors + bad], SCHEMA)
    for n in (1, 5, 80):                      # 80 parts: more than one level of the tree
        check(whitening.whiten(df.repartition(n, "vec_id")).collect(), vectors)
    other = spark.createDataFrame([(7000, [1.0, 2.0], "a", 1, 2), (7001, [], "a", 1, 2)], SCHEMA)
    check(whitening.whiten(df.unionByName(other)).collect(), vectors)      # vectors of another length are left out


def test_tree_of_sums(spark):
    df = spark.createDataFrame([([i, 2 * i, 7],) for i in range(500)], "x array<long>").repartition(70)
    g = whitening.summed_gram(df, lambda x: x.astype(float))
    x = np.array([[i, 2 * i, 7] for i in range(500)], float)
    assert np.array_equal(g, x.T @ x)


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(c) for c in np.float32(rng.normal(size=3) * [1e12, 1e11, 1e10])]) for i in range(60)]
    check(whitening.whiten(spark.createDataFrame([(i, v, "", 0, 0) for i, v in vectors], SCHEMA)).collect(), vectors, 1e-6)


def test_ill_conditioned(spark):
    """A condition number of 1e7: its square is lost in a covariance of doubles, not here."""
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.normal(size=(400, 3)))
    x = np.floor(q * [1e13, 1e9, 1e6]).astype(np.int64)
    df = spark.createDataFrame([(list(map(int, v)),) for v in x], "x array<long>")
    w = whitening.fit_whitening(df)
    want = np.linalg.svd((x - x.mean(axis=0)), compute_uv=False) ** 2 / len(x)
    assert np.allclose(w.variances, want, rtol=1e-6) and w.identity_error < 1e-6


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [None, [math.nan]]])
def test_nothing_to_whiten(spark, vectors):
    df = spark.createDataFrame([(i, v, "", 0, 0) for i, v in enumerate(vectors)], SCHEMA)
    assert whitening.whiten(df).collect() == []


def test_null_and_repeated_ids(spark):
    rows = [(None, [0.0, 1.0], "", 0, 0), (1, [1.0, 0.0], "", 0, 0), (1, [1.0, 3.0], "", 0, 0)]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.id is None, r.component) for r in out) == [(False, 1)] * 2 + [(False, 2)] * 2 + [(True, 1), (True, 2)]
