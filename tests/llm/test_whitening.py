import random
from fractions import Fraction

import numpy as np
import pytest

from tessera.llm import charpoly, whitening

SF = "/root/testdata/sf0.01"


def brute_polynomial(matrix):
    """Faddeev-LeVerrier in fractions, lowest coefficient first."""
    d = len(matrix)
    m, c = [[Fraction(0)] * d for _ in range(d)], [Fraction(0)] * d + [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(matrix[i][x] * m[x][j] for x in range(d)) + (c[d - k + 1] if i == j else 0) for j in range(d)] for i in range(d)]
        c[d - k] = -sum(matrix[i][x] * m[x][i] for i in range(d) for x in range(d)) / k
    return [int(x) for x in c]


def gram(d, n, size, seed, zero=()):
    rng = random.Random(seed)
    x = [[0 if i in zero else rng.randint(-size, size) for i in range(d)] for _ in range(n)]
    return [[sum(r[i] * r[j] for r in x) for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("d,n,size,zero", [(1, 3, 9, ()), (2, 1, 5, ()), (5, 9, 10**6, ()), (7, 3, 40, (1, 2)), (9, 30, 3, (8,))])
def test_polynomial_is_exact(spark, d, n, size, zero):
    a = gram(d, n, size, d, zero)
    assert whitening.characteristic_polynomial(spark, a) == brute_polynomial(a)


def test_roots_and_components_of_repeated_eigenvalues():
    # Eigenvalues 9, 9, 4, 4, 4, 0 in a rotated basis of integers (Hadamard-like).
    h = np.array([[1, 1], [1, -1]])
    q = np.kron(h, h)
    a = q @ np.diag([9, 9, 4, 0]) @ q.T  # q q' = 4 I: eigenvalues 36, 36, 16, 0
    a = [[int(x) for x in r] for r in a]
    roots = charpoly.top_roots(brute_polynomial(a), 8)
    assert [m for _, _, m in roots] == [2, 1] and [round(r / 2**s) for r, s, _ in roots] == [36, 16]
    found = charpoly.components(a, roots, 8)
    u = np.array([v for _, v in found])
    assert np.abs(u @ u.T - np.eye(3)).max() < 1e-15
    assert np.abs(np.array(a) @ u.T - u.T * [36, 36, 16]).max() < 1e-13


def table(rows):
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {})[r.component] = r
    return by


def test_against_a_dense_solver(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    x = np.array([r.embedding for r in vectors.collect()], float)
    ids = [r.vec_id for r in vectors.select("vec_id").collect()]
    x = np.floor(1024 * x).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    v = (x - s / n).T @ (x - s / n) / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    want = (x - s / n) @ u / np.sqrt(e)
    got = table(whitening.digest(vectors).collect())
    assert len(got) == n and all(len(r) == 8 for r in got.values())
    for i, w in zip(ids, want):
        rows = [got[i][c] for c in range(1, 9)]
        assert np.allclose(np.abs([r.whitened for r in rows]), np.abs(w), atol=1e-9)
        assert np.allclose([r.explained for r in rows], e / np.trace(v), rtol=1e-12)
        assert rows[0].n == n and 0 < rows[0].identity_error < 1e-12
    for i, row in list(zip(ids, x.tolist()))[:50]:
        assert got[i][3].deviation == sum((n * a - int(b)) ** 2 for a, b in zip(row, s))


SCHEMA = "vec_id long, embedding array<float>, n int, x string, w int"


def test_odd_rows(spark):
    rng = random.Random(5)
    good = [(i, [rng.uniform(-1, 1) for _ in range(3)], 1, "a", 2) for i in range(40)]
    bad = [(90, None, 1, "", 1), (91, [], 1, "", 1), (92, [1.0, None, 2.0], 1, "", 1), (93, [float("nan"), 1.0, 1.0], 1, "", 1),
           (94, [float("inf"), 1.0, 1.0], 1, "", 1), (95, [0.5] * 5000, 1, "", 1), (96, [1.0, 2.0], 1, "", 1)]
    odd = [good[0], (None, good[1][1], 0, None, 0), (None, [1e30, -1e30, 0.0], 0, "", 0)]
    got = whitening.whiten(spark.createDataFrame(good + bad + odd, SCHEMA).repartition(4)).collect()
    ids = [r.vec_id for r in got]
    assert not set(ids) & set(range(90, 97)) and ids.count(0) == 6 and ids.count(None) == 6 and len(got) == 43 * 3
    assert all((r.deviation is None) != (r.deviation_exact is None) for r in got)
    x = [[max(-(2**62), min(2**62, int(np.floor(float(np.float32(c)) * 1024)))) for c in r[1]] for r in good + odd]
    s = [sum(c) for c in zip(*x)]
    want = sorted(sum((43 * a - b) ** 2 for a, b in zip(r, s)) for r in x)
    assert sorted(int(r.deviation_exact or r.deviation) for r in got if r.component == 1) == want


def test_without_variance_there_are_no_components(spark):
    for rows in ([], [(1, [0.5, 0.25], 0, "", 0)], [(1, [0.5, 0.25], 0, "", 0), (2, [0.5, 0.25], 0, "", 0)]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []
    flat = [(i, [float(i % 3), 7.0, 2.0 * (i % 3)], 0, "", 0) for i in range(9)]
    got = whitening.whiten(spark.createDataFrame(flat, SCHEMA)).collect()
    assert {r.component for r in got} == {1} and all(abs(r.explained - 1) < 1e-12 for r in got)
    assert np.isclose(np.mean([r.whitened**2 for r in got]), 1)


def test_deals_alike_over_any_partitions(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    a, b = (
        {(r.vec_id, r.component): r.whitened for r in whitening.digest(v).collect()}
        for v in (vectors.repartition(7), vectors.coalesce(1))
    )
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)
