import math
from fractions import Fraction

import numpy as np
import pytest

from raretide.llm import whitening
from tests.conftest import SF001


def plain_polynomial(matrix):
    """Faddeev-LeVerrier in fractions, highest first."""
    d = len(matrix)
    a = [[Fraction(v) for v in row] for row in matrix]
    c, m = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        c.append(-sum(a[i][t] * m[t][i] for i in range(d) for t in range(d)) / k)
    return [int(x) for x in c]


def test_polynomial_roots_and_vectors(spark):
    draw = np.random.default_rng(3)
    for d in (1, 2, 5, 9):
        x = draw.integers(-50, 50, (d + 4, d)).astype(object)
        m = (x.T @ x).tolist()
        poly = whitening.characteristic_polynomial(spark, m)
        assert poly == plain_polynomial(m)
        want = np.linalg.eigvalsh(np.array(m, dtype=float))[::-1]
        got = whitening.largest_roots(poly, d)
        assert [t for _, t in got] == [1] * d
        assert np.allclose([r / 2.0**whitening.BITS for r, _ in got], want, rtol=1e-9)
        for r, _ in got:
            v = whitening.null_vectors(m, r, 1)[0]
            e = r / 2.0**whitening.BITS
            assert np.allclose(np.array(m, dtype=float) @ v, e * v, atol=1e-9 * want[0]) and abs(v @ v - 1) < 1e-14


def test_zero_rows_and_repeated_roots():
    poly = plain_polynomial([[4, 0, 0, 0, 0], [0, 4, 0, 0, 0], [0, 0, 9, 0, 0], [0, 0, 0, 0, 0], [0, 0, 0, 0, 0]])
    one = 1 << whitening.BITS
    assert whitening.largest_roots(poly, 5) == [(9 * one, 1), (4 * one, 2)]
    v = whitening.null_vectors([[5, 1, 0], [1, 5, 0], [0, 0, 6]], 6 * one, 2)
    assert np.allclose(v @ v.T, np.eye(2), atol=1e-14)
    assert np.allclose(np.array([[5, 1, 0], [1, 5, 0], [0, 0, 6]]) @ v.T, 6 * v.T, atol=1e-13)


def test_exact_products_of_every_size():
    draw = np.random.default_rng(5)
    for most in (10, 1 << 22, 1 << 27, (1 << 31) - 1):
        a, b = draw.integers(-most, most, (40, 3)), draw.integers(-most, most, (40, 4))
        assert (whitening.exact_products(a, b) == a.T.astype(object) @ b.astype(object)).all()


def brute(rows, count=8):
    """Dense answer: exact deviations in Python integers, whitening by a double eigensolver."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    deviation = [sum((n * r[j] - sums[j]) ** 2 for j in range(d)) for r in x]
    centred = np.array([[float(Fraction(n * r[j] - sums[j], n)) for j in range(d)] for r in x])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1][:count], v[:, ::-1][:, :count]
    return n, deviation, centred @ v / np.sqrt(e), e / np.trace(centred.T @ centred / n)


def check(spark, rows, df):
    n, deviation, z, share = brute(rows)
    out = whitening.whiten(df).collect()
    k = min(8, len(rows[0][1]))
    assert len(out) == len(rows) * k
    got = {}
    for r in out:
        assert r.n == n and abs(r.explained - share[r.component - 1]) < 1e-9 and r.identity_error < 1e-9
        assert r.deviation == int(r.deviation_exact)
        got.setdefault(r.component, []).append((r.vec_id, r.deviation, r.whitened))
    for c in range(1, k + 1):
        mine = sorted(got[c], key=lambda t: (t[0], t[1]))
        want = sorted(((i, dv, w) for (i, _), dv, w in zip(rows, deviation, z[:, c - 1])), key=lambda t: (t[0], t[1]))
        assert [t[:2] for t in mine] == [t[:2] for t in want]
        a, b = np.array([t[2] for t in mine]), np.array([t[2] for t in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-7


def test_whiten_equals_dense_answer(spark):
    df = spark.read.parquet(f"{SF001}/embeddings.parquet")
    check(spark, [(r.vec_id, list(r.embedding)) for r in df.select("vec_id", "embedding").collect()], df)


def test_odd_rows_are_dropped_and_clashing_columns_ignored(spark):
    draw = np.random.default_rng(7)
    good = [(i, [float(c) for c in draw.normal(0, 3, 3)]) for i in range(40)]
    good += [good[3], good[3]]
    odd = [(50, None), (51, [1.0, None, 2.0]), (52, [1.0, float("nan"), 0.0]), (53, [float("inf"), 0.0, 0.0]), (54, [1e300, 0.0, 0.0]),
           (55, [1.0]), (56, [])]
    rows = [(i, v, "z", 9) for i, v in good + odd]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string, n int")
    check(spark, good, df)


def test_wide_entries_stay_exact(spark):
    rows = [(1, [1e12, 2.0]), (2, [-3e12, 5.0]), (3, [2.5e11, -1.0]), (None, [7.0, 8.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    want = sorted(sum((4 * r[j] - sum(q[j] for q in x)) ** 2 for j in range(2)) for r in x)
    out = whitening.whiten(df).where("component = 1").collect()
    assert sorted(int(r.deviation_exact) for r in out) == want
    assert all(r.deviation is None or r.deviation == r.deviation_exact for r in out) and any(r.deviation is None for r in out)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, []), (2, [])]])
def test_no_variance_gives_no_rows(spark, rows):
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert out.count() == 0 and out.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
