"""Embedding whitening from the exact characteristic polynomial of the integer scatter.

1. Every entry c becomes the integer x = floor(SCALE * c) + OFFSET.  One pass over
   the rows gives the count n, the sums S and the products, all exact integers
   (tasks add their rows up, Spark adds the tasks).  n times the products less S S'
   is n^2 times the covariance, an integer matrix M.
2. The characteristic polynomial of M: for each of enough 31-bit primes M is
   brought to Hessenberg form modulo the prime and its polynomial read off (Spark
   tasks, one residue row per prime); Chinese remaindering gives the integers.
3. All roots are real, so by Descartes the sign changes of the polynomial moved to
   a are exactly the number of roots above a.  Bisection by that count isolates
   the largest roots, bisection by sign narrows each to ``BITS`` binary places.
4. A component is the null vector of M - root: elimination in fixed-point
   integers and inverse iteration (Spark tasks, one component each).  A root of
   multiplicity m gets m vectors, orthonormalised.
5. A second pass over the rows projects, and the covariance of what came out is
   taken from the written rows.

Only the d x d matrix, its polynomial and the components pass through the driver:
their size depends on the dimension d alone.  The polynomial arithmetic grows with
a power of d and suits vectors of up to a few hundred entries.

Defined cases: rows whose vector is null, or holds a null, a non-finite entry or one
of 2^52 or more (its integer would not fit a long), are dropped; so are vectors that
have not the most frequent length (of equally frequent ones the smallest); null and repeated ids
keep their rows; directions without variance are no components, so equal vectors,
a single row, empty vectors and an empty table give no rows.  ``deviation`` is null
where the exact sum exceeds a long (``deviation_exact`` holds it then).  The sign of
a component makes its largest entry positive.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction
from math import comb, gcd, isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raretide.llm.common import stored, table

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
#: Binary places of a root, and of the numbers of the elimination.
BITS = 96
FIXED = 256
_LIMB = 31


def integer_vector(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """floor(scale * c) + offset of every entry as a long; null where an entry cannot take part."""
    doubles = F.transform(vector, lambda c: c.cast("double"))
    bad = F.exists(doubles, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= F.lit(2.0**52)))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(doubles, lambda c: F.floor(c * F.lit(scale)).cast("long") + F.lit(offset)))


def rectangle(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column as an (n, width) matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a' b of int64 matrices with entries below 2^32, as Python integers: float products of limbs that stay below 2^53."""
    out = np.zeros((a.shape[1], b.shape[1]), dtype=object)
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if most >= 1 << 44:
        high, low, top, rest = a >> 16, a & 0xFFFF, b >> 16, b & 0xFFFF
        middle = exact_products(high, rest) + exact_products(low, top)
        return (exact_products(high, top) << 32) + (middle << 16) + exact_products(low, rest)
    rows = max(1, (1 << 53) // max(1, most))
    for i in range(0, len(a), rows):
        part = a[i:i + rows].astype(np.float64).T @ b[i:i + rows].astype(np.float64)
        out += part.astype(np.int64).astype(object)
    return out


def scatter(vectors: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, products) of the int64 vectors ``x`` of ``vectors``, exact."""
    i, j = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(width, dtype=object)
        total = [np.zeros((width, width), dtype=object) for _ in range(3)]
        for b in batches:
            x = rectangle(b.column(0), width)
            n += len(x)
            small = len(x) == 0 or int(np.abs(x).max()) < 1 << _LIMB
            high = np.zeros_like(x) if small else x >> _LIMB
            low = x if small else x & ((1 << _LIMB) - 1)
            sums += (low.sum(axis=0).astype(object)) + (high.sum(axis=0).astype(object) << _LIMB)
            total[0] += exact_products(low, low)
            if not small:
                cross = exact_products(high, low)
                total[1] += cross + cross.T
                total[2] += exact_products(high, high)
        if n:
            cells = [[*t[i, j], *rest] for t, rest in zip(total, ([*sums, n], [0] * (width + 1), [0] * (width + 1)))]
            keys = [[*i, *range(width), -1], [*j, *[-1] * (width + 1)]]
            kind = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(k, np.int32)) for k in keys] + [pa.array([Decimal(int(v)) for v in c], kind) for c in cells], names=["i", "j", "a", "b", "c"])

    parts = vectors.select("x").mapInArrow(run, "i int, j int, a decimal(38,0), b decimal(38,0), c decimal(38,0)")
    n, sums, products = 0, [0] * width, [[0] * width for _ in range(width)]
    for r in parts.groupBy("i", "j").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("c").alias("c")).collect():
        value = int(r.a) + (int(r.b) << _LIMB) + (int(r.c) << 2 * _LIMB)
        if r.i < 0:
            n = value
        elif r.j < 0:
            sums[r.i] = value
        else:
            products[r.i][r.j] = products[r.j][r.i] = value
    return n, sums, products


def primes_below(top: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``top`` (at most 2^31), by strong tests to four bases, which settle this range."""
    def strong(n: int, base: int) -> bool:
        odd, twos = n - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        x = pow(base, odd, n)
        return x in (1, n - 1) or any((x := x * x % n) == n - 1 for _ in range(twos - 1))

    out, n = [], top - 1 - top % 2
    while len(out) < count:
        if all(n % p for p in (3, 5, 7, 11, 13)) and all(strong(n, b) for b in (2, 3, 5, 7)):
            out.append(n)
        n -= 2
    return out


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients (highest first) of det(xI - matrix) modulo the prime p, by reduction to Hessenberg form."""
    h = matrix % p
    d = len(h)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1:, k])
        if not len(below):
            continue
        pivot = k + 1 + below[0]
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        u = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - u[:, None] * h[k + 1]) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * u % p).sum(axis=1)) % p
    lead = np.zeros((d + 1, d + 1), dtype=np.int64)  # row m: polynomial of the leading m x m block, lowest first
    lead[0, 0] = 1
    for m in range(1, d + 1):
        row = np.zeros(d + 1, dtype=np.int64)
        row[1:] = lead[m - 1, :-1]
        row = (row - h[m - 1, m - 1] * lead[m - 1]) % p
        weights, chain = np.zeros(m - 1, dtype=np.int64), 1
        for i in range(m - 2, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            weights[i] = chain * int(h[i, m - 1]) % p
        if m > 1:
            row = (row - (weights[:, None] * lead[:m - 1] % p).sum(axis=0)) % p
        lead[m] = row
    return lead[d][::-1].copy()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients (highest first) of det(xI - matrix) of a positive semidefinite integer matrix, exact.

    The k-th elementary sum of the roots lies between 0 and C(d, k) (trace / d)^k.
    """
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    bound = max(comb(d, k) * (-(-trace // d)) ** k for k in range(d + 1))
    primes = primes_below(1 << 31, bound.bit_length() // 30 + 2)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for p in b["p"]:
                residues = np.array([[v % p for v in row] for row in matrix], dtype=np.int64)
                rows.append((p, polynomial_mod(residues, int(p)).tolist()))
            yield pd.DataFrame(rows, columns=["p", "residues"])

    slices = min(len(primes), spark.sparkContext.defaultParallelism)
    found = spark.createDataFrame([(p,) for p in primes], "p long").repartition(slices).mapInPandas(run, "p long, residues array<long>").collect()
    whole = 1
    for r in found:
        whole *= r.p
    total = [0] * (d + 1)
    for r in found:
        rest = whole // r.p
        unit = rest * pow(rest, -1, r.p)
        for k, v in enumerate(r.residues):
            total[k] += (v if k % 2 == 0 else -v) % r.p * unit
    return [(v % whole) * (-1) ** k for k, v in enumerate(total)]


def roots_above(poly: list[int], a: int) -> int:
    """Roots greater than a of a polynomial with real roots only: the sign changes of poly(x + a)."""
    c = list(poly)
    for end in range(len(c), 1, -1):
        for i in range(1, end):
            c[i] += a * c[i - 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def largest_roots(poly: list[int], count: int, bits: int = BITS) -> list[tuple[int, int]]:
    """(root, multiplicity) of the largest positive roots until ``count`` are covered, roots as integers over 2^bits.

    ``poly`` is monic (highest first) with real, non-negative roots.  Roots nearer than 2^-bits are one.
    """
    d = len(poly) - 1
    positive = d - next((k for k, v in enumerate(reversed(poly)) if v), d)
    fine = [v << (bits * k) for k, v in enumerate(poly)]
    known = {0: positive, (-poly[1] << bits) if d else 0: 0}

    def above(a: int) -> int:
        if a not in known:
            known[a] = roots_above(fine, a)
        return known[a]

    def value(a: int) -> int:
        total = 0
        for v in fine:
            total = total * a + v
        return total

    out, covered = [], 0
    while covered < min(count, positive):
        # the interval (lo, hi] of the next root, as narrow as earlier counts allow
        lo = max(a for a, n in known.items() if n > covered)
        hi = min(a for a, n in known.items() if n <= covered and a > lo)
        while above(lo) - above(hi) > 1 and hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if above(mid) > covered else (lo, mid)
        if above(lo) - above(hi) == 1:
            sign = -1 if above(hi) % 2 else 1
            while hi - lo > 1:
                mid = (lo + hi) // 2
                v = value(mid)
                if v == 0:
                    hi = mid
                    break
                lo, hi = (lo, mid) if (v > 0) == (sign > 0) else (mid, hi)
        out.append((hi, above(lo) - above(hi) if hi - lo <= 1 and above(lo) - above(hi) > 1 else 1))
        covered += out[-1][1]
        known.setdefault(hi, covered - out[-1][1])
        known.setdefault(lo, covered)
    return out


def null_vectors(matrix: list[list[int]], root: int, wanted: int, bits: int = BITS, fixed: int = FIXED, rounds: int = 3) -> np.ndarray:
    """``wanted`` orthonormal double vectors (rows) of the null space of matrix - root / 2^bits, by inverse iteration.

    Numbers are integers over 2^fixed, so the vectors are right to double precision however close the roots lie.
    """
    d = len(matrix)
    a = np.array([[v << bits for v in row] for row in matrix], dtype=object)
    a[np.arange(d), np.arange(d)] -= root
    top = max(1, max(abs(v) for v in a.ravel()))
    a = (a << fixed) // top
    order, multipliers = np.arange(d), []
    for k in range(d):
        best = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        if best != k:
            a[[k, best]] = a[[best, k]]
            order[[k, best]] = order[[best, k]]
            for m, column in enumerate(multipliers):
                column[k - m - 1], column[best - m - 1] = column[best - m - 1], column[k - m - 1]
        if a[k, k] == 0:
            a[k, k] = 1
        column = (a[k + 1:, k] << fixed) // a[k, k]
        multipliers.append(column)
        if k + 1 < d:
            a[k + 1:, k + 1:] -= (column[:, None] * a[k, k + 1:][None, :]) >> fixed
            a[k + 1:, k] = 0

    def solve(v: np.ndarray) -> np.ndarray:
        x = v[order].copy()
        for k in range(d - 1):
            x[k + 1:] -= (multipliers[k] * x[k]) >> fixed
        for k in range(d - 1, -1, -1):
            x[k] = (x[k] << fixed) // a[k, k]
            x[:k] -= (a[:k, k] * x[k]) >> fixed
        return x

    def unit(v: np.ndarray) -> np.ndarray:
        return (v << fixed) // max(1, isqrt(int((v * v).sum())))

    draw = np.random.default_rng(12)
    found: list[np.ndarray] = []
    for _ in range(wanted):
        v = np.array([int(x) << fixed for x in draw.integers(-1000, 1000, d)], dtype=object)
        for _ in range(rounds):
            v = solve(unit(v))
            for u in found * 2:
                v = v - ((u * (int((u * v).sum()) >> fixed)) >> fixed)
        v = unit(v)
        found.append(v if max(v, key=abs) >= 0 else -v)
    return np.array([[float(Fraction(int(x), 1 << fixed)) for x in v] for v in found])


def components(spark: SparkSession, n: int, sums: list[int], products: list[list[int]], count: int = COMPONENTS) -> list[tuple[float, float, np.ndarray]]:
    """(eigenvalue, share of the trace, unit vector) of the covariance's largest components with variance."""
    d = len(sums)
    m = [[n * products[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    common = gcd(*[v for row in m for v in row]) if d else 0
    if not common:
        return []
    m = [[v // common for v in row] for row in m]
    trace = sum(m[i][i] for i in range(d))
    roots = largest_roots(characteristic_polynomial(spark, m), count)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k, root, times in zip(b["k"], b["root"], b["times"]):
                vectors = null_vectors(m, int(root), int(times))
                yield pd.DataFrame({"k": [int(k)] * len(vectors), "nr": range(len(vectors)), "v": [x.tolist() for x in vectors]})

    asked = spark.createDataFrame([(k, str(root), times) for k, (root, times) in enumerate(roots)], "k int, root string, times int")
    rows = asked.repartition(len(roots), "k").mapInPandas(run, "k int, nr int, v array<double>").collect()
    out = []
    for r in sorted(rows, key=lambda r: (r.k, r.nr))[:count]:
        value = Fraction(roots[r.k][0] * common, n * n << BITS)
        out.append((float(value), float(Fraction(roots[r.k][0], trace << BITS)), np.array(r.v)))
    return out


def whiten(vectors: DataFrame, count: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE,
           offset: int = OFFSET) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error, deviation_exact)`` per remaining row and component."""
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), integer_vector(F.col(vec_col), scale, offset).alias("x")).where("x is not null")
    rows = stored(rows, "whiten-x")
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    width = sizes.d if sizes else 0
    rows = rows.where(F.size("x") == width)
    found = []
    if width:
        n, sums, products = scatter(rows, width)
        found = components(spark, n, sums, products, count)
    if not found:
        empty = (f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, "
                 "deviation_exact decimal(38,0)")
        return spark.createDataFrame([], empty)
    basis = np.stack([v / np.sqrt(e) for e, _, v in found], axis=1)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = rectangle(b.column(1), width)
            if len(x) and int(np.abs(x).max()) * n + max(map(abs, sums)) < 1 << 62:
                away = x * np.int64(n) - np.array(sums, dtype=np.int64)  # n times the distance from the mean, exact
                most = int(np.abs(away).max())
            else:
                away, most = x.astype(object) * n - np.array(sums, dtype=object), 1 << 62
            exact = (away * away).sum(axis=1) if most * most * width < 1 << 63 else (away.astype(object) ** 2).sum(axis=1)
            exact = [int(v) for v in exact]
            z = (away.astype(np.float64) / n) @ basis
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([v if v < 1 << 63 else None for v in exact], pa.int64()),
                pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(np.arange(0, z.size + 1, z.shape[1], dtype=np.int32), z.ravel())], names=["id", "deviation", "deviation_exact", "z"])

    put = stored(rows.select("id", "x").mapInArrow(project, f"id {kind}, deviation long, deviation_exact decimal(38,0), z array<double>"), "whiten-z")
    k = len(found)
    cells = [(i, j) for i in range(k) for j in range(i, k)]
    got = put.agg(*[F.covar_pop(F.col("z")[i], F.col("z")[j]) for i, j in cells]).first()
    error = max(abs(v - (i == j)) for v, (i, j) in zip(got, cells))
    shares = F.array(*[F.lit(s) for _, s, _ in found])
    out = put.select("id", "deviation", "deviation_exact", F.posexplode("z").alias("at", "whitened"))
    return out.select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"), "deviation_exact")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
