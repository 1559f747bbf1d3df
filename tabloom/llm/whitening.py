"""Whitening of embeddings by exactly known covariances.

Entries become whole numbers (256ths), so the scatter matrix of the distinct
vectors, n times the sum of products less the product of sums, is an exact
matrix of integers. Its characteristic polynomial is found modulo many primes
(reduction to Hessenberg form, then the recurrence of the leading minors), one
prime per row of a Spark table, and put together by the Chinese remainder
theorem; a bound on the coefficients tells how many primes are enough. All its
roots are real and none is negative, so the sign changes of the polynomial moved
by t count exactly the roots above t: the largest roots are isolated by halving
and then refined to 180 bits. Roots that agree so far count as one multiple
root. Components span the null space of the scatter less the root: inverse
iteration with 120 decimal digits.

The distinct vectors are found by a grouping that combines before the shuffle.
Each task adds its products in whole numbers; what reaches the driver is bounded
by the square of the dimension.

Defined cases: vectors that are null, empty, or hold a null or non-finite entry
have no result, nor have those of another length than the most frequent one
(of equally frequent ones the longest); entries beyond the range of a long are
its ends; components without variance are left out, so fewer than two different
vectors, or an empty table, give no rows; repeated rows and ids have results of
their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Context, Decimal, localcontext
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.sources.workspace import materialized

SCALE = 256
DIGITS, BITS = 120, 180
#: Sums travel in three digits of so many bits, so that adding those of many tasks stays in a long.
DIGIT = 42


def quantised(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id`` and ``x``, the entries as whole 256ths, of the vectors that have all their entries."""
    vector = rows[vector_col]
    finite = lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf"))
    there = vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda c: finite(c) & ~F.isnan(c.cast("double")))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))
    return rows.filter(there).select(rows[id_col].alias("vec_id"), x.alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def exact_products(x: np.ndarray) -> np.ndarray:
    """The matrix of products x'x as Python integers, in floats or longs where they hold it exactly."""
    bound = len(x) * _largest(x) ** 2
    if bound < 2**53:
        x = x.astype(float)
        return (x.T @ x).astype(np.int64).astype(object)
    x = x if bound < 2**63 else x.astype(object)
    return (x.T @ x).astype(object)


@dataclass(frozen=True)
class Moments:
    """Number, sums and scatter n * sum(x x') - S S' of the distinct vectors, in whole numbers."""

    n: int
    sums: tuple[int, ...]
    scatter: tuple[tuple[int, ...], ...]


def moments(fit: DataFrame, d: int) -> Moments:
    """From rows of vectors ``x`` of length ``d``; each task sends one row per pair of dimensions."""
    base = 1 << DIGIT

    def add(batches):
        n, sums, products = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                x = _matrix(batch.column(0).slice(start, 4096), d)
                n += len(x)
                sums = sums + (x.sum(0) if len(x) * _largest(x) < 2**63 else x.astype(object).sum(0)).astype(object)
                products = products + exact_products(x)
        if not n:
            return
        cells = [(-1, -1, n), *((-1, j, s) for j, s in enumerate(sums))]
        cells += [(i, j, products[i, j]) for i in range(d) for j in range(i, d)]
        i, j, v = zip(*cells)
        v = [int(value) for value in v]
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32())]
            + [pa.array([(value >> shift) % base for value in v], pa.int64()) for shift in (0, DIGIT)]
            + [pa.array([value >> 2 * DIGIT for value in v], pa.int64())],
            names=["i", "j", "a", "b", "c"],
        )

    sent = fit.select("x").mapInArrow(add, "i int, j int, a long, b long, c long")
    found = sent.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in "abc"]).collect()
    total = {(r["i"], r["j"]): r["a"] + (r["b"] << DIGIT) + (r["c"] << 2 * DIGIT) for r in found}
    n = total.get((-1, -1), 0)
    sums = tuple(total.get((-1, j), 0) for j in range(d))
    at = lambda i, j: n * total.get((min(i, j), max(i, j)), 0) - sums[i] * sums[j]
    return Moments(n, sums, tuple(tuple(at(i, j) for j in range(d)) for i in range(d)))


def _is_prime(p: int) -> bool:
    if any(p % q == 0 for q in (2, 3, 5, 7)):
        return p in (2, 3, 5, 7)
    twos = ((p - 1) & (1 - p)).bit_length() - 1
    for base in (2, 3, 5, 7):  # enough below 3.2e9
        y = pow(base, (p - 1) >> twos, p)
        if y not in (1, p - 1) and not any((y := y * y % p) == p - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(product: int) -> list[int]:
    """The largest primes below 2**31 whose product exceeds the given number."""
    found, p = [], 2**31 + 1
    while product > 0:
        p -= 2
        if _is_prime(p):
            found.append(p)
            product //= p
    return found


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, constant first, of det(t - A) modulo a prime below 2**31."""
    a = np.array(matrix % p, np.int64)
    d = len(a)
    for c in range(d - 2):
        found = np.flatnonzero(a[c + 1 :, c])
        if not len(found):
            continue
        r, c1 = c + 1 + int(found[0]), c + 1
        a[[r, c1]] = a[[c1, r]]
        a[:, [r, c1]] = a[:, [c1, r]]
        factors = a[c + 2 :, c] * pow(int(a[c1, c]), -1, p) % p
        a[c + 2 :] = (a[c + 2 :] - factors[:, None] * a[c1]) % p
        a[:, c1] = (a[:, c1] + (a[:, c + 2 :] * factors % p).sum(1)) % p
    minors = np.zeros((d + 1, d + 1), np.int64)
    minors[0, 0] = 1
    below = np.ones(d, np.int64)  # products of the subdiagonal from each row to the present one
    for k in range(d):
        if k:
            below[:k] = below[:k] * a[k, k - 1] % p
        weights = a[:k, k] * below[:k] % p
        minors[k + 1, 1:] = minors[k, :-1]
        minors[k + 1] = (minors[k + 1] - a[k, k] * minors[k] % p - (weights[:, None] * minors[:k] % p).sum(0)) % p
    return minors[d]


def characteristic_polynomial(spark: SparkSession, scatter: Sequence[Sequence[int]]) -> list[int]:
    """Exact coefficients, constant first, of a matrix without negative eigenvalues; one task row per prime."""
    d = len(scatter)
    trace = sum(scatter[i][i] for i in range(d))
    # the coefficients add up to the product of (1 + eigenvalue) at most, and that to the power of the mean
    primes = primes_beyond(2 * (1 + trace // d + 1) ** d)

    def residues(batches):
        matrix = np.array(scatter, object).reshape(d, d)
        for batch in batches:
            ps = batch.column(0).to_pylist()
            found = [polynomial_modulo(matrix, p).tolist() for p in ps]
            yield pa.RecordBatch.from_arrays([pa.array(ps, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["p", "found"])

    slices = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    dealt = spark.createDataFrame([(p,) for p in primes], "p long").repartition(slices)
    modulus, sums = 1, [0] * (d + 1)
    for p in primes:
        modulus *= p
    for row in dealt.mapInArrow(residues, "p long, found array<long>").collect():
        part = modulus // row["p"]
        part *= pow(part, -1, row["p"])
        for k, residue in enumerate(row["found"]):
            sums[k] += residue * part
    sums = [s % modulus for s in sums]
    return [s - modulus if 2 * s > modulus else s for s in sums]


def _moved(coefficients: list[int], t: int) -> list[int]:
    moved = list(coefficients)
    for i in range(len(moved) - 1):
        for k in range(len(moved) - 2, i - 1, -1):
            moved[k] += t * moved[k + 1]
    return moved


def roots_above(coefficients: list[int], t: int) -> int:
    """How many roots exceed t, for a polynomial with real roots only (Descartes' rule is exact there)."""
    signs = [c > 0 for c in _moved(coefficients, t) if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(coefficients: list[int], t: int) -> int:
    value = 0
    for c in reversed(coefficients):
        value = value * t + c
    return (value > 0) - (value < 0)


def largest_roots(coefficients: list[int], wanted: int, bits: int = BITS) -> list[Fraction]:
    """The largest positive roots, multiple ones repeated, each to ``bits`` binary digits."""
    d = len(coefficients) - 1
    zeros = next(k for k, c in enumerate(coefficients) if c)
    found: list[Fraction] = []
    top = max(1, -coefficients[d - 1]) if d else 1  # the sum of all roots
    for k in range(1, min(wanted, d - zeros) + 1):
        # the root lies in (low, high] / 2**scale; more than k - 1 roots exceed low, at most k - 1 exceed high
        low, high, scale, now = 0, top, 0, coefficients
        above_low, above_high = d - zeros, 0
        while True:
            if high - low == 1:
                if high.bit_length() >= bits:
                    break
                now = [c << (d - i) for i, c in enumerate(now)]
                low, high, scale = 2 * low, 2 * high, scale + 1
            middle = (low + high) // 2
            if above_low - above_high == 1:  # isolated: its sign tells
                end = _sign(now, high)
                here = _sign(now, middle) if end else 1
                if not end or not here:
                    low, high = (high, high) if not end else (middle, middle)
                    break
                low, high = (middle, high) if here != end else (low, middle)
                continue
            above = roots_above(now, middle)
            if above >= k:
                low, above_low = middle, above
            else:
                high, above_high = middle, above
        found.append(Fraction(high, 1 << scale))
    return found


def null_space(scatter: Sequence[Sequence[int]], root: Fraction, size: int) -> list[list[Decimal]]:
    """An orthonormal basis of the eigenvectors of a root, to far more digits than a double has."""
    d = len(scatter)
    with localcontext(Context(prec=DIGITS)) as context:
        exact = Decimal(root.numerator) / Decimal(root.denominator)
        a = np.array([[Decimal(int(v)) for v in row] for row in scatter], object).reshape(d, d)
        a[np.diag_indices(d)] -= exact
        least = exact.scaleb(-2 * DIGITS // 3, context)
        order, factors = np.arange(d), np.zeros((d, d), object)
        for c in range(d):
            r = c + max(range(d - c), key=lambda i: abs(a[c + i, c]))
            a[[c, r]], order[[c, r]], factors[[c, r]] = a[[r, c]], order[[r, c]], factors[[r, c]]
            if abs(a[c, c]) < least:
                a[c, c] = least
            if c + 1 < d:
                factors[c + 1 :, c] = a[c + 1 :, c] / a[c, c]
                a[c + 1 :, c + 1 :] = a[c + 1 :, c + 1 :] - np.outer(factors[c + 1 :, c], a[c, c + 1 :])

        def solved(b):
            y = b[order]
            for i in range(1, d):
                y[i] = y[i] - factors[i, :i].dot(y[:i])
            for i in range(d - 1, -1, -1):
                y[i] = (y[i] - (a[i, i + 1 :].dot(y[i + 1 :]) if i + 1 < d else 0)) / a[i, i]
            return y

        random = np.random.default_rng(7)
        basis = [np.array([Decimal(int(v)) for v in random.integers(-1000, 1001, d)], object) for _ in range(size)]
        for _ in range(3):
            now: list[np.ndarray] = []
            for vector in basis:
                vector = solved(vector)
                for _ in range(2):
                    vector = vector / vector.dot(vector).sqrt()
                    for other in now:
                        vector = vector - other * other.dot(vector)
                now.append(vector / vector.dot(vector).sqrt())
            basis = now
        for vector in basis:  # either sign will do; one is fixed
            if vector[max(range(d), key=lambda i: (abs(vector[i]), -i))] < 0:
                vector *= Decimal(-1)
        return [list(v) for v in basis]


@dataclass(frozen=True)
class Components:
    """The fitted transformation: per component a direction, its variance and its share of the whole."""

    n: int
    sums: tuple[int, ...]
    directions: tuple[tuple[float, ...], ...]
    spreads: tuple[float, ...]
    explained: tuple[float, ...]


def components(spark: SparkSession, found: Moments, wanted: int) -> Components:
    if not any(any(row) for row in found.scatter):
        return Components(found.n, found.sums, (), (), ())
    roots = largest_roots(characteristic_polynomial(spark, found.scatter), wanted)
    trace = sum(row[i] for i, row in enumerate(found.scatter))
    directions: list[tuple[float, ...]] = []
    for root in dict.fromkeys(roots):
        basis = null_space(found.scatter, root, roots.count(root))
        directions += [tuple(float(v) for v in vector) for vector in basis]
    with localcontext(Context(prec=DIGITS)):
        spread = lambda r: float((Decimal(r.numerator) / Decimal(r.denominator)).sqrt() / found.n)
        return Components(
            found.n, found.sums, tuple(directions), tuple(map(spread, roots)), tuple(float(r / trace) for r in roots)
        )


def _whitened(x: np.ndarray, fitted: Components) -> np.ndarray:
    """Vectors less their mean, projected, over the spread; whole parts are taken off exactly."""
    whole = np.array([s // fitted.n for s in fitted.sums], object)
    rest = np.array([float(Fraction(s % fitted.n, fitted.n)) for s in fitted.sums])
    near = _largest(x) < 2**61 and max(map(abs, whole), default=0) < 2**61
    centred = (x - whole.astype(np.int64) if near else x.astype(object) - whole).astype(float) - rest
    return centred @ np.array(fitted.directions).T / np.array(fitted.spreads)


def _deviations(x: np.ndarray, fitted: Components) -> list[int]:
    n, sums = fitted.n, np.array(fitted.sums, object)
    far = n * _largest(x) + max(map(abs, fitted.sums), default=0)
    y = n * x - sums.astype(np.int64) if x.shape[1] * far * far < 2**63 else n * x.astype(object) - sums
    return [int(v) for v in (y * y).sum(1)]


def identity_error(fit: DataFrame, fitted: Components) -> float:
    """The largest entry of the whitened distinct vectors' covariance less the identity, from the vectors themselves."""
    d, k = len(fitted.sums), len(fitted.directions)

    def add(batches):
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                w = _whitened(_matrix(batch.column(0).slice(start, 4096), d), fitted)
                w = np.hstack([w, np.ones((len(w), 1))])
                total += w.T @ w
        i, j = np.indices(total.shape)
        cells = [i.ravel().astype(np.int32), j.ravel().astype(np.int32), total.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=["i", "j", "v"])

    rows = fit.select("x").mapInArrow(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((k + 1, k + 1))
    for row in rows:
        total[row["i"], row["j"]] = row["v"]
    mean = total[:k, k] / fitted.n
    return float(np.abs(total[:k, :k] / fitted.n - np.outer(mean, mean) - np.eye(k)).max())


def _dimension(fit: DataFrame) -> int:
    size = F.size("x")
    found = fit.groupBy(size.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return found["d"] if found else 0


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", wanted: int = 4) -> DataFrame:
    """``vec_id``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    ``deviation`` is a decimal of 38 digits, null beyond them.
    """
    spark = rows.sparkSession
    vectors = quantised(rows, id_col, vector_col)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double,"
        " identity_error double"
    )
    fit = materialized(vectors.select("x").distinct(), "distinct-vectors")
    d = _dimension(fit)
    if d:
        fit = fit.filter(F.size("x") == d)
        fitted = components(spark, moments(fit, d), wanted)
    k = len(fitted.directions) if d else 0
    if not k:
        return spark.createDataFrame([], schema)
    error = identity_error(fit, fitted)

    def project(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                x = _matrix(part.column(1), d)
                far = [v if v < 10**38 else None for v in _deviations(x, fitted)]
                whole = pa.array(far, pa.int64() if max(v or 10**38 for v in far) < 2**63 else pa.decimal128(38))
                again = pa.array(np.repeat(np.arange(len(x)), k))
                m = len(again)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(again),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(m, fitted.n)),
                        whole.cast(pa.decimal128(38)).take(again),
                        pa.array(_whitened(x, fitted).ravel()),
                        pa.array(np.tile(np.array(fitted.explained), len(x))),
                        pa.array(np.full(m, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return vectors.filter(F.size("x") == d).mapInArrow(project, schema)
