from fractions import Fraction
from math import floor, inf, nan

import numpy as np
import pytest

from tabloom.llm import whitening as wh
from tabloom.llm.registered import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n int"


def determinant(matrix, t):
    """det(t - A) by fractions."""
    d = len(matrix)
    a = [[Fraction(t * (i == j)) - matrix[i][j] for j in range(d)] for i in range(d)]
    value = Fraction(1)
    for c in range(d):
        r = next((r for r in range(c, d) if a[r][c]), None)
        if r is None:
            return 0
        if r != c:
            a[c], a[r], value = a[r], a[c], -value
        value *= a[c][c]
        for r in range(c + 1, d):
            f = a[r][c] / a[c][c]
            a[r] = [x - f * y for x, y in zip(a[r], a[c])]
    return value


def scatter(x):
    x = np.array(x, object)
    return (len(x) * x.T.dot(x) - np.outer(x.sum(0), x.sum(0))).tolist()


def expected(rows, wanted=4):
    """Deviations and whitened values (up to sign) by plain means, of rows (id, vector)."""
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = [tuple(floor(256 * float(np.float32(c))) for c in v) for _, v in good]
    fit = list(dict.fromkeys(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    values, vectors = np.linalg.eigh(np.array(scatter(fit), float) / n**2)
    keep = [k for k in range(len(values))[::-1] if values[k] > 1e-9][:wanted]
    out = {}
    for (i, _), v in zip(good, x):
        far = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        w = [(np.array(v) - np.array(sums) / n) @ vectors[:, k] / values[k] ** 0.5 for k in keep]
        out.setdefault(i, []).append((n, far, w, [values[k] / values.sum() for k in keep]))
    return out


@pytest.mark.parametrize("d", [1, 2, 3, 7, 12])
def test_polynomial_against_determinants(spark, d):
    x = np.random.default_rng(d).integers(-300, 300, (d + 3, d))
    x[:, d // 2] = 5 if d > 2 else x[:, d // 2]  # a dimension without variance
    found = wh.characteristic_polynomial(spark, scatter(x.tolist()))
    assert len(found) == d + 1 and found[d] == 1
    for t in (-3, 0, 1, 10**6):
        assert sum(c * t**k for k, c in enumerate(found)) == determinant(scatter(x.tolist()), t)


def test_roots_of_known_polynomials():
    def product(roots):
        p = [1]
        for r in roots:
            p = [(p[i - 1] if i else 0) - r * (p[i] if i < len(p) else 0) for i in range(len(p) + 1)]
        return p

    p = product([0, 0, 3, 7, 7, 10**9, 10**9 + 1])
    assert [wh.roots_above(p, t) for t in (-1, 0, 3, 6, 7, 10**9)] == [7, 5, 4, 4, 2, 1]
    assert [round(r) for r in wh.largest_roots(p, 9)] == [10**9 + 1, 10**9, 7, 7, 3]
    high, low = wh.largest_roots([2, -4, 1], 2)  # two and the root of two, more or less
    assert all(abs((r - 2) ** 2 - 2) < Fraction(1, 2**175) for r in (high, low)) and high > 3 > 1 > low
    assert wh.largest_roots([0, 0, 1], 4) == []


def test_components_of_a_multiple_root():
    matrix = (np.eye(5, dtype=int) * 6 - 1).tolist()  # 6 four times, 1 once
    roots = [Fraction(6)] * 4
    basis = np.array([[float(v) for v in row] for row in wh.null_space(matrix, roots[0], 4)])
    assert np.allclose(basis @ basis.T, np.eye(4), atol=1e-15)
    assert np.abs(np.array(matrix) @ basis.T - 6 * basis.T).max() < 1e-14


def test_components_of_close_roots_are_exact_to_a_double():
    q = np.array([[3, 4], [4, -3]])
    close = q @ np.diag([10**14, 10**14 + 1]) @ q  # eigenvectors (3, 4) / 5 and (4, -3) / 5
    matrix = [[int(v) for v in row] for row in close]
    trace, det = matrix[0][0] + matrix[1][1], matrix[0][0] * matrix[1][1] - matrix[0][1] ** 2
    roots = wh.largest_roots([det, -trace, 1], 2)
    assert [round(r) for r in roots] == [25 * (10**14 + 1), 25 * 10**14]
    first, second = (wh.null_space(matrix, r, 1)[0] for r in roots)
    assert np.allclose([float(v) for v in first], [0.8, -0.6], atol=1e-16, rtol=0)
    assert np.allclose([float(v) for v in second], [0.6, 0.8], atol=1e-16, rtol=0)


def compare(frame, rows):
    want, got = expected(rows), {}
    for r in frame.collect():
        got.setdefault(r["vec_id"], []).append(r)
    assert {i: len(found) for i, found in got.items()} == {i: sum(len(w[2]) for w in of) for i, of in want.items()}
    for i, found in got.items():
        n, far, whitened, explained = want[i][0]
        for r in found:
            k = r["component"] - 1
            assert (r["n"], r["deviation"]) == (n, far)
            assert abs(r["whitened"]) == pytest.approx(abs(whitened[k]), abs=1e-9)
            assert r["explained"] == pytest.approx(explained[k], rel=1e-9)
            assert r["identity_error"] < 1e-9
    return got


def test_whole_table(spark, tables):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{tables}/embeddings.parquet").collect()]
    got = compare(QUERIES["op13_embedding_whitening"](spark, tables), rows)
    by_component = {}
    for found in got.values():
        for r in found:
            by_component.setdefault(r["component"], []).append(r["whitened"])
    assert sorted(by_component) == [1, 2, 3, 4]


def test_awkward_rows(spark):
    random = np.random.default_rng(2)
    rows = [(i, [float(v) for v in random.normal(size=3)]) for i in range(40)]
    rows += [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [nan, 1.0, 1.0]), (54, [inf, 0.0, 0.0]), (55, [-0.0, 0.0, -0.001])]
    rows += [(60, rows[0][1])] * 200 + [(None, rows[1][1])]
    frame = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA).repartition(4)
    result = wh.whiten(frame)
    compare(result, rows)
    assert {r["component"] for r in result.collect()} == {1, 2, 3}
    mixed = frame.unionByName(spark.createDataFrame([(70, [1.0, 2.0], 1, "x", 2)], SCHEMA))
    assert wh.whiten(mixed).count() == result.count()  # another length has no result


def test_no_variance_and_empty_tables(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        assert wh.whiten(spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)).collect() == []


def test_huge_entries(spark):
    rows = [(1, [3e15, 1.0]), (2, [-3e15, 2.0]), (3, [1e15, 3.0]), (4, [1e30, 0.0]), (5, [-1e300, 5.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = wh.whiten(frame).collect()
    assert len(found) == 10 and all(np.isfinite(r["whitened"]) for r in found)
    x = np.array([[min(max(floor(256 * c), -(2**63)), 2**63 - 1) for c in v] for _, v in rows], object)
    far = ((5 * x - x.sum(0)) ** 2).sum(1)
    assert {r["vec_id"]: r["deviation"] for r in found} == {
        i: int(f) if f < 10**38 else None for (i, _), f in zip(rows, far)
    }
    assert found[0]["identity_error"] < 1e-4
