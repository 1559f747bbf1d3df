"""Components against an exact decomposition, and projected rows."""

import numpy as np
import pytest

from tabloom.operators import projection


def _table(n, d, seed=1):
    random = np.random.default_rng(seed)
    base = random.normal(size=(n, 6)) * [9, 6, 4, 3, 2, 1.5]
    x = base @ random.normal(size=(6, d)) + random.normal(size=(n, d))
    x[:, 3] = 7.0  # a column without variance
    return x


@pytest.fixture(scope="module")
def wide(spark):
    x = _table(400, 59)
    names = [f"f{i}" for i in range(59)]
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    return x, names, spark.createDataFrame(rows, ["id", *names]).repartition(5)


def _exact(x):
    spread = x.std(0, ddof=1)
    a = (x - x.mean(0)) / np.where(spread > 0, spread, 1)
    values, vectors = np.linalg.eigh(a.T @ a)
    return a, values[::-1] / ((len(x) - 1) * (spread > 0).sum()), vectors[:, ::-1].T


def test_components_of_59_columns(wide):
    x, names, df = wide
    fitted = projection.fit_projection(df, names, 5)
    a, shares, vectors = _exact(x)
    assert np.allclose(fitted.shares, shares[:5], rtol=1e-6)
    for row, want in zip(fitted.directions, vectors):
        assert abs(row @ want) == pytest.approx(1, abs=1e-6) and row[np.argmax(np.abs(row))] > 0
    assert np.allclose(fitted.directions @ fitted.directions.T, np.eye(5), atol=1e-9)
    again = projection.fit_projection(df.repartition(3), names, 5)
    assert np.allclose(again.directions, fitted.directions, atol=1e-6)


def test_projected_rows(wide):
    x, names, df = wide
    fitted = projection.fit_projection(df, names, 3)
    a, _, _ = _exact(x)
    rows = {r.id: r[1:] for r in projection.project(df, fitted, ["id"]).collect()}
    want = a @ fitted.directions.T
    assert len(rows) == len(x) and all(np.allclose(rows[i], want[i], atol=1e-9) for i in rows)


def test_missing_values_and_small_tables(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, float("nan"), 4.0), (3, 5.0, 6.0)], "k int, a double, b double")
    fitted = projection.fit_projection(df, ["a", "b"], 5)
    found = projection.project(df, fitted, ["k"]).collect()
    assert len(found) == 3 and len(fitted.directions) == 2 and all(np.isfinite(r[1:]).all() for r in found)
    same = spark.createDataFrame([(1, 2.0)] * 3, "k int, a double")
    none = projection.fit_projection(same, ["a"], 2)
    assert none.shares == () and projection.project(same, none, ["k"]).columns == ["k"]
    assert projection.project(df.limit(0), fitted, ["k"]).count() == 0
