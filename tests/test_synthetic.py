"""Neighbours by random projections against brute force, and synthetic rows of small classes."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import synthetic
from tabloom.sources.workspace import workspace

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def uneven(spark):
    """900 rows of one class, 250 of another, copies of one vector, a class of one row, and missing values."""
    rng, rows = np.random.default_rng(7), []
    for n, label, middle in ((900, "large", 0.0), (250, "small", 5.0)):
        for x in rng.normal(middle, 1.0, size=(n, 3)):
            rows.append((len(rows), f"name {len(rows)}", label, *map(float, x)))
    rows += [(len(rows) + i, "same", "copies", 1.0, 2.0, 3.0) for i in range(70)]
    rows += [(5000, "alone", "alone", 4.0, 4.0, 4.0)]
    rows += [(6000 + i, "odd", None, None if i % 2 else float("nan"), float(i), float(i)) for i in range(6)]
    return spark.createDataFrame(rows, "id long, name string, label string, a double, b double, c double").repartition(5)


def test_classes_become_equal_and_rows_stay(uneven):
    made = synthetic.add_synthetic(uneven, "label", ["id"], FEATURES).cache()
    sizes = {r["label"]: r["count"] for r in made.groupBy("label").count().collect()}
    assert sizes == dict.fromkeys(["large", "small", "copies", "alone", None], 900)
    own = made.filter("synthetic = 0")
    assert own.count() == uneven.count() and own.select("id").distinct().count() == uneven.count()
    assert made.columns == [*uneven.columns, "synthetic"]
    assert made.filter("synthetic > 0").groupBy("id", "synthetic").count().filter("count > 1").count() == 0
    assert made.filter("label IN ('copies', 'alone') AND (a, b, c) NOT IN ((1D, 2D, 3D), (4D, 4D, 4D))").count() == 0
    missing = made.filter("label IS NULL AND synthetic > 0")
    assert missing.filter("a IS NOT NULL").count() == 0 and missing.filter("b IS NULL OR b NOT BETWEEN 0 AND 5").count() == 0


def test_synthetic_rows_lie_between_a_row_and_a_near_one(uneven):
    made = synthetic.add_synthetic(uneven, "label", ["id"], FEATURES, k=5, leaf=32).filter("label = 'small'")
    rows = {r["id"]: np.array([r["a"], r["b"], r["c"]]) for r in uneven.filter("label = 'small'").collect()}
    table = np.stack(list(rows.values()))
    near, moved = 0, made.filter("synthetic > 0").collect()
    for r in moved:
        parent, point = rows[r["id"]], np.array([r["a"], r["b"], r["c"]])
        along, step = table - parent, point - parent
        # on the segment to some row of the class
        share = np.divide((along @ step), (along**2).sum(1), out=np.zeros(len(table)), where=(along**2).sum(1) > 0)
        off = np.abs(step - share[:, None] * along).max(1)
        ends = np.flatnonzero((off < 1e-9) & (share >= 0) & (share < 1))
        assert len(ends)
        nearest = np.argsort(((table - parent) ** 2).sum(1))[1:8]
        near += bool(set(ends) & set(nearest))
    assert near >= 0.9 * len(moved)


@pytest.mark.parametrize("width", [3, 20])
def test_neighbours_against_brute_force(spark, width):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, width)) @ rng.normal(size=(width, width)) * rng.uniform(0.2, 2, width)
    x[700:] += 3
    names = [f"{'p' if i < 700 else 'q'}{i}" for i in range(1500)]
    nodes = spark.createDataFrame([(n[0], n, list(map(float, r))) for n, r in zip(names, x)], "class string, node string, vector array<double>")
    got = {r["node"]: r["near"] for r in synthetic.nearest(nodes.repartition(4), width, 5).collect()}
    found = 0
    for i, name in enumerate(names):
        apart = ((x - x[i]) ** 2).sum(1)
        apart[i] = np.inf
        apart[[n[0] != name[0] for n in names]] = np.inf
        found += len({names[j] for j in np.argsort(apart)[:5]} & set(got[name]))
        assert len(got[name]) == 5 and all(n[0] == name[0] for n in got[name])
    assert found >= 0.9 * 5 * len(names)


def test_same_in_every_run_and_empty(uneven):
    rows = lambda d: sorted(map(str, synthetic.add_synthetic(d, "label", ["id"], FEATURES).collect()))
    assert rows(uneven) == rows(uneven.repartition(3))
    assert synthetic.add_synthetic(uneven.limit(0), "label", ["id"], FEATURES).count() == 0


def test_leaves_that_projections_cannot_cut_are_dealt(spark, monkeypatch):
    """More passes than allowed are never needed for different vectors; with one pass left every node still has neighbours."""
    monkeypatch.setattr(synthetic, "ROUNDS", 1)
    monkeypatch.setattr(synthetic, "LEVELS", 1)
    x = np.random.default_rng(1).normal(size=(400, 2))
    nodes = spark.createDataFrame([("k", f"n{i}", list(map(float, r))) for i, r in enumerate(x)], "class string, node string, vector array<double>")
    got = synthetic.nearest(nodes, 2, 5, leaf=40)
    assert got.count() == 400 and got.filter(F.size("near") < 5).count() == 0


def test_branches_cut_by_passes_and_few_wanted_nodes(spark, monkeypatch, tmp_path):
    """Neighbours are the same whether a task cuts a class alone or passes cut it before, and whether or not others are asked for."""
    x = np.random.default_rng(5).normal(size=(3000, 3))
    rows = [("p" if i < 2500 else "q", f"n{i}", list(map(float, r)), i % 500 == 7) for i, r in enumerate(x)]
    spark.createDataFrame(rows, "class string, node string, vector array<double>, wanted boolean").repartition(5).write.parquet(str(tmp_path / "n"))
    nodes = spark.read.parquet(str(tmp_path / "n"))
    found = lambda df: {r["node"]: r["near"] for r in synthetic.nearest(df, 3, 5, leaf=64).collect()}
    alone = found(nodes.drop("wanted"))
    monkeypatch.setattr(synthetic, "HELD", 300)
    assert len(alone) == 3000 and found(nodes.drop("wanted")) == alone
    assert found(nodes) == {r[1]: alone[r[1]] for r in rows if r[3]}


def test_tables_written_stay_near_the_size_of_the_input(spark, tmp_path):
    """Nothing is written once for each tree and cut: nodes of the small class, and rows that become parents."""
    x = np.random.default_rng(2).normal(size=(12000, 3))
    rows = [(i, "large" if i < 6100 else "small", *map(float, r)) for i, r in enumerate(x)]
    spark.createDataFrame(rows, "id long, label string, a double, b double, c double").repartition(4).write.parquet(str(tmp_path / "t"))
    size = lambda folder: sum(f.stat().st_size for f in Path(str(folder).removeprefix("file:")).rglob("*") if f.is_file())
    before = size(workspace(spark))
    made = synthetic.add_synthetic(spark.read.parquet(str(tmp_path / "t")), "label", ["id"], FEATURES)
    assert {r["label"]: r["count"] for r in made.groupBy("label").count().collect()} == {"large": 6100, "small": 6100}
    assert size(workspace(spark)) - before < 2 * size(tmp_path / "t")
