"""The kernel machine, its probabilities, and importances by permutation."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.sql import functions as F

from tabloom.operators import kernel_machine, models
from tabloom.operators.evaluation import confusion, metrics, roc_auc


def _ring(n, seed):
    """A disc inside a ring: no line separates them."""
    random = np.random.default_rng(seed)
    radius = np.where(np.arange(n) % 3 == 0, random.uniform(0, 1, n), random.uniform(1.4, 2.4, n))
    angle = random.uniform(0, 2 * math.pi, n)
    return [(i, float(r * math.cos(a)), float(r * math.sin(a)), int(r < 1.2)) for i, (r, a) in enumerate(zip(radius, angle))]


@pytest.fixture(scope="module")
def ring(spark):
    schema = "id long, x double, y double, inner int"
    frames = [spark.createDataFrame(_ring(n, s), schema).repartition(4) for n, s in ((900, 1), (600, 2))]
    return models.Matrix(frames[0], ["x", "y"], "inner", ["id"]), frames[1]


@pytest.fixture(scope="module")
def fitted(ring):
    matrix, _ = ring
    return {name: models.train(name, matrix, matrix.frame) for name in ("kernel_svc", "linear_svc")}


def test_a_ring_is_separated(ring, fitted):
    matrix, test = ring
    f1 = {
        name: metrics(confusion(models.score(model, test, "inner"), "label", "prediction")).first().f1_score
        for name, model in fitted.items()
    }
    assert f1["kernel_svc"] > 0.97 and f1["linear_svc"] < 0.6


def test_probabilities(ring, fitted):
    _, test = ring
    scored = models.score(fitted["kernel_svc"], test, "inner", ["id"])
    rows = scored.collect()
    assert all(0 <= r.score <= 1 for r in rows)
    lowest = min(r.score for r in rows if r.prediction == 1)
    assert max(r.score for r in rows if r.prediction == 0) <= lowest
    assert roc_auc(scored, "label", "score").first().roc_auc > 0.99
    bins = kernel_machine.calibration(scored, 5).collect()
    assert sum(b.row_count for b in bins) == 600
    assert sum(b.row_count * abs(b.mean_score - b.positive_share) for b in bins) / 600 < 0.1


def test_saved_models_score_alike(ring, fitted, tmp_path):
    _, test = ring
    path = models.save_models({"kernel_svc": fitted["kernel_svc"]}, str(tmp_path))["kernel_svc"]
    again = models.score(models.load_model(path), test, "inner", ["id"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, models.score(fitted["kernel_svc"], test, "inner", ["id"]).collect()))


def test_random_features_approximate_the_kernel():
    points = np.random.default_rng(3).normal(size=(40, 5))
    weights, shift = kernel_machine.projections(5, 20_000, 0.0, 1)
    lifted = math.sqrt(2 / 20_000) * np.cos(points @ weights + shift)
    distance = ((points[:, None] - points[None]) ** 2).sum(-1)
    assert np.abs(lifted @ lifted.T - np.exp(-distance / 5)).max() < 0.05


def _platt(margins, labels):
    """Gradient of the smoothed loss at the optimum is zero; found here by many small Newton steps."""
    p, n = sum(labels), len(labels) - sum(labels)
    t = np.where(np.array(labels) == 1, (p + 1) / (p + 2), 1 / (n + 2))
    x = np.array([0.0, math.log((p + 1) / (n + 1))])
    a = np.stack([np.array(margins), np.ones(len(t))], 1)
    for _ in range(2000):
        q = 1 / (1 + np.exp(-a @ x))
        x = x + 0.1 * np.linalg.solve((a * (q * (1 - q))[:, None]).T @ a + 1e-10 * np.eye(2), a.T @ (t - q))
    return x


@pytest.mark.parametrize("spread", [0.3, 1.0, 40.0])
def test_platt_scaling_finds_the_optimum(spark, spread):
    random = np.random.default_rng(4)
    labels = [int(v) for v in random.random(300) < 0.3]
    margins = [float(spread * (random.normal() + 2 * v - 1)) for v in labels]
    rows = spark.createDataFrame(list(zip(margins, labels)), "margin double, label int")
    assert np.allclose(kernel_machine.fit_platt(rows), _platt(margins, labels), rtol=1e-2, atol=1e-3)


def test_platt_scaling_of_one_class_and_of_separable_margins(spark):
    one = spark.createDataFrame([(1.0, 1), (2.0, 1)], "margin double, label int")
    assert kernel_machine.fit_platt(one) == (0.0, math.log(3))
    apart = spark.createDataFrame([(float(i), int(i > 0)) for i in range(-20, 21)], "margin double, label int")
    slope, shift = kernel_machine.fit_platt(apart)
    assert slope > 0 and math.isfinite(slope) and math.isfinite(shift)


def test_planted_columns_rank_first(spark):
    """One column decides; noise columns lose nothing; repeatable."""
    random = np.random.default_rng(5)
    rows = [(i, *map(float, random.normal(size=4))) for i in range(500)]
    rows = [(*r, int(r[2] > 0.2)) for r in rows]
    frame = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y int").repartition(3)
    matrix = models.Matrix(frame, ["a", "b", "c", "d"], "y", ["id"])
    for name in models.COMPARED:
        model = models.train(name, matrix, frame, rounds=10)
        found = models.permutation_importance(model, matrix, frame, repeats=2).collect()
        assert found[0].feature == "b" and found[0].importance > 0.3, name
        assert all(abs(r.importance) < 0.1 for r in found[1:]) and all(r.spread >= 0 for r in found)
    assert found == models.permutation_importance(model, matrix, frame, repeats=2).collect()


def test_no_weights_to_read(ring, fitted):
    with pytest.raises(ValueError, match="permutation_importance"):
        models.feature_importance(fitted["kernel_svc"], ["x", "y"], ring[1])


@pytest.mark.parametrize("weight", [None, "w"])
def test_the_machine_is_that_of_the_library(ring, weight, monkeypatch):
    """Weights are those of MLlib's machine on the same random features; all machines learn in the passes of one, over packed rows."""
    monkeypatch.setattr(kernel_machine, "RESULTS", 2)  # tasks' sums are added in steps
    monkeypatch.setattr(kernel_machine, "SLICE", 100)
    passes, losses = [], kernel_machine._Passes.losses
    monkeypatch.setattr(kernel_machine._Passes, "losses", lambda self, points: passes.append(len(points)) or losses(self, points))
    rows = ring[0].frame.withColumn("w", 1 + (F.col("id") % 3))
    model = kernel_machine.fit_kernel_machine(rows, ["x", "y"], "inner", 1 / 900, weight, size=32)
    weighted = {"weightCol": weight} if weight else {}
    library = LinearSVC(maxIter=100, tol=1e-4, regParam=1 / 900, standardization=False, labelCol="inner", **weighted)
    wanted = library.fit(PipelineModel(stages=model.stages[:3]).transform(rows))
    assert np.abs(model.stages[3].coefficients.toArray() - wanted.coefficients.toArray()).max() < 1e-6
    assert abs(model.stages[3].intercept - wanted.intercept) < 1e-6
    assert passes[0] == 4 and len(passes) < 150


def test_packed_rows_and_cosines():
    random = np.random.default_rng(1)
    x = np.stack([random.integers(0, 2, 500), random.normal(size=500), random.integers(0, 9, 500) / 4, random.integers(0, 10**9, 500)], axis=1).astype(float)
    part, label, weight = random.integers(0, 3, 500).astype(float), x[:, 0], np.full(500, 0.1)
    block = kernel_machine._packed(part, label, weight, x)
    assert all(np.array_equal(a, b) for a, b in zip(kernel_machine._unpacked(block), (part, label, weight, x)))
    assert len(block) < 500 * (1 + 1 + 8 + 1 + 8 + 4 + 8) + 500
    turns = random.normal(size=(50, 40)) * 5
    assert np.abs(kernel_machine.cosines(turns.copy()) - np.cos(2 * np.pi * turns)).max() < 1e-13


def test_exchanged_features_without_copies_of_rows(ring, fitted):
    """The kernel machine's confusions are those of scoring a copy of each row for each feature."""
    matrix, test = ring
    dealt = models._permuted(matrix, test, 0)
    own = kernel_machine.exchanged_confusion(fitted["kernel_svc"], dealt, matrix.features)
    copied = models._exchanged(fitted["kernel_svc"], matrix, dealt)
    order = ["j", "tp", "fp", "fn", "tn"]
    assert sorted(map(tuple, own.select(order).collect())) == sorted(map(tuple, copied.select(order).collect()))
    assert kernel_machine.exchanged_confusion(fitted["linear_svc"], dealt, matrix.features) is None


def test_fewer_fits_at_once_on_large_tables(spark, monkeypatch):
    monkeypatch.setattr(models, "FITTED", 1000)
    assert [models.at_once(spark.range(n), ["a", "b"], 4) for n in (0, 100, 200, 400, 10_000)] == [4, 4, 2, 1, 1]
