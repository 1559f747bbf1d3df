"""Splits, evaluation, training."""

import pytest
from pyspark.sql import functions as F

from tabloom.functions import quantiles as Q
from tabloom.operators import drift, evaluation, models, splitting
from tabloom.plans import train as plan
from tabloom.plans.run import run


@pytest.fixture(scope="module")
def points(spark):
    # a decides the class, b and c are noise
    rows = [
        (str(i), (i * 37 % 900) / 900, (i * 53 % 900) / 900, None if i % 50 == 0 else (i * 71 % 900) / 900)
        for i in range(900)
    ]
    df = spark.createDataFrame(rows, "customerID string, a double, b double, c double")
    return df.withColumn("Churn", (F.col("a") > 0.66).cast("int"))


def test_stratified_split_is_exact(spark, points, monkeypatch):
    for gather in (50_000, 20):
        monkeypatch.setattr(Q, "GATHER_ROWS", gather)
        marked = splitting.stratified_split(points, ["customerID"], "Churn")
        sizes = {(r.Churn, r.split): r["count"] for r in marked.groupBy("Churn", "split").count().collect()}
        positives = sum(n for (c, _), n in sizes.items() if c == 1)
        assert sizes[1, "test"] == round(positives * 0.2) and sizes[0, "test"] == round((900 - positives) * 0.2)
    again = splitting.stratified_split(points.repartition(9), ["customerID"], "Churn")
    assert marked.exceptAll(again).count() == 0


def test_small_and_missing_classes(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None), ("d", "y")], "k string, y string")
    marked = splitting.stratified_split(df, ["k"], "y", 0.5)
    assert marked.where("split = 'test'").count() == 3  # one of two, and each single row rounds up


def test_folds_cover_everything(points):
    folds = splitting.assign_folds(points, ["customerID"])
    assert {r.fold for r in folds.select("fold").distinct().collect()} == set(range(5))
    assert splitting.hashed_split(points, ["customerID"]).where("split = 'test'").count() in range(120, 240)


def test_class_weights(points):
    assert splitting.class_weights(points, "Churn").count() == 2
    total = splitting.with_class_weight(points, "Churn").groupBy("Churn").agg(F.sum("class_weight").alias("w"))
    assert [r.w for r in total.collect()] == pytest.approx([450.0, 450.0])


def scores(spark, rows):
    return spark.createDataFrame(rows, "label int, prediction int, score double")


def test_metrics(spark):
    df = scores(spark, [(1, 1, 0.9), (1, 0, 0.5), (0, 1, 0.5), (0, 0, 0.1), (0, 0, 0.2)])
    row = evaluation.metrics(evaluation.confusion(df, "label", "prediction")).first()
    assert (row.tp, row.fp, row.fn, row.tn) == (1, 1, 1, 2)
    assert (row.accuracy, row.precision, row.recall, row.f1_score) == pytest.approx((0.6, 0.5, 0.5, 0.5))
    # pairs: 0.9 beats 3; 0.5 ties one and beats two
    assert evaluation.roc_auc(df, "label", "score").first().roc_auc == pytest.approx(5.5 / 6)


def test_metrics_without_cases(spark):
    df = scores(spark, [(0, 0, 0.1), (0, 0, 0.2)])
    row = evaluation.metrics(evaluation.confusion(df, "label", "prediction")).first()
    assert (row.accuracy, row.precision, row.f1_score) == (1.0, 0.0, 0.0)
    assert evaluation.roc_auc(df, "label", "score").first().roc_auc is None


def test_auc_of_several_models_against_brute_force(spark):
    rows = [(m, i * 7 % 3 == 0, (i * (13 if m == "p" else 29)) % 50) for m in ("p", "q") for i in range(200)]
    df = spark.createDataFrame([(m, int(y), float(s)) for m, y, s in rows], "model string, label int, score double")
    found = {r.model: r.roc_auc for r in evaluation.roc_auc(df.repartition(8), "label", "score", by="model").collect()}
    for model in ("p", "q"):
        pos = [s for m, y, s in rows if m == model and y]
        neg = [s for m, y, s in rows if m == model and not y]
        wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert found[model] == pytest.approx(wins / (len(pos) * len(neg)))


def test_best_model_of_equals_is_the_first_name(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.1)], "model string, f1_score double")
    assert tuple(evaluation.best_model(df).first()) == ("a", 0.5)


def test_target_is_found(spark):
    assert models.resolve_target(["x", "Churn"]) == "Churn"
    assert models.resolve_target(["x", "is_churned", "churn_2"]) == "is_churned"
    with pytest.raises(ValueError):
        models.resolve_target(["x"])


def test_training(spark, points, tmp_path):
    matrix = plan.training_matrix(points)
    assert matrix.features == ["a", "b", "c"] and matrix.frame.where("c IS NULL").count() == 0
    training = plan.train_and_compare(matrix, rounds=5)
    results = {r.model: r for r in training.results.collect()}
    assert set(results) == {"logistic_regression", "random_forest", "gradient_boosting", "kernel_svc"}
    assert all(r.roc_auc > 0.95 and r.f1_score > 0.85 for r in results.values())
    assert training.best == min(results, key=lambda m: (-results[m].f1_score, m))

    again = models.train("random_forest", matrix, plan.rows_of(matrix, "train"), rounds=5)
    one = models.score(again, matrix.frame, "Churn", ["customerID"])
    two = models.score(training.models["random_forest"], matrix.frame, "Churn", ["customerID"])
    assert one.exceptAll(two).count() == 0

    plan.save(training, str(tmp_path))
    loaded = plan.load(matrix, str(tmp_path))
    assert loaded.best == training.best
    sections = {r.section for r in plan.report(loaded).select("section").distinct().collect()}
    assert sections == {"comparison", "best_model", "importance"}
    first = models.feature_importance(loaded.models["gradient_boosting"], matrix.features, matrix.frame).first()
    assert first.feature == "a"

    weighted = splitting.with_class_weight(matrix.frame, "Churn")
    heavier = models.train("logistic_regression", matrix, weighted, weight="class_weight")

    def positives(model):
        return models.score(model, matrix.frame, "Churn").agg(F.sum("prediction")).first()[0]

    assert positives(heavier) > positives(training.models["logistic_regression"])

    folds = models.cross_validate("logistic_regression", matrix, matrix.frame)
    summary = models.cv_summary(folds).first()
    assert summary.folds == 5 and summary.cv_mean_f1 > 0.8


def test_drift_and_quality(spark):
    base = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    same = drift.population_stability(base, base, "x")
    assert same.count() == 10 and same.agg(F.sum("psi")).first()[0] == pytest.approx(0)
    moved = drift.population_stability(base, base.select((F.col("x") + 500).alias("x")), "x")
    assert moved.agg(F.sum("psi")).first()[0] > 1
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None), (-4, "d")], "i int, s string")
    shares = {r.rule: r.passed_pct for r in drift.quality_shares(df, {"positive": "i > 0", "named": "s <> ''"}).collect()}
    assert shares == {"positive": 50.0, "named": 75.0, "all_rules": 25.0, "coverage": 75.0}


def test_whole_run(spark, tables, tmp_path):
    from tabloom.plans.customer_profile import customer_profile

    rows = customer_profile(spark, tables)
    stages = run({"one": rows, "two": rows}, str(tmp_path), "2024-01-31", rounds=2).collect()
    assert [s.stage for s in stages] == ["land"] * 2 + ["validate"] * 2 + ["prepare"] * 2 + ["transform", "version", "train"]
    assert stages[0].row_count == 153 and stages[4].row_count == 150 and stages[-1].column_count == 59
