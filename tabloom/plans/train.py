"""Training, evaluation and comparison of the classifiers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col
from ..operators import models, splitting
from ..operators.evaluation import best_model
from ..sources.workspace import materialized
from .prepare import KEY


#: Partitions of a training table; for more rows than some ten million, pass more.
PARTITIONS = 16


@dataclass
class Training:
    """Trained models with what they were measured on."""

    matrix: models.Matrix
    models: dict[str, PipelineModel]
    results: DataFrame
    best: str


def training_matrix(
    table: DataFrame, target: str = "Churn", keys: Sequence[str] = (KEY,), partitions: int = PARTITIONS
) -> models.Matrix:
    """Features with split and fold of each row, written once for the many scans of training.

    Rows go to a declared number of partitions by their key and are sorted
    there: bagging draws by partition, so models depend on the rows and this
    number, not on cores or on how the table happened to be cut.
    """
    matrix = models.model_matrix(table, target, keys)
    order = [col(k) for k in keys]
    dealt = matrix.frame.repartition(partitions, *order).sortWithinPartitions(*order)
    marked = splitting.assign_folds(splitting.stratified_split(materialized(dealt, "matrix"), keys, matrix.label), keys)
    return models.Matrix(marked, matrix.features, matrix.label, list(keys))


def rows_of(matrix: models.Matrix, split: str) -> DataFrame:
    return matrix.frame.where(F.col("split") == split)


def train_and_compare(matrix: models.Matrix, rounds: int = 100, forest_depth: int = models.FOREST_DEPTH) -> Training:
    """All classifiers fitted on the training rows and measured on the test rows."""
    fitted = models.train_all(matrix, rows_of(matrix, "train"), rounds, forest_depth=forest_depth)
    results = materialized(models.evaluate(fitted, rows_of(matrix, "test"), matrix.label), "results")
    return Training(matrix, fitted, results, best_model(results).first().best_model)


def save(training: Training, root: str) -> None:
    """Models and results, to be taken up again with :func:`load`."""
    models.save_models(training.models, f"{root}/models")
    training.results.write.mode("overwrite").parquet(f"{root}/results")


def load(matrix: models.Matrix, root: str) -> Training:
    results = matrix.frame.sparkSession.read.parquet(f"{root}/results")
    names = [r.model for r in results.select("model").collect()]
    fitted = {name: models.load_model(f"{root}/models/{name}") for name in names}
    return Training(matrix, fitted, results, best_model(results).first().best_model)


def cross_validate_best(training: Training, rounds: int = 100) -> DataFrame:
    """Scores per fold of the best classifier, with mean and population standard deviation of its F1."""
    scores = materialized(
        models.cross_validate(training.best, training.matrix, training.matrix.frame, rounds=rounds), "fold-scores"
    )
    summary = models.cv_summary(scores).select("cv_mean_f1", "cv_std_f1").first()
    return scores.withColumns(
        {"model": F.lit(training.best), "cv_mean_f1": F.lit(summary.cv_mean_f1), "cv_std_f1": F.lit(summary.cv_std_f1)}
    )


def report(training: Training) -> DataFrame:
    """Comparison, best model and the feature importances of the best model."""
    model = training.models[training.best]
    if training.best == "kernel_svc":  # has no weights of features
        found = models.permutation_importance(model, training.matrix, rows_of(training.matrix, "test"), repeats=1)
        return models.model_report(training.results, found.select("feature", "importance"))
    importance = models.feature_importance(model, training.matrix.features, training.matrix.frame)
    return models.model_report(training.results, importance)
