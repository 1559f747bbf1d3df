"""Classifiers on a prepared feature table, trained with MLlib."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, names_like, numeric_columns
from ..functions.jobs import side_by_side
from ..functions.ordering import with_running_totals
from ..sources.workspace import materialized, workspace
from .cleaning import fill_missing, fit_fill
from .evaluation import best_model, compare_models, confusion, metrics, roc_auc
from .kernel_machine import exchanged_confusion, fit_kernel_machine

SEED = 42
TOLERANCE = 1e-4  # of the linear models
FOREST_DEPTH = 10  # MLlib allows 30; deeper trees cost memory that doubles with each level
#: Numbers of rows that fits running together keep; beyond, what they keep would go to disk and be read from there.
FITTED = 200_000_000
SCALED = ("logistic_regression", "linear_svc")
#: The classifiers that are trained and compared; a linear machine is there besides.
COMPARED = ("logistic_regression", "random_forest", "gradient_boosting", "kernel_svc")


def resolve_target(names: Sequence[str], target: str = "Churn") -> str:
    """The target column, else the first one named like it."""
    if target in names:
        return target
    similar = names_like(names, [target])
    if not similar:
        raise ValueError(f"no target column {target}")
    return similar[0]


@dataclass
class Matrix:
    """Numeric features without missing values, with key and label."""

    frame: DataFrame
    features: list[str]
    label: str
    keys: list[str] = field(default_factory=list)


def model_matrix(df: DataFrame, target: str = "Churn", keys: Sequence[str] = ()) -> Matrix:
    """Numeric columns only, missing values filled with the median."""
    label = resolve_target([c for c in df.columns if c not in keys], target)
    features = numeric_columns(df, [label, *keys])
    filled = fill_missing(df, fit_fill(df, features))
    frame = filled.select(*[col(c) for c in keys], *[col(c).cast("double").alias(c) for c in features], col(label))
    return Matrix(frame, features, label, list(keys))


def estimators(
    label: str, rows: int, rounds: int = 100, weight: str | None = None, forest_depth: int = FOREST_DEPTH
) -> dict[str, Callable]:
    """The classifiers that MLlib has, with the settings they are compared with.

    Linear models get an L2 penalty of 1 / rows, which is a cost factor of 1
    on the summed loss. The linear support vector machine gives a margin; the
    kernel machine (see :mod:`.kernel_machine`) gives probabilities.
    """
    columns = {"labelCol": label, "featuresCol": "features"} | ({"weightCol": weight} if weight else {})
    penalty = 1.0 / max(rows, 1)
    return {
        "logistic_regression": lambda: LogisticRegression(
            maxIter=1000, tol=TOLERANCE, regParam=penalty, elasticNetParam=0.0, standardization=False, **columns
        ),
        "random_forest": lambda: RandomForestClassifier(
            numTrees=rounds, maxDepth=forest_depth, seed=SEED, cacheNodeIds=True, checkpointInterval=10, **columns
        ),
        "gradient_boosting": lambda: GBTClassifier(
            maxIter=rounds, maxDepth=3, stepSize=0.1, seed=SEED, checkpointInterval=10, **columns
        ),
        "linear_svc": lambda: LinearSVC(maxIter=100, tol=TOLERANCE, regParam=penalty, standardization=False, **columns),
    }


def _assembled(features: Sequence[str], name: str) -> list:
    if name not in SCALED:
        return [VectorAssembler(inputCols=list(features), outputCol="features")]
    return [
        VectorAssembler(inputCols=list(features), outputCol="unscaled"),
        StandardScaler(inputCol="unscaled", outputCol="features", withMean=True, withStd=True),
    ]


def train(
    name: str,
    matrix: Matrix,
    rows: DataFrame,
    rounds: int = 100,
    weight: str | None = None,
    forest_depth: int = FOREST_DEPTH,
) -> PipelineModel:
    """One classifier fitted on ``rows``; scaling is part of the model and fitted on the same rows.

    ``weight`` names a column of row weights, such as class weights for
    unevenly frequent classes.
    """
    workspace(rows.sparkSession)  # tree training checkpoints its lineage there
    if name == "kernel_svc":
        return fit_kernel_machine(rows, matrix.features, matrix.label, 1.0 / max(rows.count(), 1), weight, seed=SEED)
    estimator = estimators(matrix.label, rows.count(), rounds, weight, forest_depth)[name]()
    return Pipeline(stages=[*_assembled(matrix.features, name), estimator]).fit(rows)


def at_once(rows: DataFrame, features: Sequence[str], most: int) -> int:
    """How many fits may run together: each keeps numbers of all rows, and reads them again and again."""
    return max(1, min(most, FITTED // max(rows.count() * len(features), 1)))


def train_all(
    matrix: Matrix, rows: DataFrame, rounds: int = 100, parallelism: int = 4, forest_depth: int = FOREST_DEPTH
) -> dict[str, PipelineModel]:
    """Every compared classifier fitted on the same rows, fewer at once where tables are large."""
    parallelism = at_once(rows, matrix.features, parallelism)
    jobs = {n: partial(train, n, matrix, rows, rounds, forest_depth=forest_depth) for n in COMPARED}
    return side_by_side(jobs, parallelism)


def score(model: PipelineModel, rows: DataFrame, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Label, 0/1 prediction and score of each row."""
    scored = model.transform(rows)
    source = "probability" if "probability" in scored.columns else "rawPrediction"
    return scored.select(
        *[col(c) for c in keys],
        col(label).cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array(F.col(source))[1].alias("score"),
    )


def evaluate(models: Mapping[str, PipelineModel], rows: DataFrame, label: str) -> DataFrame:
    """Metrics of every model on the same rows."""
    scored = None
    for name, model in models.items():
        part = score(model, rows, label).withColumn("model", F.lit(name))
        scored = part if scored is None else scored.unionByName(part)
    cells = metrics(confusion(scored, "label", "prediction", by=["model"]))
    areas = roc_auc(scored, "label", "score", by="model").select("model", "roc_auc")
    return cells.join(areas, "model").select(
        "model", "accuracy", "precision", "recall", "f1_score", "roc_auc", "tp", "fp", "fn", "tn"
    )


def cross_validate(
    name: str, matrix: Matrix, folded: DataFrame, folds: int = 5, rounds: int = 100, parallelism: int = 5
) -> DataFrame:
    """F1 per fold, each measured on rows the model was not trained on."""
    parallelism = at_once(folded, matrix.features, parallelism)
    jobs = {f: partial(train, name, matrix, folded.where(F.col("fold") != f), rounds) for f in range(folds)}
    parts = None
    for fold, model in side_by_side(jobs, parallelism).items():
        part = score(model, folded.where(F.col("fold") == fold), matrix.label).withColumn("fold", F.lit(fold))
        parts = part if parts is None else parts.unionByName(part)
    return metrics(confusion(parts, "label", "prediction", by=["fold"])).select(
        "fold", "accuracy", "precision", "recall", "f1_score"
    )


def cv_summary(scores: DataFrame) -> DataFrame:
    """Mean and population standard deviation of F1 over the folds."""
    return scores.agg(
        F.avg("f1_score").alias("cv_mean_f1"), F.stddev_pop("f1_score").alias("cv_std_f1"), F.count("*").alias("folds")
    )


def feature_importance(model: PipelineModel, features: Sequence[str], rows: DataFrame) -> DataFrame:
    """Importance per feature: of the splits of tree models, size of the weight of linear ones."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    elif not hasattr(last, "coefficients"):
        raise ValueError("this model has no weights of features; see permutation_importance")
    else:
        values = [abs(w) for w in last.coefficients.toArray()]
    table = [(name, float(v)) for name, v in zip(features, values)]
    return rows.sparkSession.createDataFrame(table, "feature string, importance double").orderBy(
        F.desc("importance"), F.asc("feature")
    )


def _permuted(matrix: Matrix, rows: DataFrame, repeat: int) -> DataFrame:
    """Every row's features ``x`` and, as ``other``, those of another row: the one at its place in a second hash order.

    Places come from range-partitioned orders, so no task holds the table.
    """
    x = F.array(*[col(c).cast("double") for c in matrix.features])
    held = materialized(rows.select(*[col(k) for k in matrix.keys], col(matrix.label).cast("int").alias("label"), x.alias("x")), "rows")
    name = [col(k) for k in matrix.keys] or [F.col("x")]
    one = F.lit(1).cast("long")

    def placed(salt: str) -> DataFrame:
        hashed = held.withColumns({"_hash": F.xxhash64(F.lit(f"{salt}{repeat}"), *name), "_tie": F.to_json(F.struct(*name))})
        return with_running_totals(hashed, ["_hash", "_tie"], {"place": one})

    own = placed("own").select("place", "label", "x")
    return own.join(placed("other").select("place", F.col("x").alias("other")), "place")


def _exchanged(model: PipelineModel, matrix: Matrix, dealt: DataFrame) -> DataFrame:
    """Confusion for ``j`` -1, on the rows as they are, and for each feature j, with that feature taken from the other row."""
    feature = F.explode(F.sequence(F.lit(-1), F.lit(len(matrix.features) - 1)))
    spread = dealt.select("label", "x", "other", feature.alias("j"))
    mixed = F.transform("x", lambda v, i: F.when(i == F.col("j"), F.get(F.col("other"), i)).otherwise(v))
    spread = spread.select("label", "j", mixed.alias("x"))
    columns = [F.col("x")[i].alias(name) for i, name in enumerate(matrix.features)]
    scored = model.transform(spread.select(F.col("label").alias(matrix.label), F.col("j"), *columns))
    return confusion(scored.select(col(matrix.label), "j", "prediction"), matrix.label, "prediction", by=["j"])


def permutation_importance(model: PipelineModel, matrix: Matrix, rows: DataFrame, repeats: int = 3) -> DataFrame:
    """How much F1 is lost when one feature's values are dealt to other rows; mean and spread over repeats.

    Works for any model. Each repeat deals whole rows once; all features are
    then scored in one pass, each in a copy of the row that has only that feature exchanged
    (without copies for the kernel machine).
    Rows need their keys, or distinct features, for the order to be unique.
    """
    parts = None
    for repeat in range(repeats):
        dealt = _permuted(matrix, rows, repeat)
        cells = exchanged_confusion(model, dealt, matrix.features)
        if cells is None:
            cells = _exchanged(model, matrix, dealt)
        part = metrics(cells).select("j", "f1_score").withColumn("repeat", F.lit(repeat))
        parts = part if parts is None else parts.unionByName(part)
    found = materialized(parts, "permuted-scores")
    # one score per repeat: a few rows
    whole = found.where("j = -1").select("repeat", F.col("f1_score").alias("whole"))
    lost = found.where("j >= 0").join(F.broadcast(whole), "repeat").withColumn("lost", F.col("whole") - F.col("f1_score"))
    name = F.element_at(F.array(*[F.lit(c) for c in matrix.features]), F.col("j") + 1)
    return (
        lost.groupBy(name.alias("feature"))
        .agg(F.avg("lost").alias("importance"), F.coalesce(F.stddev_pop("lost"), F.lit(0.0)).alias("spread"))
        .orderBy(F.desc("importance"), F.asc("feature"))
    )


def save_models(models: Mapping[str, PipelineModel], root: str) -> dict[str, str]:
    """Every model with its scaling, ready to be loaded elsewhere."""
    paths = {name: f"{root}/{name}" for name in models}
    for name, path in paths.items():
        models[name].write().overwrite().save(path)
    return paths


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def principal_components(matrix: Matrix, k: int) -> tuple[PipelineModel, DataFrame]:
    """The fitted projection to k components and the share of variance each explains."""
    stages = [
        VectorAssembler(inputCols=matrix.features, outputCol="unscaled"),
        StandardScaler(inputCol="unscaled", outputCol="scaled", withMean=True, withStd=True),
        PCA(k=k, inputCol="scaled", outputCol="components"),
    ]
    model = Pipeline(stages=stages).fit(matrix.frame)
    shares = [(i + 1, float(v)) for i, v in enumerate(model.stages[-1].explainedVariance.toArray())]
    return model, matrix.frame.sparkSession.createDataFrame(shares, "component int, explained_share double")


def tune_logistic(matrix: Matrix, folded: DataFrame, penalties: Sequence[float], folds: int = 5) -> DataFrame:
    """Mean area under the ROC curve over the folds for each penalty."""
    estimator = LogisticRegression(
        maxIter=1000, tol=TOLERANCE, labelCol=matrix.label, featuresCol="features", standardization=False
    )
    grid = ParamGridBuilder().addGrid(estimator.regParam, list(penalties)).build()
    # scaling is part of what is searched, so no fold is scaled by its own held-out rows
    whole = Pipeline(stages=[*_assembled(matrix.features, "logistic_regression"), estimator])
    search = CrossValidator(
        estimator=whole,
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(labelCol=matrix.label, metricName="areaUnderROC"),
        numFolds=folds,
        foldCol="fold",
        seed=SEED,
        parallelism=4,
    )
    means = search.fit(folded.select(*[col(c) for c in matrix.features], matrix.label, "fold")).avgMetrics
    rows = [(float(p), float(m)) for p, m in zip(penalties, means)]
    return folded.sparkSession.createDataFrame(rows, "penalty double, mean_auc double")


def model_report(results: DataFrame, importance: DataFrame) -> DataFrame:
    """Comparison, best model and importances as (section, item, metric, value)."""
    measures = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]
    cells = ", ".join(f"named_struct('metric', '{m}', 'value', {m})" for m in measures)
    comparison = compare_models(results).select(
        F.lit("comparison").alias("section"), F.col("model").alias("item"), F.expr(f"inline(array({cells}))")
    )
    best = best_model(results).select(
        F.lit("best_model").alias("section"),
        F.col("best_model").alias("item"),
        F.lit("f1_score").alias("metric"),
        F.col("best_f1").alias("value"),
    )
    ranked = importance.select(
        F.lit("importance").alias("section"),
        F.col("feature").alias("item"),
        F.lit("importance").alias("metric"),
        F.col("importance").alias("value"),
    )
    return comparison.unionByName(best).unionByName(ranked)
