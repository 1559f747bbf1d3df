"""How well predictions match labels.

Input is any frame with a 0/1 label, a 0/1 prediction and a score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col
from ..functions.ordering import with_running_totals


def confusion(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """True and false positives and negatives."""

    def cell(actual, predicted):
        return F.count_if((col(label) == actual) & (col(prediction) == predicted))

    return df.groupBy(*by).agg(
        cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn")
    )


def metrics(cells: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1; a measure without cases is 0."""

    def share(part, whole):
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.withColumns(
        {
            "accuracy": share(tp + tn, tp + fp + fn + tn),
            "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn),
            "f1_score": share(2 * tp, 2 * tp + fp + fn),
        }
    )


def roc_auc(df: DataFrame, label: str, score: str, by: str | None = None) -> DataFrame:
    """Area under the ROC curve: how often a positive scores above a negative, ties half.

    Rows are counted per distinct score first; the running number of negatives
    below each score is then taken over ranges of scores. ``by`` evaluates
    several score sets, such as models, in the same run.
    """
    group = col(by).cast("string") if by else F.lit("")
    counts = df.groupBy(group.alias("_by"), col(score).cast("double").alias("_score")).agg(
        F.count_if(col(label) == 1).alias("positives"), F.count_if(col(label) == 0).alias("negatives")
    )
    ranked = with_running_totals(counts, ["_by", "_score"], {"below": F.col("negatives")})
    # "below" runs over all groups; what it was at the start of a group is taken off again
    sums = ranked.groupBy("_by").agg(
        F.sum(F.col("positives") * (F.col("below") + F.col("negatives") / F.lit(2.0))).alias("wins"),
        F.sum("positives").alias("p"),
        F.sum("negatives").alias("n"),
        F.min("below").alias("start"),
    )
    area = F.try_divide(F.col("wins") - F.col("p") * F.col("start"), (F.col("p") * F.col("n")).cast("double"))
    out = sums.select(
        F.col("_by").alias(by or "_by"),
        F.col("p").alias("positive_count"),
        F.col("n").alias("negative_count"),
        area.alias("roc_auc"),
    )
    return out if by else out.drop("_by")


def compare_models(scored: DataFrame) -> DataFrame:
    """Metrics per model, best F1 first; equal F1 is ordered by name."""
    return scored.orderBy(F.desc("f1_score"), F.asc("model"))


def best_model(scored: DataFrame) -> DataFrame:
    """The model with the highest F1; of equals, the first name."""
    first = compare_models(scored).limit(1)
    return first.select(F.col("model").alias("best_model"), F.col("f1_score").alias("best_f1"))
