"""Numeric columns on a common scale, and selection by a class-separation score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, nan_to_null, numeric_columns, quoted
from ..functions.quantiles import column_quantiles
from .profiling import per_column

METHODS = ("standard", "minmax", "robust")


def fit_scaling(df: DataFrame, columns: Sequence[str], method: str = "standard") -> dict[str, tuple]:
    """(centre, spread) per column; a spread of 0 is taken as 1.

    standard: mean and population standard deviation; minmax: minimum and
    range; robust: median and interquartile range.
    """
    if method not in METHODS:
        raise ValueError(f"unknown scaling method: {method}")
    columns = list(columns)
    if not columns:
        return {}
    clean = nan_to_null(df.select(*[col(c) for c in columns]))
    if method == "robust":
        fitted = {c: (m, None if m is None else q3 - q1) for c, (q1, m, q3) in
                  column_quantiles(clean, columns, [0.25, 0.5, 0.75]).items()}
    else:
        centre, spread = {
            "standard": ("avg({c})", "stddev_pop({c})"),
            "minmax": ("CAST(min({c}) AS double)", "CAST(max({c}) AS double) - CAST(min({c}) AS double)"),
        }[method]
        row = clean.agg(
            *[F.expr(f"{centre.format(c=quoted(c))} AS a{i}") for i, c in enumerate(columns)],
            *[F.expr(f"{spread.format(c=quoted(c))} AS b{i}") for i, c in enumerate(columns)],
        ).first()
        fitted = {c: (row[f"a{i}"], row[f"b{i}"]) for i, c in enumerate(columns)}
    return {c: (a, b if b else 1.0) for c, (a, b) in fitted.items()}


def scale(df: DataFrame, scaling: Mapping[str, tuple]) -> DataFrame:
    """(value - centre) / spread for the fitted columns."""
    new = {
        c: (col(c).cast("double") - F.lit(a)) / F.lit(float(b)) for c, (a, b) in scaling.items() if a is not None
    }
    return df.withColumns(new) if new else df


def anova_scores(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One-way ANOVA F of every numeric column against the classes of the target.

    Counts, means and variances per class come from one grouping; the score is
    computed from those few rows. A column that separates the classes fully
    scores infinity, a constant column has no score.
    """
    columns = numeric_columns(df, [target]) if columns is None else list(columns)
    by_class = per_column(
        df.select(*[col(c) for c in columns], col(target).alias("_class")),
        columns,
        {
            "n": ("count({c})", "double"),
            "mean": ("avg({c})", "double"),
            "var": ("var_pop({c})", "double"),
        },
        by=["_class"],
    ).where("n > 0")
    overall = by_class.groupBy("column_name").agg(
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("overall"),
    )
    # one row per column on the small side
    apart = F.col("n") * F.pow(F.col("mean") - F.col("overall"), 2)
    pooled = (
        by_class.join(F.broadcast(overall), "column_name")
        .groupBy("column_name")
        .agg(
            F.sum("n").alias("n"),
            F.count("*").alias("g"),
            F.sum(apart).alias("between"),
            F.sum(F.col("n") * F.col("var")).alias("within"),
        )
    )
    explained = F.col("between") / F.expr("nullif(g - 1, 0)")
    unexplained = F.col("within") / F.expr("nullif(n - g, 0)")
    score = F.when((unexplained == 0) & (explained > 0), F.lit(float("inf"))).otherwise(
        F.try_divide(explained, unexplained)
    )
    return pooled.select("column_name", score.alias("f_score"))


def best_columns(scores: Mapping[str, float | None], k: int) -> list[str]:
    """The k best columns in the given order.

    Of equal scores the later column wins; columns without a score come last.
    Scores are compared to nine digits, since equal columns may be summed in a
    different order.
    """
    names = list(scores)

    def rank(i):
        value = scores[names[i]]
        return (float("-inf") if value is None else float(f"{value:.9g}"), i)

    kept = set(sorted(range(len(names)), key=rank, reverse=True)[:k])
    return [name for i, name in enumerate(names) if i in kept]


def select_k_best(df: DataFrame, target: str, k: int = 20, keys: Sequence[str] = ()) -> DataFrame:
    """The k numeric columns with the highest score, in table order, and the target last.

    Key columns are kept in front. Without a target the frame is unchanged.
    """
    if target not in df.columns:
        return df
    candidates = numeric_columns(df, [target, *keys])
    found = {row.column_name: row.f_score for row in anova_scores(df, target, candidates).collect()}
    chosen = best_columns({c: found.get(c) for c in candidates}, k)
    return df.select(*[col(c) for c in [*keys, *chosen, target]])
