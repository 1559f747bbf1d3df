"""Change between two versions of a table, and quality shares."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col, literal, nan_to_null, quoted, without_nan
from ..functions.quantiles import column_quantiles

SMALLEST_SHARE = 1e-4


def population_stability(base: DataFrame, other: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Share of rows per bin in both tables and each bin's part of the stability index.

    Bins are cut at the quantiles of the base table. An empty bin counts as a
    small share so that the logarithm exists.
    """
    cuts = set(column_quantiles(base, [column], [i / bins for i in range(1, bins)])[column]) - {None}
    number = F.lit(0)
    for cut in sorted(cuts):
        number = number + (F.col("v") > F.lit(cut)).cast("int")

    def side(df, name):
        value = without_nan(col(column), df.schema[column].dataType).cast("double")
        return df.select(value.alias("v"), F.lit(name).alias("side")).where("v IS NOT NULL")

    counts = (
        side(base, "base")
        .unionByName(side(other, "other"))
        .groupBy(number.alias("bin"))
        .agg(
            F.count_if(F.col("side") == "base").alias("base_count"),
            F.count_if(F.col("side") == "other").alias("other_count"),
        )
    )
    every_bin = Window.partitionBy(F.lit(0))  # at most ``bins`` rows

    def share(name):
        part = F.try_divide(F.col(name).cast("double"), F.sum(name).over(every_bin))
        return F.greatest(part, F.lit(SMALLEST_SHARE))

    shares = counts.withColumns({"base_share": share("base_count"), "other_share": share("other_count")})
    step = (F.col("other_share") - F.col("base_share")) * F.ln(F.col("other_share") / F.col("base_share"))
    return shares.withColumn("psi", step)


def quality_shares(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Percentage of rows passing each rule, and of rows passing all ('all_rules').

    A rule is a SQL condition; a row it cannot decide fails it. 'coverage' is
    the percentage of values that are present.
    """
    clean = nan_to_null(df)
    passes = {name: f"coalesce(({rule}), false)" for name, rule in rules.items()}
    passes["all_rules"] = " AND ".join(passes.values()) or "true"
    present = " + ".join(f"CAST({quoted(c)} IS NOT NULL AS int)" for c in df.columns)
    wide = clean.agg(
        F.count("*").alias("n"),
        *[F.expr(f"count_if({test}) AS r{i}") for i, test in enumerate(passes.values())],
        F.expr(f"sum({present}) AS present"),
    )
    lines = [f"named_struct('rule', {literal(n)}, 'passed', r{i}, 'total', n)" for i, n in enumerate(passes)]
    lines.append(f"named_struct('rule', 'coverage', 'passed', present, 'total', n * {len(df.columns)})")
    return wide.select(F.expr(f"inline(array({', '.join(lines)}))")).withColumn(
        "passed_pct", F.expr("try_divide(passed * 100D, total)")
    )
