"""Distribution tables for a first look at the data."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, nan_to_null, numeric_columns, without_nan
from ..functions.quantiles import group_key, grouped_quantiles


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts per equal-width bin between the smallest and the largest value."""
    value = without_nan(col(column), df.schema[column].dataType).cast("double")
    values = df.select(value.alias("v")).where("v IS NOT NULL")
    low, high = values.agg(F.min("v"), F.max("v")).first()
    if low is None:
        return df.sparkSession.createDataFrame(
            [], "bin int, bin_start double, bin_end double, value_count bigint"
        )
    width = (high - low) / bins or 1.0
    number = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(number.alias("bin")).agg(F.count("*").alias("value_count"))
    start = F.lit(low) + F.col("bin") * F.lit(width)
    return counts.select("bin", start.alias("bin_start"), (start + F.lit(width)).alias("bin_end"), "value_count")


def boxplot_by_class(df: DataFrame, column: str, by: str) -> DataFrame:
    """Count, minimum, quartiles and maximum of a column per class.

    Classes may be many and one of them large: values are counted, ordered in
    ranges, and picked by their rank inside the class.
    """
    value = without_nan(col(column), df.schema[column].dataType).cast("double")
    boxes = grouped_quantiles(df, col(by), value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    ends = df.groupBy(col(by).alias("class")).agg(
        F.count(value).alias("value_count"), F.min(value).alias("min_value"), F.max(value).alias("max_value")
    )
    return ends.withColumn("key", group_key(F.col("class"))).join(boxes, "key", "left").drop("key")


def correlation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of all pairs of numeric columns, over the rows that have both values.

    Each task adds up products of whole columns with matrix products, once for
    its rows; what is shuffled is a few sums for each pair. Values are counted
    from the minimum of their column, so constant columns are recognised and
    large values lose no digits.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    clean = nan_to_null(df.select(*[col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]))
    if not columns:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, correlation double")
    lows = clean.agg(*[F.coalesce(F.min(c), F.lit(0.0)) for c in clean.columns]).first()
    lows = [low if math.isfinite(low) else 0.0 for low in lows]
    sums = clean.mapInArrow(partial(_pair_sums, lows), "a int, b int, n double, x double, y double, xx double, yy double, xy double")
    total = sums.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    spread = lambda s, ss: F.col(ss) - F.col(s) * F.col(s) / F.col("n")
    shared = F.col("xy") - F.col("x") * F.col("y") / F.col("n")
    room = F.sqrt(spread("x", "xx")) * F.sqrt(spread("y", "yy"))
    value = F.when((F.col("n") > 0) & (spread("x", "xx") > 0) & (spread("y", "yy") > 0), shared / room)
    names = F.array(*[F.lit(c) for c in columns])
    return total.select(
        F.get(names, F.col("a")).alias("column_a"), F.get(names, F.col("b")).alias("column_b"), value.alias("correlation")
    )


def _pair_sums(lows, batches):
    """For each pair of columns: rows with both, sums, sums of squares and of products."""
    size = len(lows)
    totals = np.zeros((6, size, size))
    for batch in batches:
        table = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        x = np.array(table, dtype=float).reshape(size, batch.num_rows) - np.array(lows)[:, None]
        there = ~np.isnan(x)
        x, there = np.where(there, x, 0.0), there.astype(float)
        first = x @ there.T
        squares = (x * x) @ there.T
        totals += np.stack([there @ there.T, first, first.T, squares, squares.T, x @ x.T])
    a, b = np.indices((size, size)).reshape(2, -1)
    columns = [pa.array(a, pa.int32()), pa.array(b, pa.int32()), *[pa.array(t.ravel()) for t in totals]]
    yield pa.RecordBatch.from_arrays(columns, ["a", "b", "n", "x", "y", "xx", "yy", "xy"])
