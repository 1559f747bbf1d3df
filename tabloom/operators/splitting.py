"""Training and test rows, folds, and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col
from ..functions.expressions import hash_number
from ..functions.joins import attach_any
from ..functions.quantiles import group_key, grouped_ranks
from ..sources.workspace import materialized

HASH_DIGITS = 13
HASH_RANGE = 16**HASH_DIGITS
TEST_SHARE = 0.2
FOLDS = 5


def row_number_hash(key: Sequence[str], seed: int = 42) -> Column:
    """A number in [0, HASH_RANGE) that depends on the key and the seed only."""
    return hash_number([F.lit(str(seed)), *[col(k) for k in key]], HASH_DIGITS)


def hashed_split(df: DataFrame, key: Sequence[str], test_share: float = TEST_SHARE, seed: int = 42) -> DataFrame:
    """Marks about ``test_share`` of the rows as test rows, without looking at the data."""
    is_test = row_number_hash(key, seed) < F.lit(int(test_share * HASH_RANGE))
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def stratified_split(
    df: DataFrame, key: Sequence[str], label: str, test_share: float = TEST_SHARE, seed: int = 42
) -> DataFrame:
    """Marks ``test_share`` of each class (rounded to whole rows) as test rows.

    The test rows of a class are those with the smallest hashes. Their number
    follows from the class size, so what is needed is the hash at that rank, for
    every class at once; it then meets the rows, without a shuffle for large
    classes or for few. Rows whose hashes are equal at the limit go to the same
    side.
    """
    hashed = row_number_hash(key, seed)
    wanted = F.floor(F.col("n") * F.lit(float(test_share)) + 0.5).cast("bigint")
    limits = grouped_ranks(df, col(label), hashed, {"_limit": wanted - 1})
    limits = materialized(limits.select(F.col("key").alias("_class"), "n", "_limit"), "split-limits")
    marked = attach_any(df.withColumn("_class", group_key(col(label))), limits, "_class", "n")
    split = F.when(hashed <= F.col("_limit"), "test").otherwise("train").alias("split")
    return marked.select(*[col(c) for c in df.columns], split)


def assign_folds(df: DataFrame, key: Sequence[str], folds: int = FOLDS, seed: int = 42) -> DataFrame:
    """A fold number per row, the same in every run."""
    return df.withColumn("fold", F.pmod(row_number_hash(key, seed), F.lit(folds)).cast("int"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Weight per class that makes all classes count the same in training."""
    sizes = df.groupBy(col(label).alias("label")).agg(F.count("*").alias("label_count"))
    total, classes = sizes.agg(F.sum("label_count"), F.count("*")).first()
    return sizes.withColumn("class_weight", F.lit(float(total or 0)) / (F.lit(classes) * F.col("label_count")))


def with_class_weight(df: DataFrame, label: str) -> DataFrame:
    """The weight of its class on each row."""
    weights = class_weights(df, label).select(group_key(F.col("label")).alias("_class"), "label_count", "class_weight")
    marked = attach_any(
        df.withColumn("_class", group_key(col(label))), materialized(weights, "class-weights"), "_class", "label_count"
    )
    return marked.select(*[col(c) for c in df.columns], "class_weight")


def oversample(df: DataFrame, label: str, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Rows repeated until every class is as large as the largest (random oversampling).

    Every row comes whole numbers of times; the rows that come once more are
    those whose hash of key and seed is in the remaining share, so the sizes are
    equal up to chance and the result is the same in every run.
    """
    sizes = df.groupBy(group_key(col(label)).alias("_class")).agg(F.count("*").alias("_n"))
    sizes = materialized(sizes, "class-sizes")
    largest = sizes.agg(F.max("_n")).first()[0] or 0
    marked = attach_any(df.withColumn("_class", group_key(col(label))), sizes, "_class", "_n")
    times = F.lit(float(largest)) / F.col("_n")
    extra = row_number_hash(key, seed) < F.floor((times - F.floor(times)) * F.lit(float(HASH_RANGE)))
    copies = (F.floor(times) + extra.cast("bigint")).cast("int")
    repeated = marked.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return repeated.select(*[col(c) for c in df.columns])
