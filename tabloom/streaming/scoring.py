"""Prepared rows and quality counts from streams.

What was learned on a batch is frozen; a stream only applies it. The
transformations are the batch functions themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from ..operators.features import add_features
from ..operators.models import score
from ..plans.prepare import KEY, Preparation, apply_preparation


def read_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    pattern: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """New Parquet files of a folder as a stream; ``files_per_batch`` limits what a batch holds at once."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stream_features(rows: DataFrame, learned: Preparation, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Features of arriving rows with the limits and categories learned before."""
    return add_features(apply_preparation(rows, learned, keys))


def stream_scores(
    rows: DataFrame, learned: Preparation, model: PipelineModel, label: str, keys: Sequence[str] = (KEY,)
) -> DataFrame:
    """Prediction and score of arriving rows."""
    return score(model, stream_features(rows, learned, keys), label, keys)


def without_repeats(rows: DataFrame, keys: Sequence[str], moment: str, delay: str) -> DataFrame:
    """Drops rows whose keys were seen less than ``delay`` ago; older keys are forgotten."""
    return rows.withWatermark(moment, delay).dropDuplicatesWithinWatermark(list(keys))


def window_quality(
    rows: DataFrame, moment: str, by: str, value: str, width: str = "1 hour", delay: str = "10 minutes"
) -> DataFrame:
    """Rows, missing and negative values per time window and group.

    Works on batches and streams. On a stream a window is final once the
    watermark has passed its end, and its state is dropped then.
    """
    timed = rows.withColumn(moment, col(moment).cast("timestamp"))
    if rows.isStreaming:
        timed = timed.withWatermark(moment, delay)
    return (
        timed.groupBy(F.window(moment, width), col(by))
        .agg(
            F.count("*").alias("row_count"),
            F.count_if(col(value).isNull()).alias("missing_count"),
            F.count_if(col(value) < 0).alias("negative_count"),
            F.sum(F.floor(col(value) * 100).cast("bigint")).alias("total_cents"),
        )
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            col(by),
            "row_count",
            "missing_count",
            "negative_count",
            "total_cents",
        )
    )


def write_available(rows: DataFrame, path: str) -> DataFrame:
    """Processes everything available now, exactly once, into a Parquet table.

    The sink's file log and the checkpoint beside it let a stopped run go on
    where it was.
    """
    query = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{path}/data")
        .option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/data")


def write_updates(rows: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Processes everything available now into a keyed table, open windows too.

    Each batch writes the groups it has changed into a folder of its own, which
    a repeated batch replaces; the table is the newest row of each key. Nothing
    waits for a watermark to pass, and a group that changes later gets a newer
    row.
    """

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/data/batch={batch}")

    query = (
        rows.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    schema = T.StructType([*rows.schema, T.StructField("batch", T.LongType())])
    written = rows.sparkSession.read.schema(schema).parquet(f"{path}/data")
    newest = written.groupBy(*[col(k) for k in keys]).agg(
        F.max_by(F.struct(*[col(c) for c in rows.columns]), "batch").alias("newest")
    )
    return newest.select("newest.*")
