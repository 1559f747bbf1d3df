"""Prepared tables kept as snapshots, with a log of what was written."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import first_existing
from .workspace import path_exists

LOG_SCHEMA = (
    "table_name string, created_at timestamp, row_count bigint, column_count int, columns string, data_location string"
)


def save_table(df: DataFrame, root: str, table_name: str, created_at: dt.datetime | None = None) -> DataFrame:
    """Writes a snapshot and logs it; returns the log row.

    The log row is appended after the data, so a reader that follows the log
    never meets a half-written table, and the previous snapshot stays readable
    until then. The row count comes from the Parquet footers.
    """
    spark = df.sparkSession
    moment = created_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    path = f"{root}/{table_name}/{moment:%Y%m%d_%H%M%S_%f}"
    df.write.mode("overwrite").parquet(path)
    entry = (table_name, moment, spark.read.parquet(path).count(), len(df.columns), ",".join(df.columns), path)
    log = spark.createDataFrame([entry], LOG_SCHEMA)
    log.coalesce(1).write.mode("append").parquet(f"{root}/_log")
    return log


def latest(log: DataFrame, keys: Sequence[str] = ("table_name",), moment: str = "created_at") -> DataFrame:
    """The newest log row per key."""
    rest = [c for c in log.columns if c not in keys]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(moment)).alias("newest"))
    return newest.select(*keys, *[F.col(f"newest.{c}").alias(c) for c in rest])


def load_latest(spark: SparkSession, root: str, table_name: str, fallbacks: Sequence[str] = ()) -> DataFrame:
    """The newest snapshot, else the first fallback path that exists."""
    if path_exists(spark, f"{root}/_log"):
        log = spark.read.schema(LOG_SCHEMA).parquet(f"{root}/_log").where(F.col("table_name") == table_name)
        for row in log.orderBy(F.desc("created_at")).limit(1).collect():
            return spark.read.parquet(row.data_location)
    path = first_existing(spark, fallbacks)
    if path is None:
        raise FileNotFoundError(f"no snapshot of {table_name} under {root}")
    return spark.read.parquet(path)
