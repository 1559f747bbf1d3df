"""Versions of a data set: fingerprint, record and history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from ..functions.expressions import hash_number
from ..sources.commits import CommitLog

FINGERPRINT_DIGITS = 15  # hex digits of each row's md5; the sum of 10^19 rows still fits
RECORD_SCHEMA = (
    "version_tag string, created_at timestamp, row_count bigint, feature_count int, "
    "columns string, fingerprint string, message string"
)


DIGITS = 6


def _part(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        value = col(field.name).cast("double")
        scaled = F.floor(value * F.lit(10.0**DIGITS) + 0.5)
        small = F.abs(value) < F.lit(9e18 / 10**DIGITS)  # larger ones, and NaN, count as written
        return F.when(small, scaled.cast("string")).otherwise(value.cast("string"))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.struct(col(field.name)))
    return col(field.name)


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Row count and a content hash that does not depend on row order or partitioning.

    Equal rows count as often as they occur, so copies change the result.
    Doubles count to ``DIGITS`` digits after the point, a form every engine can
    repeat; maps and other nested values count as JSON.
    """
    columns = [c for c in df.columns if c not in by] if columns is None else list(columns)
    row_hash = hash_number([_part(df.schema[c]) for c in columns], FINGERPRINT_DIGITS).cast("decimal(38,0)")
    return df.groupBy(*by).agg(
        F.count("*").alias("row_count"), F.coalesce(F.sum(row_hash), F.lit(0)).cast("string").alias("fingerprint")
    )


def _log(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, f"{root}/versions", RECORD_SCHEMA)


def record_version(
    df: DataFrame, root: str, label: str, created_at: dt.datetime | None = None
) -> DataFrame:
    """Appends a record of the data set to the version log and returns it.

    A tag names one version: recording the same tag at the same time, or again, is a conflict.
    """
    spark = df.sparkSession
    moment = created_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    seen = fingerprint(df).first()
    features = [c for c in df.columns if c != label]
    message = f"Data version - {seen.row_count} rows, {len(features)} features"
    entry = (
        f"v{moment:%Y%m%d_%H%M%S}",
        moment,
        seen.row_count,
        len(features),
        ",".join(features),
        seen.fingerprint,
        message,
    )
    row = spark.createDataFrame([entry], RECORD_SCHEMA)
    line = dict(zip(row.columns, entry)) | {"created_at": moment.isoformat(timespec="microseconds")}
    _log(spark, root).append([line], 0, ["version_tag"])
    return row


def load_versions(spark: SparkSession, root: str) -> DataFrame:
    return _log(spark, root).read()


def history(versions: DataFrame, moment: str = "created_at", by: Sequence[str] = ()) -> DataFrame:
    """Versions newest first, each with the change in rows and content since the one before.

    A version is one row here, whatever the size of the data; ``by`` keeps the
    histories of several data sets apart.
    """
    order = Window.partitionBy(*by).orderBy(moment)
    return versions.select(
        "*",
        (F.col("row_count") - F.lag("row_count").over(order)).alias("row_change"),
        F.coalesce(F.col("fingerprint") != F.lag("fingerprint").over(order), F.lit(True)).alias("content_changed"),
    ).orderBy(F.desc(moment))
