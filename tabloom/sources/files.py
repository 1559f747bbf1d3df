"""CSV and Parquet in and out."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.columns import nan_to_null
from .workspace import path_exists


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV files with a header; empty and NaN fields are missing.

    With a declared schema the scan is a single pass. Without one Spark reads
    the files once more to find the types.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV files with a header; blanks are data and are kept."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str | None:
    """The first of the paths that is there."""
    return next((path for path in paths if path_exists(spark, path)), None)


def ingest(
    spark: SparkSession, landed: Mapping[str, str], acquire: Mapping[str, Callable[[], DataFrame]]
) -> dict[str, DataFrame]:
    """Reads the landed table of every source.

    If any source is not landed yet, all of them are acquired and landed again,
    so that the set belongs together.
    """
    if not all(path_exists(spark, path) for path in landed.values()):
        for source, path in landed.items():
            acquire[source]().write.mode("overwrite").parquet(path)
    return {source: spark.read.parquet(path) for source, path in landed.items()}
