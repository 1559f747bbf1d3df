"""Validation of one or several tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession

from ..functions.jobs import side_by_side
from ..operators.reporting import combined_summary, find_issues, validate
from ..sources.workspace import tables_in


def measure(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The checks of every table in one report: a few rows per column."""
    parts = side_by_side({name: partial(validate, df, name) for name, df in tables.items()})
    return reduce(DataFrame.unionByName, parts.values())


def validate_tables(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Report, issues and totals."""
    measures = measure(tables)
    issues = find_issues(measures)
    return {"measures": measures, "issues": issues, "combined": combined_summary(measures, issues)}


def validate_folder(spark: SparkSession, folder: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The Parquet tables of a folder, each validated: the named ones, or whatever it holds."""
    names = tables_in(spark, folder) if names is None else names
    return validate_tables({name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names})
