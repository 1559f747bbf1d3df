"""Column names, column classes and missing values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that counts as a number. Spark's own cast
# also takes Java suffixes ("1.5d"), which are text in a data file.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def quoted(name: str) -> str:
    """The column name as it has to stand in a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """The text as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def col(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col(quoted(name))


def column_class(data_type: T.DataType) -> str:
    """numeric, categorical, datetime or other; booleans belong to other."""
    if isinstance(data_type, T.NumericType):
        return "numeric"
    if isinstance(data_type, T.StringType):
        return "categorical"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    return "other"


def columns_of(df: DataFrame, kind: str, exclude: Iterable[str] = ()) -> list[str]:
    """Names of the columns of one class, in table order."""
    skipped = set(exclude)
    return [f.name for f in df.schema if f.name not in skipped and column_class(f.dataType) == kind]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return columns_of(df, "numeric", exclude)


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return columns_of(df, "categorical", exclude)


def without_nan(value: Column, data_type: T.DataType) -> Column:
    """NaN and null are one notion of missing; Spark would sort NaN above all numbers."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value), value)
    return value


def nan_to_null(df: DataFrame) -> DataFrame:
    """The frame with NaN turned into null in every floating point column."""
    floats = {
        f.name: without_nan(col(f.name), f.dataType)
        for f in df.schema
        if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    }
    return df.withColumns(floats) if floats else df


def names_like(names: Iterable[str], parts: Iterable[str]) -> list[str]:
    """Names holding any of the parts, ignoring case."""
    wanted = [part.lower() for part in parts]
    return [name for name in names if any(part in name.lower() for part in wanted)]
