"""Checks of one table: missing values, types, duplicates, ranges, categories.

Measures of single columns come from one aggregate over the table that is then
turned into a row per column. Value frequencies are one unpivot and one
grouping of hashes, combined before the shuffle. No check loops over columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (
    NUMBER_PATTERN,
    col,
    column_class,
    literal,
    nan_to_null,
    numeric_columns,
    quoted,
    string_columns,
)
from ..functions.joins import SMALL
from ..functions.quantiles import column_quantiles
from ..sources.workspace import materialized

TOP_VALUES = 5
IQR_FACTOR = 1.5
HIGH_CARDINALITY_SHARE = 0.5
LOW_CARDINALITY = 10
LONG_TEXT = 128  # bytes
START = 64  # characters of a text that go with its hash
AGGREGATE_FIELDS, FIELDS_PER_MEASURE = 100, 2.5


def per_column(
    df: DataFrame, columns: Sequence[str], measures: Mapping[str, tuple[str, str]], by: Sequence[str] = ()
) -> DataFrame:
    """Aggregates of columns as a row per column (and group).

    A measure maps its name to (aggregate, type); ``{c}`` in the aggregate
    stands for the column.
    """
    if not columns:
        fields = [f"{b} {df.schema[b].dataType.simpleString()}" for b in by] + ["column_name string"]
        return df.sparkSession.createDataFrame([], ", ".join(fields + [f"{m} {t}" for m, (_, t) in measures.items()]))
    out = None
    for group in _groups(columns, len(measures)):
        aggregates = [
            F.expr(f"CAST({template.format(c=quoted(c))} AS {kind}) AS m{i}_{name}")
            for i, c in enumerate(group)
            for name, (template, kind) in measures.items()
        ]
        wide = df.groupBy(*by).agg(*aggregates)
        rows = ", ".join(
            "named_struct('column_name', {}, {})".format(
                literal(c), ", ".join(f"'{name}', m{i}_{name}" for name in measures)
            )
            for i, c in enumerate(group)
        )
        part = wide.select(*by, F.expr(f"inline(array({rows}))"))
        out = part if out is None else out.unionByName(part)
    return out


def _groups(columns: Sequence[str], measures: int) -> list[Sequence[str]]:
    """Columns in groups whose aggregates fit one generated function.

    Past a hundred buffer fields Spark gives up whole-stage code. Each group
    scans its own columns only, so all groups together read the table once.
    """
    width = max(int(AGGREGATE_FIELDS / (FIELDS_PER_MEASURE * measures)), 1)
    return [columns[i : i + width] for i in range(0, len(columns), width)]


def shape(df: DataFrame, dataset: str) -> DataFrame:
    """Rows, number of columns and column list."""
    return df.agg(
        F.lit(dataset).alias("dataset"),
        F.count("*").alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(",".join(df.columns)).alias("columns"),
    )


def column_types(df: DataFrame) -> DataFrame:
    """Type and class of every column, known without reading data."""
    rows = [(f.name, f.dataType.simpleString(), column_class(f.dataType)) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string, column_class string")


def missing_values(df: DataFrame) -> DataFrame:
    """Missing values per column and their percentage of all rows."""
    return per_column(
        nan_to_null(df),
        df.columns,
        {
            "missing_count": ("count_if({c} IS NULL)", "bigint"),
            "missing_pct": ("try_divide(count_if({c} IS NULL) * 100D, count(*))", "double"),
        },
    )


def columns_with_missing(df: DataFrame) -> DataFrame:
    return missing_values(df).where("missing_count > 0")


def rows_with_missing(df: DataFrame) -> DataFrame:
    """Rows missing at least one value."""
    clean = nan_to_null(df)
    any_missing = " OR ".join(f"{quoted(c)} IS NULL" for c in df.columns)
    return clean.agg(
        F.count("*").alias("total_rows"),
        F.expr(f"count_if({any_missing}) AS rows_with_missing"),
        F.expr(f"try_divide(count_if({any_missing}) * 100D, count(*)) AS missing_rows_pct"),
    )


def value_kind(value: str) -> str:
    """SQL expression naming what a text value looks like."""
    return f"""CASE
        WHEN trim({value}) = '' THEN 'blank'
        WHEN {value} RLIKE {literal(r'^[+-]?[0-9]+$')} THEN 'integer'
        WHEN {value} RLIKE {literal(NUMBER_PATTERN)} THEN 'decimal'
        WHEN {value} RLIKE {literal(r'^[0-9]{4}-[0-9]{2}-[0-9]{2}$')} THEN 'date'
        WHEN lower({value}) IN ('true', 'false') THEN 'boolean'
        ELSE 'text' END"""


def _unpivoted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[col(c) for c in columns]).unpivot(
        [], [col(c) for c in columns], "column_name", "value"
    ).where(F.col("value").isNotNull())


def _no_rows(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def mixed_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Text columns whose values look like more than one type, with counts."""
    columns = string_columns(df) if columns is None else columns
    if not columns:
        return _no_rows(df, "column_name string, kind string, value_count bigint")
    kinds = (
        _unpivoted(df, columns)
        .groupBy("column_name", F.expr(value_kind("value")).alias("kind"))
        .agg(F.count("*").alias("value_count"))
    )
    # at most six kinds per column reach this step
    per_name = kinds.groupBy("column_name").agg(
        F.collect_list(F.struct("kind", "value_count")).alias("found")
    )
    return per_name.where(F.size("found") > 1).select("column_name", F.inline("found"))


def identity(df: DataFrame, name: str) -> Column:
    """A value to compare rows by: the column itself, or the SHA-256 of a long text.

    Keeps whole documents out of the shuffle where only equality matters.
    """
    if not isinstance(df.schema[name].dataType, T.StringType):
        return col(name)
    is_long = F.octet_length(col(name)) > LONG_TEXT
    return F.struct(is_long, F.when(is_long, F.sha2(col(name), 256)).otherwise(col(name)))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows; missing equals missing."""
    df = comparable(nan_to_null(df))
    return (
        df.groupBy(*[identity(df, c).alias(f"k{i}") for i, c in enumerate(df.columns)])
        .agg(F.count("*").alias("_copies"))
        .agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"),
            F.count("*").alias("distinct_rows"),
            F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
        )
        .withColumn("duplicate_pct", F.expr("try_divide(duplicate_rows * 100D, total_rows)"))
    )


def comparable(df: DataFrame) -> DataFrame:
    """Columns of types that have no order, such as maps, as JSON."""
    return df.withColumns({f.name: F.to_json(col(f.name)) for f in df.schema if _unordered(f.dataType)})


def _unordered(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _unordered(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(_unordered(f.dataType) for f in data_type)
    return isinstance(data_type, (T.MapType, T.VariantType))


def constant_columns(df: DataFrame) -> DataFrame:
    """Columns with exactly one distinct value, missing values ignored."""
    ends = {"low": ("min({c})", "string"), "high": ("max({c})", "string")}
    return (
        per_column(comparable(nan_to_null(df)), df.columns, ends)
        .where("low = high")
        .select("column_name", F.col("low").alias("constant_value"))
    )


def _literal_rows(df: DataFrame, values: Mapping[str, Sequence], names: Sequence[str]) -> DataFrame:
    """A few fitted numbers per column as a frame."""
    schema = "column_name string, " + ", ".join(f"{n} double" for n in names)
    return df.sparkSession.createDataFrame([(c, *row) for c, row in values.items()], schema)


def numeric_ranges(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """min, max, mean, sample standard deviation and median per numeric column."""
    columns = numeric_columns(df) if columns is None else list(columns)
    clean = nan_to_null(df.select(*[col(c) for c in columns]))
    moments = per_column(
        clean,
        columns,
        {
            "min_value": ("min({c})", "double"),
            "max_value": ("max({c})", "double"),
            "mean_value": ("avg({c})", "double"),
            "std_value": ("stddev_samp({c})", "double"),
        },
    )
    medians = _literal_rows(df, column_quantiles(clean, columns, [0.5]), ["median_value"])
    return moments.join(F.broadcast(medians), "column_name")


def _share_of_values(df: DataFrame, columns, test: str, name: str) -> DataFrame:
    columns = numeric_columns(df) if columns is None else list(columns)
    return per_column(
        nan_to_null(df.select(*[col(c) for c in columns])),
        columns,
        {
            f"{name}_count": (f"count_if({{c}} {test})", "bigint"),
            f"{name}_pct": (f"try_divide(count_if({{c}} {test}) * 100D, count({{c}}))", "double"),
        },
    )


def negative_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Negative values and their percentage of the values present."""
    return _share_of_values(df, columns, "< 0", "negative")


def zero_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Zeros and their percentage of the values present."""
    return _share_of_values(df, columns, "= 0", "zero")


def iqr_limits(q1: float | None, q3: float | None) -> tuple:
    """Values outside Q1 - 1.5 IQR .. Q3 + 1.5 IQR are outliers."""
    if q1 is None or q3 is None:
        return None, None
    reach = IQR_FACTOR * (q3 - q1)
    return q1 - reach, q3 + reach


def iqr_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
    """(Q1, Q3, lower bound, upper bound) per column."""
    quartiles = column_quantiles(df, columns, [0.25, 0.75])
    return {c: (q1, q3, *iqr_limits(q1, q3)) for c, (q1, q3) in quartiles.items()}


def iqr_outliers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Values strictly outside Q1 - 1.5 IQR .. Q3 + 1.5 IQR."""
    columns = numeric_columns(df) if columns is None else list(columns)
    clean = nan_to_null(df.select(*[col(c) for c in columns]))
    bounds = iqr_bounds(clean, columns)
    outside = clean.select(
        *[
            F.when(col(c).isNotNull(), (col(c) < F.lit(low)) | (col(c) > F.lit(high))).alias(c)
            for c, (_, _, low, high) in bounds.items()
        ]
    )
    counts = per_column(
        outside,
        columns,
        {
            "outlier_count": ("count_if({c})", "bigint"),
            "outlier_pct": ("try_divide(count_if({c}) * 100D, count({c}))", "double"),
        },
    )
    fitted = _literal_rows(df, bounds, ["q1", "q3", "lower_bound", "upper_bound"])
    return counts.join(F.broadcast(fitted), "column_name")


def value_hashes(df: DataFrame, columns: Sequence[str] | None = None, with_start: bool = False) -> DataFrame:
    """Frequency of every value of the text columns, by 128 bits of its hash and, if asked for, its first characters.

    Texts stay where they are read: what is combined and shuffled has a bounded
    width, so it is combined in a hash table, without a sort.
    """
    columns = string_columns(df) if columns is None else list(columns)
    start = [F.substring("value", 1, START).alias("start")] if with_start else []
    if not columns:
        text = " start string," if with_start else ""
        return _no_rows(df, f"column_name string, h1 bigint, h2 bigint,{text} value_count bigint")
    names = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("place"))
    return (
        _hashed(df, columns)
        .groupBy("place", "h1", "h2", *start)
        .agg(F.count("*").alias("value_count"))
        .select(names.alias("column_name"), "h1", "h2", *(["start"] if with_start else []), "value_count")
    )


def _hashed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Place of the column (from 1), two 64-bit halves of the MD5 of each value, and the value."""
    cells = F.array(*[F.struct(F.lit(i + 1).alias("place"), col(c).alias("value")) for i, c in enumerate(columns)])
    cells = df.select(F.inline(cells)).where("value IS NOT NULL")
    half = lambda start: F.conv(F.substring(F.md5("value"), start, 16), 16, -10).cast("bigint")
    return cells.select("place", half(1).alias("h1"), half(17).alias("h2"), "value")


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Frequency of every value of the text columns."""
    columns = string_columns(df) if columns is None else list(columns)
    if not columns:
        return _no_rows(df, "column_name string, value string, value_count bigint")
    return _unpivoted(df, columns).groupBy("column_name", "value").agg(F.count("*").alias("value_count"))


def categorical_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct values, most and least frequent value per column.

    Equal counts are ordered by value. Values are counted by hash; long texts are
    read again only for the few that tie in count and first characters.
    """
    columns = string_columns(df) if columns is None else list(columns)
    if not columns:
        return _no_rows(
            df,
            "column_name string, distinct_count bigint, most_frequent string, most_frequent_count bigint,"
            " least_frequent string, least_frequent_count bigint",
        )
    counts = materialized(value_hashes(df, columns, with_start=True), "value-hashes")
    order = F.struct(-F.col("value_count"), F.col("start"))
    ends = counts.groupBy("column_name").agg(
        F.count("*").alias("distinct_count"),
        F.max("value_count").alias("most_frequent_count"),
        F.min("value_count").alias("least_frequent_count"),
        F.min(order)["start"].alias("most_start"),
        F.max(order)["start"].alias("least_start"),
    )
    first = "value_count = most_frequent_count AND start = most_start"
    last = "value_count = least_frequent_count AND start = least_start"
    edge = counts.join(F.broadcast(ends), "column_name").where(f"({first}) OR ({last})").select(*counts.columns)
    found = _texts_of(df, columns, edge)
    texts = found.join(F.broadcast(ends), "column_name").groupBy("column_name").agg(
        F.min(F.when(F.expr(first), F.col("value"))).alias("most_frequent"),
        F.max(F.when(F.expr(last), F.col("value"))).alias("least_frequent"),
    )
    return ends.join(texts, "column_name").select(
        "column_name", "distinct_count", "most_frequent", "most_frequent_count", "least_frequent", "least_frequent_count"
    )


def _texts_of(df: DataFrame, columns: Sequence[str], chosen: DataFrame) -> DataFrame:
    """The text of each chosen hash: column_name, start, value, value_count.

    A text no longer than its start is known already. The others are few, as
    they tie in count and start; their hashes are broadcast if they are, and meet
    the rows in a join otherwise.
    """
    short = chosen.where(F.length("start") < START).withColumn("value", F.col("start"))
    place = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column_name")).cast("int")
    wanted = materialized(chosen.where(F.length("start") >= START).withColumn("place", place), "chosen-values")
    count = wanted.count()
    names = ["column_name", "start", "value", "value_count"]
    if not count:
        return short.select(*names)
    met = _hashed(df, columns).join(F.broadcast(wanted) if count <= SMALL else wanted, ["place", "h1", "h2"])
    return short.select(*names).unionByName(met.select(*names))


def top_values(df: DataFrame, columns: Sequence[str] | None = None, k: int = TOP_VALUES) -> DataFrame:
    """The k most frequent values per column; equal counts are ordered by value.

    Values are counted by hash, and each task keeps its best k; long texts are
    fetched only for those and what ties with the last of them.
    """
    columns = string_columns(df) if columns is None else list(columns)
    if not columns:
        return _no_rows(df, "column_name string, value string, value_count bigint, value_rank int")
    counts = materialized(value_hashes(df, columns, with_start=True), "value-hashes")
    ranked = Window.partitionBy("column_name").orderBy(F.desc("value_count"), F.asc("start"))
    best = counts.withColumn("nth", F.row_number().over(ranked)).where(F.col("nth") <= k)
    limits = best.groupBy("column_name").agg(F.max(F.struct(-F.col("value_count"), F.col("start"))).alias("limit"))
    inside = F.struct(-F.col("value_count"), F.col("start")) <= F.col("limit")
    chosen = counts.join(F.broadcast(limits), "column_name").where(inside).drop("limit")
    texts = _texts_of(df, columns, chosen).groupBy("column_name", "value").agg(F.max("value_count").alias("value_count"))
    order = Window.partitionBy("column_name").orderBy(F.desc("value_count"), F.asc("value"))
    return texts.withColumn("value_rank", F.row_number().over(order)).where(F.col("value_rank") <= k)


def cardinality_classes(df: DataFrame, row_count: int, columns: Sequence[str] | None = None) -> DataFrame:
    """high above half the rows, low below ten distinct values, else neither."""
    distinct = value_hashes(df, columns).groupBy("column_name").agg(F.count("*").alias("distinct_count"))
    return distinct.withColumn(
        "cardinality",
        F.when(F.col("distinct_count") > row_count * HIGH_CARDINALITY_SHARE, "high")
        .when(F.col("distinct_count") < LOW_CARDINALITY, "low")
        .otherwise("neither"),
    )
