"""Validation of a table that grows by days: each day is read once, ever.

A day leaves partial states behind: per column its counts, moments, extremes, a
quantile sketch and a sketch of distinct values; how often each text value and
each whole row occurs, by 128 bits of its hash. States of any days merge by
grouping, so the report of all days never reads an old day again. It equals
:func:`.reporting.validate` of all rows, but for what is read off the merged
quantile sketches: median, outlier bounds and counts, whose ranks are off by a
share of ``RANK_ERROR`` at most (with 99 % confidence).

The hashes grow with the number of different values and rows (16 bytes and a
count each). Where that is too much, ``exact=False`` leaves them out: distinct
values then come from the sketches, duplicate rows are not reported.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col, nan_to_null, numeric_columns, quoted, string_columns
from ..sources.commits import CommitLog
from ..sources.workspace import delete_path
from . import profiling

#: Size of the quantile sketches; the rank error follows from it.
SKETCH = 2048
RANK_ERROR = 0.0025
#: Points of the merged sketches that are looked at.
GRID = 2000
DISTINCT_BITS = 14
LOG_SCHEMA = "number bigint, day string, folder string, column_count int, exact boolean"

_NUMBER = {
    "n": ("count({c})", "bigint"),
    "mean": ("avg({c})", "double"),
    "m2": ("var_pop({c}) * count({c})", "double"),
    "min_value": ("min({c})", "double"),
    "max_value": ("max({c})", "double"),
    "negative_count": ("count_if({c} < 0)", "bigint"),
    "zero_count": ("count_if({c} = 0)", "bigint"),
    "quantiles": (f"kll_sketch_agg_double(CAST({{c}} AS double), {SKETCH})", "binary"),
}


def _end(which: str) -> str:
    """The least or greatest value as a text of bounded length; equal for equal values."""
    text = f"CAST({which}({{c}}) AS string)"
    return f"CASE WHEN octet_length({text}) > {profiling.LONG_TEXT} THEN sha2({text}, 256) ELSE {text} END"


_ANY = {
    "missing_count": ("count_if({c} IS NULL)", "bigint"),
    "low": (_end("min"), "string"),
    "high": (_end("max"), "string"),
}


def column_states(df: DataFrame) -> DataFrame:
    """One row per column, and one with an empty name for whole rows."""
    plain = nan_to_null(df)
    clean = profiling.comparable(plain)
    numbers, texts = numeric_columns(df), string_columns(df)
    others = [c for c in df.columns if c not in numbers and c not in texts]
    empty = {name: (f"CAST(NULL AS {kind})", kind) for name, (_, kind) in _NUMBER.items()}
    distinct = {"distinct_values": (f"hll_sketch_agg({{c}}, {DISTINCT_BITS})", "binary")}
    none = {"distinct_values": ("CAST(NULL AS binary)", "binary")}
    parts = [
        profiling.per_column(clean, numbers, _ANY | _NUMBER | none).withColumn("kind", F.lit("number")),
        profiling.per_column(clean, texts, _ANY | empty | distinct).withColumn("kind", F.lit("text")),
        profiling.per_column(clean, others, _ANY | empty | none).withColumn("kind", F.lit("other")),
    ]
    any_missing = " OR ".join(f"{quoted(c)} IS NULL" for c in df.columns) or "false"
    whole = plain.agg(F.count("*").alias("n"), F.expr(f"count_if({any_missing})").alias("missing_count"))
    out = whole.select(F.lit("").alias("column_name"), F.lit("table").alias("kind"), "n", "missing_count")
    for part in parts:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def row_hashes(df: DataFrame) -> DataFrame:
    """How often each whole row occurs, by two halves of the MD5 of its values."""
    clean = profiling.comparable(nan_to_null(df))
    parts = []
    for c in clean.columns:
        text = col(c).cast("string")
        if dict(clean.dtypes)[c] in ("double", "float"):
            text = (col(c) + 0.0).cast("string")  # minus zero equals zero
        parts += [F.coalesce(F.length(text).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit(""))]
    digest = F.md5(F.concat(*parts).cast("binary")) if parts else F.lit("0" * 32)
    half = lambda start: F.conv(F.substring(F.col("digest"), start, 16), 16, -10).cast("bigint")
    hashed = clean.select(digest.alias("digest")).select(half(1).alias("h1"), half(17).alias("h2"))
    return hashed.groupBy("h1", "h2").agg(F.count("*").alias("copies"))


def _log(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, f"{root}/_commits", LOG_SCHEMA)


def add_day(df: DataFrame, root: str, day: str, exact: bool = True) -> int:
    """Measures the rows of a day and commits its states; a day again replaces the earlier one."""
    spark = df.sparkSession
    log = _log(spark, root)
    base, folder = log.newest(), f"{root}/states-{uuid.uuid4().hex}"
    column_states(df).coalesce(1).write.parquet(f"{folder}/columns")
    if exact:
        profiling.value_hashes(nan_to_null(df)).write.parquet(f"{folder}/values")
        row_hashes(df).write.parquet(f"{folder}/rows")
    return log.append([{"day": str(day), "folder": folder, "column_count": len(df.columns), "exact": exact}], base, ["day"])


def days(spark: SparkSession, root: str) -> DataFrame:
    """The newest commit of every day."""
    found = _log(spark, root).read()
    rest = [c for c in found.columns if c != "day"]
    return found.groupBy("day").agg(F.max_by(F.struct(*rest), "number").alias("last")).select("day", "last.*")


def drop_replaced(spark: SparkSession, root: str) -> int:
    """Removes states of days that were measured again; returns how many."""
    old = _log(spark, root).read().select("folder").join(days(spark, root).select("folder"), "folder", "left_anti")
    return sum(delete_path(spark, r.folder) for r in old.collect())


def merged_columns(states: DataFrame) -> DataFrame:
    """States of several days as one row per column, with what can be read off them."""
    means = states.groupBy("column_name").agg(F.try_divide(F.sum(F.col("mean") * F.col("n")), F.sum("n")).alias("mean_value"))
    # spread within days, and of the days' means around the whole: no difference of large sums
    spread = states.join(F.broadcast(means), "column_name").groupBy("column_name").agg(
        F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("mean_value"), 2)).alias("m2")
    )  # a row per column
    sums = ["n", "missing_count", "negative_count", "zero_count"]
    same = (F.min("low") == F.max("low")) & (F.min("high") == F.max("high")) & (F.min("low") == F.max("high"))
    merged = states.groupBy("column_name", "kind").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.coalesce(same, F.lit(False)).alias("is_constant"),
        F.expr("kll_merge_agg_double(quantiles)").alias("quantiles"),
        F.hll_union_agg("distinct_values").alias("distinct_values"),
    )
    points = ", ".join(f"{i / GRID!r}D" for i in range(GRID + 1))
    q = F.when(F.col("n") > 0, F.expr(f"kll_sketch_get_quantile_double(quantiles, array({points}))"))
    joined = merged.join(F.broadcast(means), "column_name").join(F.broadcast(spread), "column_name")
    first, third = F.col("q")[GRID // 4], F.col("q")[3 * GRID // 4]
    measured = joined.withColumn("q", F.when(F.col("kind") == "number", q)).withColumns(
        {
            "std_value": F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))),
            "median_value": F.col("q")[GRID // 2],
            "lower_bound": first - profiling.IQR_FACTOR * (third - first),
            "upper_bound": third + profiling.IQR_FACTOR * (third - first),
            "approx_distinct": F.hll_sketch_estimate("distinct_values"),
        }
    )
    beyond = F.filter("q", lambda v: (v < F.col("lower_bound")) | (v > F.col("upper_bound")))
    outside = F.when(F.col("lower_bound").isNotNull(), F.round(F.size(beyond) * F.col("n") / F.lit(GRID + 1)))
    return measured.withColumn("outlier_count", outside).drop("q", "quantiles", "distinct_values", "m2")


def merged(spark: SparkSession, root: str, dataset: str, of: list[str] | None = None) -> DataFrame:
    """The report of all days, or of some, in the form of :func:`.reporting.validate`."""
    chosen = days(spark, root)
    if of is not None:
        chosen = chosen.where(F.col("day").isin([str(d) for d in of]))
    commits = chosen.collect()  # a row per day
    if not commits:
        raise FileNotFoundError(f"no day has been measured under {root}")
    read = lambda name: spark.read.parquet(*[f"{c.folder}/{name}" for c in commits])
    columns = merged_columns(read("columns"))
    whole = columns.where("kind = 'table'").select(F.col("n").alias("row_count"), F.col("missing_count").alias("rows_with_missing"))
    percent = lambda part, all_: F.try_divide(F.col(part) * 100.0, F.col(all_))
    width = max(c.column_count for c in commits)

    def melted(rows: DataFrame, check: str, metrics: dict[str, Column], column: Column | None = None) -> DataFrame:
        cells = [F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in metrics.items()]
        name = F.lit("") if column is None else column
        return rows.select(F.lit(dataset).alias("dataset"), F.lit(check).alias("check"), name.alias("column_name"), F.inline(F.array(*cells)))

    name, table = F.col("column_name"), F.broadcast(whole)  # one row
    each = columns.where("kind <> 'table'").crossJoin(table)
    numbers = each.where("kind = 'number'")
    same = {m: F.col(m) for m in ("min_value", "max_value", "mean_value", "std_value", "median_value")}
    out = [
        melted(whole, "shape", {"row_count": F.col("row_count"), "column_count": F.lit(width)}),
        melted(whole, "missing", {"rows_with_missing": F.col("rows_with_missing"), "missing_rows_pct": percent("rows_with_missing", "row_count")}),
        melted(each, "missing", {"missing_count": F.col("missing_count"), "missing_pct": percent("missing_count", "row_count")}, name),
        melted(each.where("is_constant"), "duplicates", {"constant": F.lit(1)}, name),
        melted(numbers, "ranges", same, name),
        *[melted(numbers, "ranges", {f"{k}_count": F.col(f"{k}_count"), f"{k}_pct": percent(f"{k}_count", "n")}, name) for k in ("negative", "zero")],
        melted(
            numbers, "outliers",
            {"outlier_count": F.coalesce("outlier_count", F.lit(0)), "outlier_pct": percent("outlier_count", "n"),
             "lower_bound": F.col("lower_bound"), "upper_bound": F.col("upper_bound")}, name,
        ),
    ]
    if all(c.exact for c in commits):
        counts = read("values").groupBy("column_name", "h1", "h2").agg(F.sum("value_count").alias("value_count"))
        seen = counts.groupBy("column_name").agg(
            F.count("*").alias("distinct_count"), F.max("value_count").alias("most_frequent_count"), F.min("value_count").alias("least_frequent_count")
        )
        rows = read("rows").groupBy("h1", "h2").agg(F.sum("copies").alias("copies")).agg(
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"), F.count("*").alias("distinct_rows"),
            F.sum("copies").alias("total_rows"),
        )
        out.append(
            melted(rows, "duplicates", {"duplicate_rows": F.col("duplicate_rows"), "distinct_rows": F.col("distinct_rows"),
                                        "duplicate_pct": percent("duplicate_rows", "total_rows")})
        )
        ends = {m: F.col(m) for m in ("distinct_count", "most_frequent_count", "least_frequent_count")}
    else:
        seen = columns.where("kind = 'text'").select("column_name", F.col("approx_distinct").alias("distinct_count"))
        seen = seen.where("distinct_count > 0")
        ends = {"distinct_count": F.col("distinct_count")}
    out.append(melted(seen, "categories", ends, name))
    high = seen.crossJoin(table).where(F.col("distinct_count") > F.col("row_count") * profiling.HIGH_CARDINALITY_SHARE)
    out.append(melted(high, "categories", {"high_cardinality": F.lit(1)}, name))
    report = out[0]
    for part in out[1:]:
        report = report.unionByName(part)
    return report
