"""Reports about tables: issues found, and before/after comparison."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..functions.columns import col, nan_to_null, numeric_columns, quoted
from ..functions.jobs import side_by_side
from ..functions.quantiles import column_quantiles
from . import profiling

OUTLIER_SHARE_PCT = 5
WIDE_TABLE = 100
MEASURE_SCHEMA = "dataset string, check string, column_name string, metric string, value double"


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


#: What is counted of every column, and of numeric ones; with the buffer fields each takes.
_EVERY = {"missing": ("count_if({c} IS NULL)", 1), "is_constant": ("min({c}) = max({c})", 2)}
_NUMERIC = {
    "min_value": ("CAST(min({c}) AS double)", 1),
    "max_value": ("CAST(max({c}) AS double)", 1),
    "mean_value": ("CAST(avg({c}) AS double)", 2),
    "std_value": ("CAST(stddev_samp({c}) AS double)", 3),
    "negative_count": ("count_if({c} < 0)", 1),
    "zero_count": ("count_if({c} = 0)", 1),
}


def _scan(df: DataFrame) -> tuple[int, int, dict[str, dict]]:
    """Rows, rows with a missing value, and the measures of each column, from one scan.

    Tables with very many columns are scanned in groups of columns, each reading its own only.
    """
    numbers = set(numeric_columns(df))
    asked = {c: _EVERY | (_NUMERIC if c in numbers else {}) for c in df.columns}
    groups, used = [[]], 0
    for c, measures in asked.items():
        width = sum(fields for _, fields in measures.values())
        if groups[-1] and used + width > profiling.AGGREGATE_FIELDS:
            groups.append([])
            used = 0
        groups[-1].append(c)
        used += width
    any_missing = " OR ".join(f"{quoted(c)} IS NULL" for c in df.columns)

    def scan(columns: list[str], whole: bool) -> Row:
        cells = ["count(*) AS n", f"count_if({any_missing}) AS incomplete"] if whole else []
        for i, c in enumerate(columns):
            cells += [f"{template.format(c=quoted(c))} AS m{i}_{m}" for m, (template, _) in asked[c].items()]
        return df.agg(*[F.expr(cell) for cell in cells]).first()

    rows = side_by_side({g: partial(scan, columns, g == 0) for g, columns in enumerate(groups)})
    found = {c: {m: rows[g][f"m{i}_{m}"] for m in asked[c]} for g, columns in enumerate(groups) for i, c in enumerate(columns)}
    return rows[0]["n"], rows[0]["incomplete"], found


def _outlier_counts(df: DataFrame, bounds: Mapping[str, tuple]) -> dict[str, int]:
    known = {c: ends for c, ends in bounds.items() if ends[0] is not None}
    if not known:
        return {}
    row = df.agg(
        *[F.count_if((col(c) < F.lit(lo)) | (col(c) > F.lit(hi))).alias(f"m{i}") for i, (c, (lo, hi)) in
          enumerate(known.items())]
    ).first()
    return dict(zip(known, row))


def _percent(part, whole):
    return None if not whole else part * 100.0 / whole


def validate(df: DataFrame, dataset: str) -> DataFrame:
    """Every check of the table as (dataset, check, column_name, metric, value).

    Missing values, constants and ranges come from one scan; beside it run the
    quartile search with a scan that counts outliers, and two groupings that
    count values and equal rows. Independent jobs run beside each other. What comes back to
    the driver is a few numbers per column.
    """
    clean = nan_to_null(df)
    numbers = numeric_columns(df)

    def ranges():
        quartiles = column_quantiles(clean, numbers, [0.25, 0.5, 0.75])
        bounds = {c: profiling.iqr_limits(q1, q3) for c, (q1, _, q3) in quartiles.items()}
        return quartiles, bounds, _outlier_counts(clean, bounds)

    found = side_by_side(
        {
            "columns": partial(_scan, profiling.comparable(clean)),
            "ranges": ranges,
            "copies": profiling.duplicate_rows(df).first,
            "texts": profiling.categorical_summary(clean).collect,
        }
    )
    rows, incomplete_rows, moments = found["columns"]
    missing = {c: m["missing"] for c, m in moments.items()}
    constants = [c for c, m in moments.items() if m["is_constant"]]
    quartiles, bounds, outliers = found["ranges"]
    copies, texts = found["copies"], found["texts"]

    out = []

    def add(check: str, column: str, **metrics):
        out.extend((dataset, check, column, m, None if v is None else float(v)) for m, v in metrics.items())

    add("shape", "", row_count=rows, column_count=len(df.columns))
    add("missing", "", rows_with_missing=incomplete_rows, missing_rows_pct=_percent(incomplete_rows, rows))
    add(
        "duplicates",
        "",
        duplicate_rows=copies.duplicate_rows,
        distinct_rows=copies.distinct_rows,
        duplicate_pct=copies.duplicate_pct,
    )
    for c, count in missing.items():
        add("missing", c, missing_count=count, missing_pct=_percent(count, rows))
    for c in constants:
        add("duplicates", c, constant=1)
    for row in texts:
        add(
            "categories",
            row.column_name,
            distinct_count=row.distinct_count,
            most_frequent_count=row.most_frequent_count,
            least_frequent_count=row.least_frequent_count,
        )
        if row.distinct_count > rows * profiling.HIGH_CARDINALITY_SHARE:
            add("categories", row.column_name, high_cardinality=1)
    for c in numbers:
        seen, present = moments[c], rows - missing[c]
        add("ranges", c, **{m: seen[m] for m in ("min_value", "max_value", "mean_value", "std_value")})
        add("ranges", c, median_value=quartiles[c][1])
        for name in ("negative", "zero"):
            count = seen[f"{name}_count"]
            add("ranges", c, **{f"{name}_count": count, f"{name}_pct": _percent(count, present)})
        add(
            "outliers",
            c,
            outlier_count=outliers.get(c, 0),
            outlier_pct=_percent(outliers.get(c, 0), present),
            lower_bound=bounds[c][0],
            upper_bound=bounds[c][1],
        )
    return df.sparkSession.createDataFrame(out, MEASURE_SCHEMA)


# Rule, the metric that triggers it, the limit it has to exceed, and the advice.
RULES = [
    ("missing_values", "missing_count", 0, "Consider imputation or removal of missing values"),
    ("duplicate_rows", "duplicate_rows", 0, "Remove duplicate rows before analysis"),
    ("high_cardinality", "high_cardinality", 0, "Consider feature engineering for high cardinality columns"),
    ("outliers", "outlier_pct", OUTLIER_SHARE_PCT, "Investigate and handle outliers appropriately"),
]
RULE_SCHEMA = "rule string, metric string, threshold double, recommendation string"


def find_issues(measures: DataFrame) -> DataFrame:
    """One warning per dataset and rule that is broken, with the columns concerned.

    ``measures`` is the report of :func:`validate`, of one or more datasets;
    it has a row per column and metric, however large the tables are.
    """
    rules = measures.sparkSession.createDataFrame([(r, m, float(t), a) for r, m, t, a in RULES], RULE_SCHEMA)
    broken = measures.join(F.broadcast(rules), "metric").where("value > threshold")
    affected = F.concat_ws(",", F.sort_array(F.collect_list(F.expr("nullif(column_name, '')"))))
    return broken.groupBy("dataset", "rule", "recommendation").agg(
        F.lit("warning").alias("severity"),
        F.when(F.col("rule") == "duplicate_rows", F.max("value"))
        .otherwise(F.count("*").cast("double"))
        .cast("bigint")
        .alias("affected_count"),
        affected.alias("affected"),
    )


# The overall advice.
ADVICE_ON_ISSUES = ["Review individual dataset issues", "Address missing values and duplicates before modeling"]
ADVICE_ELSE = ["Datasets appear to be in good quality for modeling"]


def combined_summary(measures: DataFrame, issues: DataFrame) -> DataFrame:
    """Totals over all datasets and the overall advice, its sentences parted by semicolons."""
    totals = measures.where(F.col("check") == "shape").agg(
        F.count_distinct("dataset").alias("total_datasets"),
        F.sum(F.when(F.col("metric") == "row_count", F.col("value"))).cast("bigint").alias("total_records"),
        F.sum(F.when(F.col("metric") == "column_count", F.col("value"))).cast("bigint").alias("total_features"),
    )
    advice = F.when(F.col("overall_issues") > 0, "; ".join(ADVICE_ON_ISSUES)).otherwise("; ".join(ADVICE_ELSE))
    found = issues.agg(F.count("*").alias("overall_issues")).withColumn("recommendation", advice)
    # both sides are single rows
    return totals.withColumn("_one", F.lit(1)).join(found.withColumn("_one", F.lit(1)), "_one").drop("_one")


def is_wide(df: DataFrame, limit: int = WIDE_TABLE) -> bool:
    """More columns than a prepared table should have."""
    return len(df.columns) > limit


def comparison_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows, columns, missing values and duplicate rows of two versions of a table."""
    sides = []
    for df, name in ((before, "original"), (after, "prepared")):
        missing = profiling.missing_values(df).agg(F.coalesce(F.sum("missing_count"), F.lit(0)).alias("v"))
        copies = profiling.duplicate_rows(df)
        parts = [
            copies.select(F.lit("row_count").alias("metric"), F.col("total_rows").alias(name)),
            copies.select(F.lit("duplicate_rows").alias("metric"), F.col("duplicate_rows").alias(name)),
            missing.select(F.lit("missing_values").alias("metric"), F.col("v").alias(name)),
            df.sparkSession.createDataFrame([("column_count", len(df.columns))], f"metric string, {name} bigint"),
        ]
        sides.append(_union(parts))
    return sides[0].join(sides[1], "metric")


def comparison_columns(before: DataFrame, after: DataFrame) -> DataFrame:
    """Type and missing values per column of either version; a full outer join on the name."""
    sides = []
    for df, name in ((before, "original"), (after, "prepared")):
        types = profiling.column_types(df).select("column_name", F.col("data_type").alias(f"{name}_type"))
        missing = profiling.missing_values(df).select("column_name", F.col("missing_count").alias(f"{name}_nulls"))
        sides.append(types.join(missing, "column_name"))
    return sides[0].join(sides[1], "column_name", "full_outer")


def report_sheets(measures: DataFrame, df: DataFrame) -> dict[str, DataFrame]:
    """The validation report as one frame per topic."""
    by_column = measures.where("column_name <> ''")

    def sheet(check, *metrics):
        return by_column.where(F.col("check") == check).groupBy("dataset", "column_name").pivot(
            "metric", list(metrics)
        ).agg(F.first("value"))

    return {
        "summary": measures.where("column_name = ''").select("dataset", "metric", "value"),
        "missing_values": sheet("missing", "missing_count", "missing_pct"),
        "data_types": profiling.column_types(df),
        "outliers": sheet("outliers", "outlier_count", "outlier_pct", "lower_bound", "upper_bound"),
    }


def write_report(sheets: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """Each sheet as JSON lines under its own folder."""
    paths = {}
    for name, frame in sheets.items():
        paths[name] = f"{root}/{name}"
        frame.coalesce(1).write.mode("overwrite").json(paths[name])
    return paths
