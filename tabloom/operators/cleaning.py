"""Types, missing values, copies and outliers.

Operators that learn from data come in two parts: a ``fit_`` function that
runs an aggregate and returns a few values per column, and a function that
applies those values as a lazy projection. The second part also serves streams.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import NUMBER_PATTERN, col, nan_to_null, numeric_columns, quoted, string_columns
from ..functions.expressions import clip, recoded
from ..functions.quantiles import column_quantiles
from .profiling import categorical_summary, iqr_bounds, per_column

FILL_WITHOUT_MODE = "Unknown"
YES_NO = ("Yes", "No", "yes", "no")
CAP_METHODS = ("iqr", "zscore", "cap")


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text to double; blanks and text that is no number become missing."""
    return df.withColumns(
        {c: F.when(col(c).rlike(NUMBER_PATTERN), F.expr(f"try_cast({quoted(c)} AS double)")) for c in columns}
    )


def recode(df: DataFrame, column: str, mapping: Mapping) -> DataFrame:
    """Values replaced by a mapping; values outside it become missing."""
    return df.withColumn(column, recoded(col(column), mapping))


def fit_only_values(df: DataFrame, columns: Sequence[str], allowed: Sequence[str]) -> list[str]:
    """Columns whose every value is one of ``allowed``; a missing value counts against it."""
    if not columns:
        return []
    inside = ", ".join(f"'{v}'" for v in allowed)
    row = df.agg(
        *[
            F.expr(f"bool_and({quoted(c)} IS NOT NULL AND {quoted(c)} IN ({inside})) AS c{i}")
            for i, c in enumerate(columns)
        ]
    ).first()
    return [c for i, c in enumerate(columns) if row[f"c{i}"] is not False]


def fit_yes_no(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Text columns that hold only yes and no in either spelling."""
    return fit_only_values(df, string_columns(df) if columns is None else columns, YES_NO)


def standardize_yes_no(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """yes and no in title case."""
    return df.withColumns({c: F.initcap(col(c)) for c in columns}) if columns else df


@dataclass
class Fill:
    """Values for missing entries; only columns that had some are listed."""

    medians: dict[str, float | None] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)


@dataclass
class Facts:
    """What one scan tells about a table: its size, columns with missing values, yes/no columns."""

    rows: int
    incomplete: list[str]
    yes_no: list[str]


def scan_facts(df: DataFrame) -> Facts:
    """Missing values and yes/no columns of a table, found in the same scan."""
    clean = nan_to_null(df)
    texts = set(string_columns(df))
    allowed = ", ".join(f"'{v}'" for v in YES_NO)
    wanted = [f"count_if({quoted(c)} IS NULL)" for c in df.columns]
    wanted += [f"coalesce(bool_and({quoted(c)} IN ({allowed})), true)" for c in df.columns if c in texts]
    rows, *found = clean.agg(F.count("*"), *[F.expr(e).alias(f"m{i}") for i, e in enumerate(wanted)]).first()
    incomplete = [c for c, n in zip(df.columns, found) if n]
    only_allowed = dict(zip([c for c in df.columns if c in texts], found[len(df.columns) :]))
    return Facts(rows, incomplete, [c for c, only in only_allowed.items() if only and c not in incomplete])


def fit_fill(df: DataFrame, columns: Sequence[str] | None = None, facts: Facts | None = None) -> Fill:
    """Medians of numeric and modes of text columns that have missing values.

    Equally frequent texts give the smallest; a column without values gives
    'Unknown'. Text frequencies are grouped and shuffled per value, never kept
    in one task.
    """
    chosen = df.select(*[col(c) for c in df.columns if columns is None or c in columns])
    facts = facts or scan_facts(chosen)
    clean = nan_to_null(chosen)
    numbers = [c for c in numeric_columns(chosen) if c in facts.incomplete]
    texts = [c for c in string_columns(chosen) if c in facts.incomplete]
    medians = column_quantiles(clean, numbers, [0.5])
    modes = categorical_summary(clean, texts).collect() if texts else []
    found = {r.column_name: r.most_frequent for r in modes}
    return Fill({c: m for c, (m,) in medians.items()}, {c: found.get(c, FILL_WITHOUT_MODE) for c in texts})


def fill_missing(df: DataFrame, fill: Fill) -> DataFrame:
    """Missing entries replaced by the fitted medians and modes."""
    clean = nan_to_null(df)
    new = {c: F.coalesce(col(c).cast("double"), F.lit(m).cast("double")) for c, m in fill.medians.items()}
    new |= {c: F.coalesce(col(c), F.lit(m)) for c, m in fill.modes.items()}
    return clean.withColumns(new) if new else clean


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One of each set of equal rows. Copies are combined before the shuffle."""
    return df.dropDuplicates()


def fit_caps(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "iqr"
) -> dict[str, tuple]:
    """Lower and upper limit per numeric column.

    iqr: Q1 - 1.5 IQR and Q3 + 1.5 IQR; zscore: mean -/+ 3 standard
    deviations; cap: 1st and 99th percentile.
    """
    if method not in CAP_METHODS:
        raise ValueError(f"unknown outlier method: {method}")
    columns = numeric_columns(df) if columns is None else list(columns)
    clean = nan_to_null(df.select(*[col(c) for c in columns]))
    if method == "iqr":
        return {c: (low, high) for c, (_, _, low, high) in iqr_bounds(clean, columns).items()}
    if method == "cap":
        return {c: tuple(ends) for c, ends in column_quantiles(clean, columns, [0.01, 0.99]).items()}
    if not columns:
        return {}
    row = clean.agg(
        *[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_samp(col(c)).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    out = {}
    for i, c in enumerate(columns):
        mean, spread = row[f"m{i}"], row[f"s{i}"]
        out[c] = (None, None) if spread is None else (mean - 3 * spread, mean + 3 * spread)
    return out


def cap_outliers(df: DataFrame, caps: Mapping[str, tuple]) -> DataFrame:
    """Values limited to the fitted range; missing values stay missing."""
    return df.withColumns({c: clip(col(c), low, high) for c, (low, high) in caps.items()}) if caps else df


def capped_counts(df: DataFrame, caps: Mapping[str, tuple]) -> DataFrame:
    """Per column: the limits and how many values lie outside."""
    outside = df.select(
        *[((col(c) < F.lit(low)) | (col(c) > F.lit(high))).alias(c) for c, (low, high) in caps.items()]
    )
    counts = per_column(outside, list(caps), {"outliers_found": ("count_if({c})", "bigint")})
    limits = df.sparkSession.createDataFrame(
        [(c, *ends) for c, ends in caps.items()], "column_name string, lower_bound double, upper_bound double"
    )
    return counts.join(F.broadcast(limits), "column_name")
