"""Derived features. All of them are row-level projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, names_like
from ..functions.expressions import bin_flags, bin_label, ratio, row_sum

# Bin edges (right-closed, last bin open) and labels.
TENURE_EDGES = [0, 12, 24, 48, 72]
TENURE_LABELS = ["0-1_year", "1-2_years", "2-4_years", "4-6_years", "6+_years"]
MONTHLY_EDGES = [0, 35, 65, 95]
TOTAL_EDGES = [0, 1000, 3000, 6000]
CHARGE_LABELS = ["Low", "Medium", "High", "Very_High"]

# Name parts that mark service columns and, among them, premium ones.
SERVICE_PARTS = ["internet", "phone", "online", "backup", "protection", "support", "streaming"]
PREMIUM_PARTS = ["streaming", "backup", "protection", "support"]
ABSENT_SERVICE_PARTS = ["_no internet service", "_no phone service", "internetservice_no"]


def tenure_group(value: Column) -> Column:
    """Years-with-us group of a tenure in months."""
    return bin_label(value, TENURE_EDGES, TENURE_LABELS)


def monthly_group(value: Column) -> Column:
    return bin_label(value, MONTHLY_EDGES, CHARGE_LABELS)


def total_group(value: Column) -> Column:
    return bin_label(value, TOTAL_EDGES, CHARGE_LABELS)


def bin_flag_columns(names: Sequence[str]) -> list[str]:
    """The 0/1 columns of tenure and charge groups among the names."""
    flags = {f"tenure_{label}" for label in TENURE_LABELS}
    flags |= {f"{prefix}_{label}" for prefix in ("monthly_charges", "total_charges") for label in CHARGE_LABELS}
    return [name for name in names if name in flags]


def add_tenure_features(df: DataFrame) -> DataFrame:
    """Tenure in years, squared, logged, and one flag per tenure group."""
    if "tenure" not in df.columns:
        return df
    tenure = col("tenure")
    return df.select(
        "*",
        (tenure / F.lit(12.0)).alias("tenure_years"),
        (tenure * tenure).alias("tenure_squared"),
        F.log1p(tenure).alias("tenure_log"),
        *bin_flags(tenure, TENURE_EDGES, TENURE_LABELS, "tenure"),
    )


def add_financial_features(df: DataFrame) -> DataFrame:
    """Charge ratios and one flag per charge group."""
    if not {"MonthlyCharges", "TotalCharges"} <= set(df.columns):
        return df
    monthly, total = col("MonthlyCharges"), col("TotalCharges")
    per_month = [ratio(total, col("tenure")).alias("avg_monthly_charges")] if "tenure" in df.columns else []
    return df.select(
        "*",
        *per_month,
        ratio(total, monthly).alias("total_to_monthly_ratio"),
        *bin_flags(monthly, MONTHLY_EDGES, CHARGE_LABELS, "monthly_charges"),
        *bin_flags(total, TOTAL_EDGES, CHARGE_LABELS, "total_charges"),
    )


def service_columns(names: Sequence[str], strict: bool = False) -> list[str]:
    """Columns that stand for a service.

    Flags such as "no internet service" carry a service's name as well and
    count, unless ``strict``.
    """
    found = names_like(names, SERVICE_PARTS)
    absent = set(names_like(found, ABSENT_SERVICE_PARTS)) if strict else set()
    return [name for name in found if name not in absent]


def premium_columns(names: Sequence[str], strict: bool = False) -> list[str]:
    return names_like(service_columns(names, strict), PREMIUM_PARTS)


def add_service_features(df: DataFrame, strict: bool = False) -> DataFrame:
    """Number of services, services per unit charged, and a premium flag."""
    services = service_columns(df.columns, strict)
    if not services:
        return df
    total = row_sum([col(c) for c in services])
    new = [total.alias("total_services")]
    if "MonthlyCharges" in df.columns:
        new.append(ratio(total, col("MonthlyCharges")).alias("service_density"))
    premium = premium_columns(df.columns, strict)
    if premium:
        new.append((row_sum([col(c) for c in premium]) > 0).cast("int").alias("has_premium_services"))
    return df.select("*", *new)


def crossed_columns(names: Sequence[str], left: str, right: str) -> list[tuple[str, str]]:
    """All pairs of a column named like ``left`` and one named like ``right``."""
    return [(a, b) for a in names_like(names, [left]) for b in names_like(names, [right])]


def add_interaction_features(df: DataFrame) -> DataFrame:
    """Products of tenure and charge, contract and payment, age flag and services."""
    names = set(df.columns)
    new = []
    if {"tenure", "MonthlyCharges"} <= names:
        new.append((col("tenure") * col("MonthlyCharges")).alias("tenure_monthly_interaction"))
    for a, b in crossed_columns(df.columns, "contract", "payment"):
        new.append((col(a) * col(b)).alias(f"{a}_{b}_interaction"))
    if {"SeniorCitizen", "total_services"} <= names:
        new.append((col("SeniorCitizen") * col("total_services")).alias("senior_service_interaction"))
    return df.select("*", *new)


# Name and description of each feature group.
GROUPS = [
    (add_tenure_features, "tenure_features", "Tenure in other units and groups"),
    (add_financial_features, "financial_features", "Charge ratios and groups"),
    (add_service_features, "service_features", "Service counts and density"),
    (add_interaction_features, "interaction_features", "Products of related columns"),
]


def add_features(df: DataFrame) -> DataFrame:
    """All feature groups, each seeing the columns of the ones before."""
    for add, _, _ in GROUPS:
        df = add(df)
    return df


def feature_groups(df: DataFrame) -> DataFrame:
    """Which features each group adds to this frame; no data is read."""
    rows = []
    for add, group, description in GROUPS:
        wider = add(df)
        rows += [(group, name, description) for name in wider.columns[len(df.columns) :]]
        df = wider
    return df.sparkSession.createDataFrame(rows, "feature_group string, feature string, description string")


def with_target(df: DataFrame, names: Sequence[str] = ("Churn", "churn")) -> tuple[DataFrame, str]:
    """The frame and its target column; a constant 0 stands in where there is none."""
    for name in names:
        if name in df.columns:
            return df, name
    return df.withColumn(names[0], F.lit(0)), names[0]


def split_features_labels(df: DataFrame, key: str, names: Sequence[str] = ("Churn", "churn")):
    """Feature table and label table; both carry the key, so they can be matched again."""
    df, target = with_target(df, names)
    return df.drop(target), df.select(col(key), col(target))
