"""Feature sets kept by name and version, with statistics of their columns."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, literal, nan_to_null, numeric_columns
from ..sources.commits import CommitLog
from ..sources.snapshots import latest
from ..sources.workspace import path_exists
from .profiling import LONG_TEXT, per_column

KEYS = ["name", "version"]
REGISTRY_SCHEMA = (
    "name string, version string, created_at timestamp, description string, "
    "feature_count int, row_count bigint, key string, label string, location string"
)


def _comparable(df: DataFrame, name: str) -> tuple[str, Column]:
    """(kind, value) to count distinct values by; long texts are replaced by their SHA-256."""
    data_type = df.schema[name].dataType
    if isinstance(data_type, T.IntegralType):
        return "bigint", col(name).cast("bigint")
    if isinstance(data_type, T.FractionalType) and not isinstance(data_type, T.DecimalType):
        return "double", col(name).cast("double")
    text = col(name).cast("string")
    short = F.when(F.octet_length(text) > LONG_TEXT, F.concat(F.lit("sha256:"), F.sha2(text, 256))).otherwise(text)
    return "text", short


def _unique_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Distinct values per column and group, one grouping per kind of value."""
    kinds: dict[str, dict[str, Column]] = {}
    for c in columns:
        kind, value = _comparable(df, c)
        kinds.setdefault(kind, {})[c] = value
    out = None
    for values in kinds.values():
        long = df.select(*by, *[v.alias(c) for c, v in values.items()]).unpivot(
            [F.col(b) for b in by], [col(c) for c in values], "column_name", "value"
        )
        part = long.distinct().groupBy(*by, "column_name").agg(F.count("value").alias("unique_count"))
        out = part if out is None else out.unionByName(part)
    return out


def column_statistics(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Type, missing and distinct values of each column, and moments of numeric ones, per group.

    The moments are one aggregate. Distinct values are counted in two steps
    (values per group, then their number), which combines equal values before
    the shuffle and spreads a large group over all tasks.
    """
    columns = [c for c in df.columns if c not in by] if columns is None else list(columns)
    clean = nan_to_null(df.select(*[col(c) for c in [*by, *columns]]))
    numeric = set(numeric_columns(clean))
    kinds = {c: clean.schema[c].dataType.simpleString() for c in columns}

    moments = []
    for is_numeric in (True, False):
        chosen = [c for c in columns if (c in numeric) == is_numeric]
        if chosen:
            number = "{c}" if is_numeric else "CAST(NULL AS double)"
            moments.append(
                per_column(
                    clean,
                    chosen,
                    {
                        "null_count": ("count_if({c} IS NULL)", "bigint"),
                        "min_value": (f"min({number})", "double"),
                        "max_value": (f"max({number})", "double"),
                        "mean_value": (f"avg({number})", "double"),
                        "std_value": (f"stddev_samp({number})", "double"),
                    },
                    by=by,
                )
            )
    table = moments[0] if len(moments) == 1 else moments[0].unionByName(moments[1])

    distinct = _unique_counts(clean, columns, by)
    kind = "CASE column_name " + " ".join(f"WHEN {literal(c)} THEN '{k}'" for c, k in kinds.items()) + " END"
    out = table.withColumn("data_type", F.expr(kind)).join(distinct, [*by, "column_name"])
    return out.select(
        *by,
        "column_name",
        "data_type",
        "null_count",
        "unique_count",
        "min_value",
        "max_value",
        "mean_value",
        "std_value",
    )


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows per class of the label."""
    return df.groupBy(col(label).alias("label")).agg(F.count("*").alias("label_count"))


def current(registry: DataFrame) -> DataFrame:
    """The registry with one row per name and version: the one stored last."""
    return latest(registry, KEYS, "number" if "number" in registry.columns else "created_at")


def _log(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, f"{root}/registry", f"number bigint, {REGISTRY_SCHEMA}")


def store_features(
    df: DataFrame,
    root: str,
    key: str,
    label: str,
    name: str = "churn_features",
    version: str | None = None,
    description: str | None = None,
    created_at: dt.datetime | None = None,
) -> DataFrame:
    """Writes features and label of each key in one table, then statistics, then the registry row.

    Readers go through the registry, so they see a set only when it is whole.
    Storing a version again adds a newer registry row, which replaces the old
    one on reading; of two that store the same version at once, one gets a
    :class:`..sources.commits.Conflict`. The classes of the label are kept with the
    statistics. Returns the registry row.
    """
    spark = df.sparkSession
    log = _log(spark, root)
    base = log.newest()
    moment = created_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    version = version or f"{moment:%Y%m%d_%H%M%S}"
    features = [c for c in df.columns if c not in (key, label)]
    own = f"{moment:%Y%m%d%H%M%S%f}-{uuid.uuid4().hex}"  # folders of this writer alone
    location = f"{root}/data/name={name}/version={version}/stored={own}"
    df.write.parquet(location)

    stored = spark.read.parquet(location)
    statistics = column_statistics(stored, features).withColumns(
        {"name": F.lit(name), "version": F.lit(version), "location": F.lit(location)}
    )
    statistics.write.parquet(f"{root}/statistics/stored={own}")
    classes = label_distribution(stored, label).select(F.col("label").cast("string"), "label_count")
    classes.withColumn("location", F.lit(location)).coalesce(1).write.parquet(f"{root}/labels/stored={own}")
    entry = (
        name,
        version,
        moment,
        description or f"Feature set {name} version {version}",
        len(features),
        stored.count(),
        key,
        label,
        location,
    )
    row = spark.createDataFrame([entry], REGISTRY_SCHEMA)
    line = dict(zip(row.columns, entry)) | {"created_at": moment.isoformat(timespec="microseconds")}
    log.append([line], base, KEYS)
    return row


def list_features(spark: SparkSession, root: str) -> DataFrame:
    """All feature sets, newest first; none where nothing was stored."""
    return newest_first(current(_log(spark, root).read()).drop("number"))


def newest_first(registry: DataFrame) -> DataFrame:
    return registry.orderBy(F.desc("created_at"), F.desc("version"))


def load_features(spark: SparkSession, root: str, name: str, version: str | None = None):
    """(features, labels) of a version, or of the newest one; both carry the key."""
    found = list_features(spark, root).where(F.col("name") == name)
    if version is not None:
        found = found.where(F.col("version") == version)
    rows = found.limit(1).collect()
    if not rows:
        raise ValueError(f"no feature set {name} {version or ''}".strip())
    table = spark.read.parquet(rows[0].location)
    return table.drop(rows[0].label), table.select(col(rows[0].key), col(rows[0].label))


def feature_catalog(registry: DataFrame, statistics: DataFrame) -> DataFrame:
    """Registry and column statistics together, one row per feature of a set."""
    return registry.select(*KEYS, "created_at", "row_count").join(statistics, KEYS)


def stored_catalog(spark: SparkSession, root: str) -> DataFrame:
    """The catalog of a store; statistics of replaced sets are left out."""
    registry = list_features(spark, root).select(*KEYS, "created_at", "row_count", "location")
    statistics = spark.read.parquet(f"{root}/statistics").drop("stored")
    return registry.join(statistics, [*KEYS, "location"]).drop("location")


def stored_labels(spark: SparkSession, root: str) -> DataFrame:
    """Rows per class of the label of every current set."""
    registry = list_features(spark, root).select(*KEYS, "location")
    schema = "label string, label_count bigint, location string"
    if not path_exists(spark, f"{root}/labels"):
        return spark.createDataFrame([], f"name string, version string, {schema}").drop("location")
    return registry.join(spark.read.schema(schema).parquet(f"{root}/labels"), "location").drop("location", "stored")
