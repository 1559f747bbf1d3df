"""The whole job: land, validate, prepare, transform, store, version, train."""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import feature_store, versioning
from ..operators.reporting import is_wide
from ..sources import raw_zone, snapshots
from .prepare import KEY, prepare_all
from .train import save, train_and_compare, training_matrix
from .transform import transform
from .validate import validate_tables

STAGE_SCHEMA = "stage string, dataset string, row_count bigint, column_count int"


def run(
    tables: Mapping[str, DataFrame],
    root: str,
    ingest_date: str | dt.date,
    train_models: bool = True,
    rounds: int = 100,
    key: str = KEY,
) -> DataFrame:
    """Runs every stage and returns rows and columns after each.

    Features come from the first table. A stage reads what the stage before
    wrote, so a failed run can be taken up again from the last written table.
    Models and their results are saved under ``training``. A prepared table with
    very many columns is warned about. Errors are raised, not recorded.
    """
    spark = next(iter(tables.values())).sparkSession
    stages = []

    landed = {}
    for source, df in tables.items():
        raw_zone.store_raw(df, f"{root}/raw", "customers", source, ingest_date)
        rows = raw_zone.load_raw(spark, f"{root}/raw", "customers", source)
        landed[source] = raw_zone.columns_without_partitions(rows.where(F.col("ingest_date") == str(ingest_date)))
        stages.append(("land", source, landed[source].count(), len(landed[source].columns)))

    issues = validate_tables(landed)["issues"]
    found = {r.dataset: r["count"] for r in issues.groupBy("dataset").count().collect()}
    stages += [("validate", source, found.get(source, 0), len(landed[source].columns)) for source in landed]

    prepared = {}
    for source, df in prepare_all(landed, (key,)).items():
        log = snapshots.save_table(df, f"{root}/prepared", source).first()
        prepared[source] = snapshots.load_latest(spark, f"{root}/prepared", source)
        stages.append(("prepare", source, log.row_count, log.column_count))
        if is_wide(prepared[source]):
            warnings.warn(f"{source} has {log.column_count} columns after preparation", stacklevel=2)

    first = next(iter(tables))
    table = transform(prepared[first], (key,))
    stored = feature_store.store_features(table, f"{root}/features", key, "Churn").first()
    stages.append(("transform", first, stored.row_count, len(table.columns)))
    features = spark.read.parquet(stored.location)

    version = versioning.record_version(features, f"{root}/versions", "Churn").first()
    stages.append(("version", first, version.row_count, version.feature_count))

    if train_models:
        training = train_and_compare(training_matrix(features, keys=(key,)), rounds)
        save(training, f"{root}/training")
        stages.append(("train", first, training.results.count(), len(training.matrix.features)))
    return spark.createDataFrame(stages, STAGE_SCHEMA)
