"""Raw tables landed by source and day.

A landing writes to a folder of its own and becomes visible by a commit (see
:mod:`.commits`) that names its days. The newest commit of a day is the one that
is read, so a day is replaced as a whole, nothing that failed is ever read, and
a landing looks at its own files only, however many there are already.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from .commits import CommitLog
from .workspace import delete_path, folder_of, materialized

PARTITIONS = ["source", "ingest_date"]
MEGABYTE = 1024 * 1024
LOG_SCHEMA = (
    "number bigint, action string, source string, ingest_date date, row_count bigint, file_count bigint,"
    " file_bytes bigint, folder string, table_schema string"
)


def _value(given) -> Column:
    return given if isinstance(given, Column) else F.lit(given)


def _log(spark: SparkSession, root: str, data_type: str) -> CommitLog:
    return CommitLog(spark, f"{root}/{data_type}/_commits", LOG_SCHEMA)


def _files(rows: DataFrame) -> DataFrame:
    """One row per file: its day, size and rows. No data column is read."""
    return (
        rows.select(
            *PARTITIONS,
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_bytes"),
        )
        .groupBy(*PARTITIONS, "file_path", "file_bytes")
        .agg(F.count("*").alias("row_count"))
    )


def store_raw(df: DataFrame, root: str, data_type: str, source, ingest_date) -> DataFrame:
    """Lands the rows and returns one metadata row per source and day written.

    ``source`` and ``ingest_date`` are constants or columns. Writing a day again
    replaces that day only; if another writer lands the same day meanwhile, one
    of both gets a :class:`.commits.Conflict`. With columns, the rows are rebalanced by partition
    first: adaptive execution then splits a source that holds most of the rows
    over many files and packs small days together.
    """
    rows = df.withColumns({"source": _value(source).cast("string"), "ingest_date": _value(ingest_date).cast("date")})
    if isinstance(source, Column) or isinstance(ingest_date, Column):
        rows = rows.hint("rebalance", *[F.col(p) for p in PARTITIONS])
    spark, path = df.sparkSession, f"{root}/{data_type}"
    log = _log(spark, root, data_type)
    base, landing = log.newest(), f"{path}/landing={uuid.uuid4().hex}"
    rows.write.partitionBy(*PARTITIONS).parquet(landing)

    own = spark.read.schema(_with_partitions(df.schema)).parquet(landing)
    days = (
        _files(own)
        .groupBy(*PARTITIONS)
        .agg(F.sum("row_count").alias("row_count"), F.count("*").alias("file_count"), F.sum("file_bytes").alias("file_bytes"), F.min("file_path").alias("file_path"))
        .collect()
    )  # one row per source and day of this landing
    schema = df.schema.json()
    lines = [
        {
            "action": "land",
            "source": d.source,
            "ingest_date": None if d.ingest_date is None else str(d.ingest_date),
            "row_count": d.row_count,
            "file_count": d.file_count,
            "file_bytes": d.file_bytes,
            "folder": folder_of(spark, d.file_path).toString(),
            "table_schema": schema,
        }
        for d in days
    ]
    log.append(lines or [{"action": "nothing", "table_schema": schema}], base, PARTITIONS if lines else ())
    written = [
        (d.source, d.ingest_date, data_type, d.row_count, len(df.columns), ",".join(df.columns), d.file_count, d.file_bytes / MEGABYTE)
        for d in days
    ]
    return spark.createDataFrame(
        written,
        "source string, ingest_date date, data_type string, row_count bigint, column_count int, columns string,"
        " file_count bigint, size_mb double",
    )


def _with_partitions(schema: T.StructType) -> T.StructType:
    fields = [f for f in schema if f.name not in PARTITIONS]
    return T.StructType([*fields, T.StructField("source", T.StringType()), T.StructField("ingest_date", T.DateType())])


def days(spark: SparkSession, root: str, data_type: str, source: str | None = None) -> DataFrame:
    """What is there: the newest commit of every source and day, one row each."""
    found = _log(spark, root, data_type).read()
    if source is not None:
        found = found.where(F.col("source") == source)
    rest = [c for c in found.columns if c not in PARTITIONS]
    newest = found.where("action <> 'nothing'").groupBy(*PARTITIONS).agg(F.max_by(F.struct(*rest), "number").alias("last"))
    return newest.select(*PARTITIONS, "last.*").where("action = 'land'")


def load_raw(spark: SparkSession, root: str, data_type: str, source: str | None = None) -> DataFrame:
    """Landed rows; a source restricts the listing and the scan to its folders.

    Columns are those of the newest landing. Sources are texts and days are
    dates whatever they look like: folder names are not guessed at, so a source
    "007" stays one.
    """
    log = _log(spark, root, data_type).read()
    last = log.agg(F.max_by("table_schema", F.when(F.col("table_schema").isNotNull(), F.col("number")))).first()[0]
    if last is None:
        raise FileNotFoundError(f"nothing has been landed under {root}/{data_type}")
    schema = _with_partitions(T.StructType.fromJson(json.loads(last)))
    folders = [r.folder for r in days(spark, root, data_type, source).select("folder").collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    # a folder per source and day: what Spark keeps of a partitioned table in any case
    rows = spark.read.schema(schema).option("basePath", f"{root}/{data_type}").parquet(*folders).drop("landing")
    return rows.where(F.col("source") == source) if source is not None else rows


def catalog(spark: SparkSession, root: str, data_type: str, source: str | None = None) -> DataFrame:
    """One row per landed file. No data column is read."""
    return _files(load_raw(spark, root, data_type, source))


def summary(rows: DataFrame) -> DataFrame:
    """Rows and days per source."""
    return rows.groupBy("source").agg(
        F.count("*").alias("row_count"),
        F.count_distinct("ingest_date").alias("day_count"),
        F.lit(len([c for c in rows.columns if c not in PARTITIONS])).alias("column_count"),
    )


def retention(listed: DataFrame, as_of: str | dt.date, days_to_keep: int = 30) -> DataFrame:
    """Days, files, rows and megabytes per source, split into kept and expired days.

    A day expires when it lies more than ``days_to_keep`` days before ``as_of``.
    """
    limit = F.date_sub(F.lit(as_of).cast("date"), days_to_keep)
    state = F.when(F.col("ingest_date") < limit, "expired").otherwise("kept").alias("state")
    return listed.groupBy("source", state).agg(
        F.count_distinct("ingest_date").alias("day_count"),
        F.count("*").alias("file_count"),
        F.sum("row_count").alias("row_count"),
        (F.sum("file_bytes") / MEGABYTE).alias("size_mb"),
    )


def drop_expired(
    spark: SparkSession, root: str, data_type: str, as_of: str | dt.date, days_to_keep: int = 30
) -> DataFrame:
    """Removes expired days and returns the retention report from before.

    A commit takes the days out of the table first; then their folders are
    removed, whose number is the number of days, not of rows.
    """
    log = _log(spark, root, data_type)
    base = log.newest()
    report = materialized(retention(catalog(spark, root, data_type), as_of, days_to_keep), "retention")
    limit = F.date_sub(F.lit(as_of).cast("date"), days_to_keep)
    expired = days(spark, root, data_type).where(F.col("ingest_date") < limit).select(*PARTITIONS, "folder").collect()
    if expired:
        lines = [{"action": "drop", "source": r.source, "ingest_date": str(r.ingest_date)} for r in expired]
        log.append(lines, base, PARTITIONS)
    _remove(spark, [r.folder for r in expired])
    return report


def drop_replaced(spark: SparkSession, root: str, data_type: str) -> int:
    """Removes folders of days that were landed again or dropped since; returns their number.

    Readers that began before the newer landing may still need them, so this is
    for quiet times. What failed landings left has no commit and is not touched.
    """
    landed = _log(spark, root, data_type).read().where("action = 'land'").select("folder").distinct()
    old = [r.folder for r in landed.join(days(spark, root, data_type).select("folder"), "folder", "left_anti").collect()]
    return sum(delete_path(spark, folder) for folder in old)


def _remove(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        if not delete_path(spark, folder):
            raise FileNotFoundError(f"{folder} is listed, but could not be removed")


def columns_without_partitions(rows: DataFrame) -> DataFrame:
    """The landed columns alone."""
    return rows.select(*[col(c) for c in rows.columns if c not in PARTITIONS])
