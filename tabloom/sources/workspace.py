"""The shared folder intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: The folder of each application that has asked; Spark reports a sub-folder of it later on.
_OWN: dict[str, str] = {}


def workspace(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Tests on one machine may leave it unset and get a fresh folder; a cluster
    has to name storage every executor can reach.
    """
    named = spark.conf.get("spark.checkpoint.dir", "") or _OWN.get(spark.sparkContext.applicationId)
    if not named and spark.sparkContext.getCheckpointDir():
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    _OWN[spark.sparkContext.applicationId] = named
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{_tables(spark)}/{name}-{uuid.uuid4().hex}"


def _tables(spark: SparkSession) -> str:
    return f"{workspace(spark)}/tables/{spark.sparkContext.applicationId}"


def drop_tables(spark: SparkSession) -> None:
    """Removes the intermediate tables of this application, once no result needs them any more."""
    if path_exists(spark, _tables(spark)):
        delete_path(spark, _tables(spark))


def materialized(df: DataFrame, name: str) -> DataFrame:
    """The frame written once as Parquet and read back.

    Used where several passes follow a shuffle: the passes then scan only the
    columns they need, and a lost executor costs a re-read, not a recomputation.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_tables(*frames: DataFrame) -> None:
    """Removes tables that :func:`materialized` has written, once what was made of them is written itself."""
    for df in frames:
        for folder in {str(folder_of(df.sparkSession, uri)) for uri in df.inputFiles()}:
            delete_path(df.sparkSession, folder)


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame with fixed partitions in the checkpoint folder."""
    workspace(df.sparkSession)
    return df.checkpoint(eager=True)


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def delete_path(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def folder_of(spark: SparkSession, uri: str):
    """The Hadoop path of the folder a file of ``_metadata.file_path`` lies in, its escapes undone."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).getParent()


def tables_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the Parquet tables of a folder."""
    location = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = location.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(location)
    names = [entry.getPath().getName() for entry in listed]
    return sorted(n.removesuffix(".parquet") for n in names if n.endswith(".parquet") and not n.startswith(("_", ".")))
