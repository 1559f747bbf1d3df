"""Exact deduplication against a persistent index of digests.

The index is a Parquet table of SHA-256 digests, bucketed and sorted by digest,
that outlives the session: ``open_index`` registers its folder again. A batch is
reduced to one candidate per digest (copies collapse before the shuffle), the
candidates that a sort-merge anti-join does not find in the index are new, and
their digests are appended under the name of the batch, which the caller gives.
Reading "the index without this batch" stays right after the append: a task that
runs again on another executor decides as before, and so does a whole run that
failed after the append, or whose result nobody read, when it is run again under
the same name. A digest is appended once per batch, however often that runs.

Defined cases: a null text equals the empty text; a null id counts as the
smallest id; of repeated rows (same id, same text) exactly one stays; an empty
table gives an empty result; other columns pass through ``drop_copies``
untouched, whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.joins import attach
from tabloom.llm.common import texts
from tabloom.sources.workspace import materialized, new_path

#: Buckets of a new index at least; by default it has as many as a shuffle has partitions.
BUCKETS = 24


def open_index(spark: SparkSession, path: str, id_type: str = "bigint", buckets: int = BUCKETS) -> str:
    """Registers the index in this folder, made on first use, and returns its table name."""
    name = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
    location = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id {id_type}, keep_row BIGINT, copies BIGINT, batch STRING)"
        f" USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    return name


def _buckets(spark: SparkSession, index: str) -> int:
    described = spark.sql(f"DESCRIBE EXTENDED {index}").filter("col_name = 'Num Buckets'").first()
    return int(described["data_type"])


def _before(spark: SparkSession, index: str, batch: str) -> DataFrame:
    return spark.table(index).filter(F.col("batch") != batch)


def _append(groups: DataFrame, index: str, batch: str) -> None:
    """Adds the groups that the index does not have; one file for each bucket."""
    spark = groups.sparkSession
    known = spark.table(index).select("digest")  # its own ones too, if the batch has been here before
    new = groups.join(known.hint("merge"), "digest", "left_anti")
    rows = new.select("digest", "keep_id", "keep_row", "copies", F.lit(batch).alias("batch"))
    rows.repartition(_buckets(spark, index), "digest").write.insertInto(index)


def decide(docs: DataFrame, index: str, batch: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``digest``.

    ``batch`` names these documents; a repeat under the same name gives the same rows.

    ``keep_id`` is the largest id among equal texts of the batch, or the id an
    earlier batch has put into the index; ``group_size`` counts the batch.
    """
    spark = docs.sparkSession
    digest = F.unhex(F.sha2(F.col("text"), 256))
    rows = materialized(
        texts(docs, id_col, text_col).select("doc_id", digest.alias("digest"), F.monotonically_increasing_id().alias("row")),
        "digests",
    )
    groups = materialized(
        rows.groupBy("digest")
        .agg(F.max(F.struct("doc_id", "row")).alias("last"), F.count(F.lit(1)).alias("copies"))
        .select("digest", F.col("last.doc_id").alias("keep_id"), F.col("last.row").alias("keep_row"), "copies"),
        "digest-groups",
    )
    _append(groups, index, batch)
    known = _before(spark, index, batch).select("digest", F.col("keep_id").alias("old_id"), F.lit(True).alias("old"))
    groups = groups.join(known.hint("merge"), "digest", "left")
    groups = materialized(groups.withColumn("old", F.coalesce("old", F.lit(False))), "digest-decisions")
    found = attach(rows, groups, "digest", "copies")
    return found.select(
        "doc_id",
        F.when(F.col("old"), F.col("old_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.col("copies").alias("group_size"),
        (~F.col("old") & (F.col("row") == F.col("keep_row"))).alias("kept"),
        "digest",
    )


def drop_copies(docs: DataFrame, index: str, batch: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is new, the largest id of each, with all their columns.

    ``batch`` names these documents; a repeat under the same name gives the same rows.

    Whole rows are reduced by digest, so copies collapse inside the tasks that
    read them and a text is shuffled once.
    """
    spark = docs.sparkSession
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    tie = F.xxhash64(F.to_json(F.struct(*[docs[c] for c in others]))) if others else F.lit(0)
    keyed = docs.select(
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.struct(*[docs[c] for c in docs.columns]).alias("whole"),
        F.struct(docs[id_col].alias("id"), tie.alias("tie")).alias("rank"),
    )
    ids = keyed.groupBy("digest").agg(F.max("rank.id").alias("keep_id"), F.count(F.lit(1)).alias("copies"))
    _append(ids.withColumn("keep_row", F.lit(None).cast("bigint")), index, batch)
    last = keyed.groupBy("digest").agg(F.max_by("whole", "rank").alias("whole"))
    new = last.join(_before(spark, index, batch).select("digest").hint("merge"), "digest", "left_anti")
    return new.select("whole.*")


def fresh_index(docs: DataFrame, id_col: str = "doc_id", buckets: int | None = None) -> str:
    """An empty index in the shared folder, for one run over a whole table."""
    spark = docs.sparkSession
    buckets = buckets or max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return open_index(spark, new_path(spark, "digest-index"), docs.schema[id_col].dataType.simpleString(), buckets)
