"""Dropping lines that many documents share.

Lines are exploded with their position, normalised and hashed to 128 bits. The
documents of a hash are counted in two steps, first each document once, then
the documents, so a line of a third of all documents is combined before the
shuffle. A line over the threshold is dropped everywhere but in one document;
positions to drop go back to their document, which is cut into the runs of
lines between them. Only built-in expressions are used.

Defined cases: a null or empty text is one empty line; a null id counts as one
document with the smallest id; rows that repeat id and text are the same
document and each gives its row; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.joins import attach
from tabloom.llm.common import BLANKS, ascii_lower, let, texts
from tabloom.sources.workspace import materialized


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def _without(text: Column, positions: Column) -> Column:
    """The text without the lines at these positions: the runs between them, joined."""

    def cut(bounds):
        def joined(lines):
            runs = F.transform(
                F.sequence(F.lit(1), F.size(bounds) - 1),
                lambda k: F.slice(lines, bounds[k - 1] + 2, bounds[k] - bounds[k - 1] - 1),
            )
            return F.array_join(F.flatten(runs), "\n")

        return let(F.split(text, "\n", -1), joined)

    ends = F.size(F.split(text, "\n", -1))
    return let(F.concat(F.array(F.lit(-1)), F.sort_array(positions), F.array(ends)), cut)


def drop_common_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """One row per document: ``doc_id``, ``text`` without common lines, ``n_lines`` before and ``n_dropped``."""
    documents = texts(docs, id_col, text_col).withColumn("version", F.xxhash64("text"))
    exploded = documents.select("doc_id", "version", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = exploded.select("doc_id", "version", "pos", line_key(F.col("line")).alias("key"))
    lines = materialized(
        keyed.filter(F.length("key") >= min_chars).select("doc_id", "version", "pos", F.unhex(F.md5("key")).alias("hash")),
        "line-hashes",
    )
    once = lines.groupBy("hash", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    common = materialized(
        once.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keep_id"), F.sum("n").alias("n_rows"))
        .filter(F.col("n_docs") >= min_docs)
        .select("hash", "keep_id", "n_rows"),
        "common-lines",
    )
    found = attach(lines, common, "hash", "n_rows")
    drops = (
        found.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("doc_id", "version")
        .agg(F.collect_set("pos").alias("drops"))
        .select(F.col("doc_id").alias("of_id"), F.col("version").alias("of_version"), "drops")
    )
    same = documents["doc_id"].eqNullSafe(drops["of_id"]) & (documents["version"] == drops["of_version"])
    whole = documents.join(drops, same, "left")
    kept = F.when(F.col("drops").isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col("drops")))
    return whole.select(
        "doc_id",
        kept.alias("text"),
        F.size(F.split("text", "\n", -1)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
