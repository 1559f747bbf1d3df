"""Documents to packed training sequences, stage by stage.

Each stage takes the session, the documents its predecessor kept and the folder
of tables, and returns rows with the columns of ``documents``; the last one
returns the pieces of the packed sequences. Stages are written as Parquet and
read again, so a lost executor repeats one stage at most.

Empty tables, nulls, repeated rows and other columns are treated as the
docstrings of the operators say; every stage passes other columns through.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabloom.llm import exact_dedup, packing, quality_classifier, quality_rules, simhash  # noqa: E402
from tabloom.sources.workspace import materialized  # noqa: E402


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def rules(spark, docs, sf_dir):
    """Documents that pass the base rules and the learned decision list."""
    return quality_rules.keep_good(docs, _labels(spark, sf_dir))


def classifier(spark, docs, sf_dir):
    """Documents that are rather good than bad, by their text and their site."""
    return quality_classifier.keep_good(docs, _labels(spark, sf_dir), docs["source"], docs["lang"])


def exact(spark, docs, sf_dir):
    """One document of each text, the one with the largest id."""
    return exact_dedup.drop_copies(docs, exact_dedup.fresh_index(docs), "documents")


def near(spark, docs, sf_dir):
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash.keep_one(docs)


def packed(spark, docs, sf_dir):
    """Pieces of at most 2,048 tokens with their ids, sequence and offset."""
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("exact dedup", exact),
    ("simhash near-dedup", near),
    ("best-fit packing", packed),
]

#: Learned rules, a fitted classifier and SimHash have no SQL counterpart.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": run}
