"""The operators applied to the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import (
    byte_bpe,
    conversation_repair,
    exact_dedup,
    language_id,
    language_model,
    license_scan,
    line_dedup,
    packing,
    quality_classifier,
    quality_rules,
    simhash,
    token_counts,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


@query
def op1_license_scan(spark, folder):
    return license_scan.find_licenses(read(spark, folder, "documents"))


@query
def op2_quality_classifier(spark, folder):
    docs = read(spark, folder, "documents")
    # the table has no addresses: its source stands for the host, the language for the path
    return quality_classifier.classify(docs, read(spark, folder, "labels"), docs["source"], docs["lang"])


@query
def op3_best_fit_packing(spark, folder):
    pieces = packing.token_pieces(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    checked = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(checked)


@query
def op4_token_counts(spark, folder):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return token_counts.count_tokens(read(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op5_simhash_near_dedup(spark, folder):
    result = simhash.near_duplicates(read(spark, folder, "documents"))
    return result.select("doc_id", F.lower(F.hex("fingerprint")).alias("fingerprint"), "component_id")


@query
def op6_byte_bpe(spark, folder):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.round_trip(read(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256")
    )


@query
def op7_line_dedup(spark, folder):
    result = line_dedup.drop_common_lines(read(spark, folder, "documents"))
    return result.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op8_language_model(spark, folder):
    return language_model.score(read(spark, folder, "documents"))


@query
def op9_quality_rules(spark, folder):
    result = quality_rules.judge(read(spark, folder, "documents"), read(spark, folder, "labels"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return result.select("doc_id", *counts, "base_failed", "kept")


@query
def op10_exact_dedup(spark, folder):
    docs = read(spark, folder, "documents")
    result = exact_dedup.decide(docs, exact_dedup.fresh_index(docs), "documents")
    return result.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query
def op11_conversation_repair(spark, folder):
    hurt, copies = conversation_repair.damaged(read(spark, folder, "conversations"))
    return conversation_repair.Repair(hurt, copies=copies).report()


@query
def op12_language_id(spark, folder):
    docs = read(spark, folder, "documents")
    held_out = language_id.held_out(docs)
    model = language_id.learn(docs, ~held_out)
    return language_id.identify(docs, model, [docs["doc_id"], held_out.alias("held_out")])


@query
def op13_embedding_whitening(spark, folder):
    result = whitening.whiten(read(spark, folder, "embeddings"))
    return result.withColumn("deviation", F.col("deviation").try_cast("long"))
