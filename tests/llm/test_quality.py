"""Learned rules, the quality classifier, and the pipeline."""

import math
from collections import Counter, defaultdict

import brute
import corpus_pipeline
import numpy as np
import pytest
from conftest import ODD, pairs
from pyspark.sql import functions as F

from tabloom.functions import joins
from tabloom.llm import quality_classifier, quality_rules, registered
from tabloom.sources.workspace import materialized

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _counted(rows):
    for i, t in rows:
        c = brute.quality_counts(t)
        yield i, *[c[k] for k in COUNTS], c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]


def test_statistics_of_odd_rows(odd, odd_labels):
    got = quality_rules.judge(odd, odd_labels)
    assert Counter(map(tuple, got.select("doc_id", *COUNTS, "base_failed").collect())) == Counter(
        _counted([(i, t) for i, t, *_ in ODD])
    )
    assert got.filter("base_failed AND kept").count() == 0
    none = odd_labels.limit(0)
    assert quality_rules.judge(odd, none).filter("kept = base_failed").count() == 0
    assert quality_rules.judge(odd.limit(0), odd_labels).count() == 0
    kept = quality_rules.keep_good(odd, odd_labels)
    assert kept.schema.names == odd.schema.names
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in got.filter("kept").collect())


def test_rules_query_on_the_table(spark, tables, documents, labels):
    result = registered.op9_quality_rules(spark, tables)
    plan = result._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert Counter(map(tuple, result.select("doc_id", *COUNTS, "base_failed").collect())) == Counter(
        _counted(pairs(documents))
    )
    judged = result.join(labels, "doc_id")
    assert judged.filter("quality = 1 AND NOT base_failed AND NOT kept").count() == 0
    assert judged.filter("quality = 0 AND kept").count() <= 1


def _learnable(spark, rule, n=3000):
    """Statistics of rows of which the given ones are bad."""
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(n):
        words, symbols, upper, distinct = 100, int(rng.integers(0, 60)), int(rng.integers(0, 200)), int(rng.integers(20, 100))
        rows.append((i, words, distinct, 0, 500, symbols, 0, 10, upper, 0))
        labels.append((i, 0 if rule(symbols / 100, upper / 500, distinct / 100) else 1))
    names = "doc_id long, n_words long, n_distinct long, n_repeat_words long, word_chars long, n_symbols long"
    names += ", n_dup_lines long, n_lines long, n_upper long, n_shouts long"
    return spark.createDataFrame(rows, names), spark.createDataFrame(labels, "doc_id long, quality int")


def test_rules_find_a_conjunction_and_a_second_rule(spark):
    statistics, labels = _learnable(spark, lambda s, u, d: (s > 0.4 and u > 0.2) or d < 0.3)
    rules = quality_rules.learn_rules(statistics, labels)
    assert 2 <= len(rules) <= 4
    used = {c.feature for rule in rules for c in rule}
    assert {"symbol_share", "upper_share", "distinct_share"} <= used
    judged = statistics.withColumn("kept", quality_rules.verdict(rules)).join(labels, "doc_id")
    good, bad = judged.filter("quality = 1"), judged.filter("quality = 0")
    assert good.filter("NOT kept").count() <= 0.02 * good.count()
    assert bad.filter("kept").count() <= 0.15 * bad.count()


def test_no_rule_from_noise(spark):
    statistics, labels = _learnable(spark, lambda s, u, d: False, n=400)
    assert quality_rules.learn_rules(statistics, labels) == []  # no rejected rows
    mixed = labels.withColumn("quality", (F.xxhash64("doc_id") % 2 == 0).cast("int"))
    assert quality_rules.learn_rules(statistics, mixed) == []


def test_classifier_on_the_table(spark, tables, labels):
    judged = materialized(registered.op2_quality_classifier(spark, tables), "judged").join(labels, "doc_id")
    assert judged.filter("quality = 1 AND NOT kept").count() == 0
    assert judged.filter("quality = 0 AND kept").count() <= 1


def test_classifier_on_rows_it_has_not_seen(spark, documents, labels):
    """Labels of two thirds; the others are judged well."""
    seen = labels.filter(F.xxhash64("doc_id") % 3 != 0)
    args = documents["source"], documents["lang"]
    judged = materialized(quality_classifier.classify(documents, seen, *args), "judged")
    rest = judged.join(labels.filter(F.xxhash64("doc_id") % 3 == 0), "doc_id")
    right = rest.filter("kept = (quality = 1)").count()
    assert right >= 0.93 * rest.count()


def test_shares_are_shrunk_towards_the_level_above(spark, documents, labels):
    """The posterior of each row from its evidence and its site, computed again without Spark."""
    args = documents["source"], documents["lang"]
    _, _, judged = quality_classifier._learned(documents, labels, *args, "quality", "doc_id", "text")
    judged = materialized(judged.select("doc_id", "host", "site", "evidence", "good"), "judged")
    sites, levels = quality_classifier.site_table(judged)
    got = {r["doc_id"]: r for r in quality_classifier._decided(joins.attach_any(judged, sites, "site", "path_n"), levels).collect()}
    hosts, paths = defaultdict(list), defaultdict(list)
    rows = judged.collect()
    for r in rows:
        hosts[bytes(r["host"])].append(r["good"])
        paths[bytes(r["site"])].append(r["good"])
    share = sum(r["good"] for r in rows) / len(rows)
    assert levels.share == pytest.approx(share)
    for r in rows:
        h, p = hosts[bytes(r["host"])], paths[bytes(r["site"])]
        host = (sum(h) - r["good"] + levels.host_strength * share) / (len(h) - 1 + levels.host_strength)
        path = (sum(p) - r["good"] + levels.path_strength * host) / (len(p) - 1 + levels.path_strength)
        odds = r["evidence"] + math.log(path / (1 - path))
        assert got[r["doc_id"]]["probability"] == pytest.approx(1 / (1 + math.exp(-odds)))


def test_strengths_follow_the_spread(spark):
    """Sites that differ much are believed; sites that differ by chance are not."""
    rng = np.random.default_rng(2)

    def table(rates):
        rows = [(bytearray([h]), bytearray([h, p]), float(rng.random() < r)) for h, r in enumerate(rates) for p in range(3) for _ in range(60)]
        return spark.createDataFrame(rows, "host binary, site binary, good double")

    _, apart = quality_classifier.site_table(materialized(table([0.1, 0.9] * 10), "apart"))
    _, alike = quality_classifier.site_table(materialized(table([0.5] * 20), "alike"))
    assert apart.host_strength < 10 < alike.host_strength
    assert apart.path_strength > 20


def test_large_site_tables_are_joined(spark, documents, labels, monkeypatch):
    args = documents["source"], documents["doc_id"].cast("string")  # a path for each document
    small = sorted(map(tuple, quality_classifier.classify(documents, labels, *args).collect()))
    monkeypatch.setattr(joins, "SMALL", 10)
    large = sorted(map(tuple, quality_classifier.classify(documents, labels, *args).collect()))
    assert [(r[0], r[5]) for r in small] == [(r[0], r[5]) for r in large]


def test_classifier_of_odd_rows(odd, odd_labels):
    args = odd["source"], odd["lang"]
    got = quality_classifier.classify(odd, odd_labels, *args).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, *_ in ODD)
    assert all(0 <= r["probability"] <= 1 for r in got)
    kept = quality_classifier.keep_good(odd, odd_labels, *args)
    assert kept.schema.names == odd.schema.names and kept.count() <= len(ODD)
    assert quality_classifier.classify(odd, odd_labels.limit(0), *args).filter("NOT kept").count() == 0
    none = odd.limit(0)
    assert quality_classifier.classify(none, odd_labels, none["source"], none["lang"]).count() == 0
    assert quality_classifier.keep_good(none, odd_labels, none["source"], none["lang"]).count() == 0


def test_pipeline_stage_by_stage(spark, tables, documents, labels):
    """Each stage against a plain version on all that its predecessor kept."""
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, materialized(stage(spark, docs, tables), "stage")
        assert docs.schema.names == documents.schema.names
        rows, kept = pairs(before), {r["doc_id"] for r in docs.collect()}
        if name == "quality rules":
            assert kept == {r["doc_id"] for r in registered.op9_quality_rules(spark, tables).filter("kept").collect()}
        elif name == "quality classifier":
            good = {r["doc_id"] for r in labels.filter("quality = 1").collect()}
            assert good & {i for i, _ in rows} <= kept
        elif name == "exact dedup":
            last = {}
            for i, t in sorted(rows):
                last[t] = i
            assert kept == set(last.values())
        else:
            assert kept == brute.kept_by_jaccard(rows)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, tables)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == kept
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert fill.filter("n <> end OR n > 2048").count() == 0
    assert packed.filter("octet_length(ids) <> 4 * length").count() == 0


def test_pipeline_of_odd_and_empty_tables(spark, odd, odd_labels, tmp_path):
    for name, frame in (("odd", odd), ("none", odd.limit(0))):
        folder = str(tmp_path / name)
        frame.write.parquet(f"{folder}/documents.parquet")
        odd_labels.write.parquet(f"{folder}/labels.parquet")
        result = corpus_pipeline.run(spark, folder)
        assert (result.count() == 0) == (name == "none")
