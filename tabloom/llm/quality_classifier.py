"""Quality of documents by hierarchical empirical Bayes.

A document classifier (naive Bayes over binned text statistics, learned from all
labelled rows by one grouped count, its statistics weighted by logistic
regression because they depend on each other) gives each document log odds.
Documents are
grouped by host and by path within a host; each group's share of good documents
is estimated from the labels of its documents, or from the classifier where
there is none. A path is shrunk towards its host and a host towards the whole
table, by strengths that the method of moments finds from how much hosts and
paths differ: a site with few documents says little. A document does not count
for its own group. Its log odds and those of its site together decide.

Only grouped aggregates and built-in expressions are used. The site table is
broadcast if its rows, of fixed width, are counted and few; otherwise its largest
sites are, and the rest is joined by a shuffle.

Defined cases: a null or empty text has no shares and falls into bins of its
own; a null host or path is a site like any other; null labels are not used, of
several labels of one document the lowest counts; with labels of only one kind
or none the evidence is zero and everything is kept; repeated rows count as
documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.joins import attach, attach_any
from tabloom.llm.common import BLANKS, UPPER, let
from tabloom.sources.workspace import materialized

QUANTILES = 20
SYMBOLS = "#*$%&|<>"

FEATURES = ["symbol_share", "upper_share", "shout_share", "distinct_share", "stutter_share"]


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def evidence_features(text: Column) -> Column:
    """A struct of the statistics the classifier looks at; shares are null without words."""

    def of_words(words):
        chars = F.length(F.translate(text, BLANKS, ""))
        count = lambda characters: F.length(text) - F.length(F.translate(text, characters, ""))
        n = F.size(words)
        return F.struct(
            _share(count(SYMBOLS), n).alias("symbol_share"),
            _share(count(UPPER), chars).alias("upper_share"),
            _share(count("!"), n).alias("shout_share"),
            _share(F.size(F.array_distinct(words)), n).alias("distinct_share"),
            _share(F.size(F.filter(words, lambda w, i: F.get(words, i - 1) == w)), n).alias("stutter_share"),
        )

    return let(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), ""), of_words)


@dataclass(frozen=True)
class Evidence:
    """Cuts of each statistic, and the log odds of good against bad of each bin; -1 is the bin of nulls.

    Statistics depend on each other, so each has a weight.
    """

    cuts: dict[str, list[float]]
    odds: dict[str, dict[int, float]]
    weights: dict[str, float] = field(default_factory=dict)
    shift: float = 0.0


def _nested(value: Column, cuts: list[float], results: list) -> Column:
    """The result of the interval a value lies in, by halving, so that few comparisons are made."""
    if not cuts:
        return F.lit(results[0])
    middle = len(cuts) // 2
    return F.when(value > cuts[middle], _nested(value, cuts[middle + 1 :], results[middle + 1 :])).otherwise(
        _nested(value, cuts[:middle], results[: middle + 1])
    )


def learn_evidence(labelled: DataFrame, quantiles: int = QUANTILES) -> Evidence:
    """From rows with ``features`` and a boolean ``good``."""
    shares = [i / quantiles for i in range(quantiles + 1)]
    found = labelled.groupBy("good").agg(
        *[F.percentile_approx(F.col("features")[f], shares, 2000).alias(f) for f in FEATURES], F.count(F.lit(1)).alias("n")
    ).collect()
    totals = {row["good"]: row["n"] for row in found}
    if len(totals) < 2:
        return Evidence({f: [] for f in FEATURES}, {})
    seen = {f: sorted({float(v) for row in found for v in (row[f] or [])}) for f in FEATURES}
    cuts = {f: [(a + b) / 2 for a, b in zip(v, v[1:])] for f, v in seen.items()}
    places = [
        F.struct(
            F.lit(f).alias("f"),
            F.when(F.col("features")[f].isNull(), F.lit(-1))
            .otherwise(_nested(F.col("features")[f], cuts[f], list(range(len(cuts[f]) + 1))))
            .alias("bin"),
        )
        for f in FEATURES
    ]
    rows = labelled.select("good", F.explode(F.array(*places)).alias("x")).groupBy("x.f", "x.bin", "good").count().collect()
    n = {(r["f"], r["bin"], r["good"]): r["count"] for r in rows}
    odds: dict = {}
    for f in FEATURES:
        bins = range(-1, len(cuts[f]) + 1)
        share = lambda b, good: (n.get((f, b, good), 0) + 1) / (totals[good] + len(bins))  # noqa: B023, E731
        odds[f] = {b: math.log(share(b, True) / share(b, False)) for b in bins}
    scores = materialized(
        labelled.select(F.col("good").cast("double").alias("good"), *_scores(Evidence(cuts, odds), F.col("features"))),
        "feature-scores",
    )
    weights, intercept = _logistic(scores)
    return Evidence(cuts, odds, weights, intercept - math.log(totals[True] / totals[False]))


def _logistic(scores: DataFrame, steps: int = 12, ridge: float = 1.0) -> tuple[dict[str, float], float]:
    """Weights of the scores by Newton steps, each one aggregate; the prior is a weight of one each."""
    names, x = [*FEATURES, "one"], np.append(np.ones(len(FEATURES)), 0.0)
    scores = scores.withColumn("one", F.lit(1.0))
    prior = np.append(np.full(len(FEATURES), ridge), 1e-3)
    for _ in range(steps):
        margin = sum((F.col(n) * float(v) for n, v in zip(names[1:], x[1:])), F.col(names[0]) * float(x[0]))
        p = 1 / (1 + F.exp(-F.least(F.greatest(margin, F.lit(-30.0)), F.lit(30.0))))
        rows = scores.withColumn("p", p).withColumn("w", F.col("p") * (1 - F.col("p")))
        slope = [F.sum((F.col("good") - F.col("p")) * F.col(n)) for n in names]
        bend = [F.sum(F.col("w") * F.col(m) * F.col(n)) for m in names for n in names]
        got = np.array(list(rows.agg(*slope, *bend).first()), float)
        k = len(names)
        step = np.linalg.solve(
            got[k:].reshape(k, k) + np.diag(prior), got[:k] - prior * (x - np.append(np.ones(k - 1), 0.0))
        )
        x = x + step / max(1.0, np.abs(step).max())  # no step longer than one
        if np.abs(step).max() < 1e-6:
            break
    return dict(zip(FEATURES, x.tolist())), float(x[-1])


def _scores(evidence: Evidence, features: Column) -> list[Column]:
    """The log odds of each statistic's bin."""
    found = []
    for f in FEATURES:
        of_bins = [evidence.odds[f][b] for b in range(len(evidence.cuts[f]) + 1)]
        known = _nested(features[f], evidence.cuts[f], of_bins)
        found.append(F.when(features[f].isNull(), F.lit(evidence.odds[f][-1])).otherwise(known).alias(f))
    return found


def log_odds(evidence: Evidence, features: Column) -> Column:
    total = F.lit(evidence.shift)
    if evidence.odds:
        for f, score in zip(FEATURES, _scores(evidence, features)):
            total = total + F.lit(evidence.weights[f]) * score
    return total


def _key(*columns: Column) -> Column:
    """128 bits for any values, nulls among them; sites have fixed width however long their names are."""
    return F.unhex(F.md5(F.to_json(F.struct(*[c.cast("string").alias(f"k{i}") for i, c in enumerate(columns)]))))


def _strength(between: float, groups: float, within: float, rows: float, squares: float) -> float:
    """How many documents of evidence the level above is worth (method of moments)."""
    spread = rows - squares
    variance = (between - (groups - 1) * within) / spread if spread > 0 else 0.0
    return min(1e6, max(1.0, within / variance - 1)) if variance > 0 else 1e6


@dataclass(frozen=True)
class Levels:
    share: float
    host_strength: float
    path_strength: float


def site_table(judged: DataFrame) -> tuple[DataFrame, Levels]:
    """Documents and good documents of each path and its host, and the strengths of both levels.

    ``judged`` has ``site`` and ``host`` keys and ``good``, the chance of being good.
    """
    paths = judged.groupBy("host", "site").agg(F.sum("good").alias("path_good"), F.count(F.lit(1)).alias("path_n"))
    paths = materialized(paths, "paths")
    hosts = materialized(
        paths.groupBy("host").agg(
            F.sum("path_good").alias("host_good"), F.sum("path_n").alias("host_n"), F.count(F.lit(1)).alias("n_paths")
        ),
        "hosts",
    )
    sites = materialized(attach(paths, hosts, "host", "n_paths").select("site", "path_good", "path_n", "host_good", "host_n"), "sites")
    total = hosts.agg(F.sum("host_good"), F.sum("host_n"), F.count(F.lit(1)), F.sum(F.col("host_n") * F.col("host_n"))).first()
    if not total[1]:
        return sites, Levels(0.5, 1.0, 1.0)
    share, n = total[0] / total[1], float(total[1])
    within = max(share * (1 - share), 1e-9)
    host_rate = F.col("host_good") / F.col("host_n")
    between = hosts.agg(F.sum(F.col("host_n") * (host_rate - share) ** 2)).first()[0]
    inner = sites.agg(
        F.sum(F.col("path_n") * (F.col("path_good") / F.col("path_n") - host_rate) ** 2),
        F.count(F.lit(1)),
        F.sum(F.col("path_n") * F.col("path_n") / F.col("host_n")),
    ).first()
    hosts_worth = _strength(between, total[2], within, n, total[3] / n)
    paths_worth = _strength(inner[0], inner[1] - total[2] + 1, within, n, inner[2])
    return sites, Levels(share, hosts_worth, paths_worth)


def _decided(rows: DataFrame, levels: Levels) -> DataFrame:
    """Adds host and path shares without the row itself, ``probability`` and its parts."""
    own, share = F.col("good"), F.lit(levels.share)
    host = (F.col("host_good") - own + levels.host_strength * share) / (F.col("host_n") - 1 + levels.host_strength)
    rows = rows.withColumn("host_share", host)
    path = (F.col("path_good") - own + levels.path_strength * F.col("host_share")) / (
        F.col("path_n") - 1 + levels.path_strength
    )
    rows = rows.withColumn("path_share", path)
    bounded = F.least(F.greatest("path_share", F.lit(1e-6)), F.lit(1 - 1e-6))
    odds = F.col("evidence") + F.log(bounded / (1 - bounded))
    return rows.withColumn("probability", 1 / (1 + F.exp(-odds)))


def _learned(docs, labels, host, path, label_col, id_col, text_col):
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(
        docs[id_col].alias("doc_id"), _key(host).alias("host"), _key(host, path).alias("site"),
        evidence_features(text).alias("features"),
    )
    rows = materialized(rows, "evidence-features")
    known = labels.select(labels[id_col].alias("doc_id"), labels[label_col].alias("label")).dropna()
    known = known.groupBy("doc_id").agg((F.min("label") != 0).alias("labelled_good"))
    rows = materialized(rows.join(known, "doc_id", "left"), "labelled-features")
    labelled = rows.filter(F.col("labelled_good").isNotNull()).withColumn("good", F.col("labelled_good"))
    evidence = learn_evidence(labelled)
    share = labelled.agg((F.sum(F.col("good").cast("int")) + 1) / (F.count(F.lit(1)) + 2)).first()[0]
    prior = math.log(share / (1 - share)) if share else 0.0
    judged = rows.withColumn("evidence", log_odds(evidence, F.col("features")))
    believed = 1 / (1 + F.exp(-(F.col("evidence") + prior)))
    judged = judged.withColumn("good", F.coalesce(F.col("labelled_good").cast("double"), believed))
    return evidence, prior, judged


def classify(
    docs: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    threshold: float = 0.5,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id``, ``evidence`` (log odds), ``host_share``, ``path_share``, ``probability``, ``kept``."""
    _, _, judged = _learned(docs, labels, host, path, label_col, id_col, text_col)
    judged = materialized(judged.select("doc_id", "host", "site", "evidence", "good"), "judged")
    sites, levels = site_table(judged)
    decided = _decided(attach_any(judged, sites, "site", "path_n"), levels)
    return decided.select(
        "doc_id", "evidence", "host_share", "path_share", "probability", (F.col("probability") >= threshold).alias("kept")
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    threshold: float = 0.5,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that are good enough, with all their columns.

    A row's own share in its site is the classifier's here, so that no label has
    to meet the texts.
    """
    evidence, prior, judged = _learned(docs, labels, host, path, label_col, id_col, text_col)
    sites, levels = site_table(judged)
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    whole = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("whole"), _key(host, path).alias("site"),
        evidence_features(text).alias("features"),
    )
    whole = whole.withColumn("evidence", log_odds(evidence, F.col("features"))).drop("features")
    whole = whole.withColumn("good", 1 / (1 + F.exp(-(F.col("evidence") + prior))))
    return _decided(attach_any(whole, sites, "site", "path_n"), levels).filter(F.col("probability") >= threshold).select("whole.*")
