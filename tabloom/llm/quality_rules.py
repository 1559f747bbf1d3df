"""Quality rules learned as a decision list.

Statistics of a text are one projection of built-in expressions. Rules are
learned by sequential covering over the labelled rows: a rule grows by the
threshold with the highest information gain, is cut back on rows held out from
growing, and the rows it covers leave before the next rule is grown. Each step
is one grouped count over binned statistics, so the driver sees a few counts per
statistic and threshold, however many rows are labelled. The learned list is an
ordered conditional expression that any frame can be filtered with.

Defined cases: a null or empty text has no words and fails the base rules; a
label that is null or belongs to no document is not used, of several labels of
one document the lowest counts; without labels of both kinds no rule is learned
and the base rules decide alone; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import BLANKS, UPPER, let, texts
from tabloom.sources.workspace import materialized

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: What rules may compare with a threshold: shares, so that they hold for any length.
FEATURES = {
    "symbol_share": "n_symbols / n_words",
    "upper_share": "n_upper / word_chars",
    "shout_share": "n_shouts / n_words",
    "distinct_share": "n_distinct / n_words",
    "repeat_share": "n_repeat_words / n_words",
    "mean_word": "word_chars / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
}


def _count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("bigint")


def _repeated(words) -> Column:
    """Words inside five-word windows that occur twice or more, by 64-bit hashes of the windows."""

    def places(hashes):
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s):
            before = lambda x, j: (j > 0) & (F.get(s, j - 1)["h"] == x["h"])
            after = lambda x, j: (j + 1 < F.size(s)) & (F.get(s, j + 1)["h"] == x["h"])
            return F.transform(F.filter(s, lambda x, j: before(x, j) | after(x, j)), lambda x: x["i"])

        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last"))
        step = lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), i - a["last"]).cast("bigint")).alias("n"), i.alias("last")
        )
        return F.aggregate(F.sort_array(let(pairs, twice)), start, step)["n"]

    def count(hashes):
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(places(hashes))

    # the window at i is the words i+1 .. i+5 (element_at counts from 1)
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
    )
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("bigint")).otherwise(let(windows, count))


def text_statistics(text: Column) -> list[Column]:
    """The counts rules are made of, each a long."""

    def of_words(words):
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.size(F.array_distinct(words)).cast("bigint").alias("n_distinct"),
            _repeated(words).alias("n_repeat_words"),
        )

    def of_lines(lines):
        return (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")

    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.trim(x, F.lit(BLANKS))) > 0)
    return [
        let(F.array_remove(F.split(text, SPACES, -1), ""), of_words).alias("of_words"),
        F.length(F.translate(text, BLANKS, "")).cast("bigint").alias("word_chars"),
        _count_of(text, SYMBOLS).alias("n_symbols"),
        let(lines, of_lines).alias("n_dup_lines"),
        (_count_of(text, "\n") + 1).alias("n_lines"),
        _count_of(text, UPPER).alias("n_upper"),
        _count_of(text, "!").alias("n_shouts"),
    ]


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the statistics of each row."""
    counted = texts(docs, id_col, text_col).select("doc_id", *text_statistics(F.col("text")))
    return counted.select("doc_id", "of_words.*", *[c for c in counted.columns if c not in ("doc_id", "of_words")])


def base_failed() -> Column:
    """Too short, or more than a fifth of it repeats."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _feature(name: str) -> Column:
    return F.try_divide(*[F.col(c) for c in FEATURES[name].split(" / ")])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = _feature(self.feature)
        return F.coalesce(value > self.threshold if self.above else value <= self.threshold, F.lit(False))

    def __str__(self):
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


def _all(conditions) -> Column:
    together = F.lit(True)
    for condition in conditions:
        together = together & condition
    return together


def verdict(rules: list[tuple[Condition, ...]]) -> Column:
    """True for rows that no rule rejects; the rules are tried in order."""
    ordered = F
    for rule in rules:
        ordered = ordered.when(_all([c.column() for c in rule]), F.lit(False))
    return ordered.otherwise(F.lit(True)) if rules else F.lit(True)


def kept(rules) -> Column:
    return ~base_failed() & verdict(rules)


def _thresholds(labelled: DataFrame, quantiles: int) -> dict[str, list[float]]:
    """Candidate cuts of each statistic: half-way between quantiles of the accepted and of the rejected rows."""
    shares = [i / quantiles for i in range(quantiles + 1)]
    found = labelled.groupBy("bad").agg(
        *[F.percentile_approx(_feature(f), shares, 2000).alias(f) for f in FEATURES]
    ).collect()
    seen = {f: sorted({float(v) for row in found for v in (row[f] or [])}) for f in FEATURES}
    return {f: [(a + b) / 2 for a, b in zip(v, v[1:])] for f, v in seen.items()}


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else -math.inf


def learn_rules(
    statistics: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    max_rules: int = 8,
    max_conditions: int = 3,
    min_precision: float = 0.9,
    min_share: float = 0.005,
    quantiles: int = 20,
) -> list[tuple[Condition, ...]]:
    """An ordered list of conjunctions that describe rejected rows (label 0).

    Learns from every labelled row that passes the base rules. A rule has to
    cover ``min_share`` of the rejected rows and to be right for
    ``min_precision`` of what it covers, in the rows held out from growing too.
    """
    known = labels.select(labels[id_col].alias("doc_id"), labels[label_col].alias("label")).dropna()
    known = known.groupBy("doc_id").agg((F.min("label") == 0).alias("bad"))
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    labelled = statistics.filter(~base_failed()).join(known, "doc_id")
    labelled = materialized(
        labelled.select("bad", held_out.alias("held_out"), *[c for c in statistics.columns if c != "doc_id"]), "labelled"
    )
    cuts = _thresholds(labelled, quantiles)
    # the place of a value among the cuts: value > cuts[k] if and only if place > k
    place = lambda f: F.coalesce(
        F.aggregate(
            F.array(*[F.lit(c) for c in cuts[f]]), F.lit(0), lambda a, c: a + F.when(_feature(f) > c, 1).otherwise(0)
        ),
        F.lit(0),
    )
    used = [f for f in FEATURES if cuts[f]]
    if not used:
        return []
    placed = materialized(labelled.select("bad", "held_out", *[place(f).alias(f) for f in used]), "labelled-places")

    def holds(rule) -> Column:
        return _all([(F.col(f) > k) if above else (F.col(f) <= k) for f, above, k in rule])

    def counts(rows: DataFrame) -> dict:
        pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("place")) for f in used])).alias("x")
        got = rows.select("bad", "held_out", pairs).groupBy("x.f", "x.place", "bad", "held_out").count().collect()
        table: dict = {f: {} for f in used}
        for r in got:
            cell = table[r["f"]].setdefault(r["place"], [0, 0, 0, 0])
            cell[2 * r["held_out"] + (not r["bad"])] += r["count"]
        return table

    def totals(table) -> list[int]:
        return [sum(cell[i] for cell in table[used[0]].values()) for i in range(4)]

    remaining, rules = placed, []
    first = totals(counts(placed))
    enough = max(1, min_share * (first[0] + first[2]))
    while len(rules) < max_rules:
        rule, rows, path = [], remaining, []
        table = counts(rows)
        p0, n0, _, _ = totals(table)
        while p0 and n0 and len(rule) < max_conditions:
            best = None
            for f in used:
                cell_at = sorted(table[f].items())
                for k in range(len(cuts[f])):
                    above = [sum(c[i] for place_, c in cell_at if place_ > k) for i in range(4)]
                    below = [sum(c[i] for place_, c in cell_at if place_ <= k) for i in range(4)]
                    for side, cell in ((True, above), (False, below)):
                        gain = _gain(cell[0], cell[1], p0, n0)
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, (f, side, k), cell)
            if best is None:
                break
            rule.append(best[1])
            path.append(best[2])
            p0, n0 = best[2][:2]
            if n0 and len(rule) < max_conditions:
                rows = rows.filter(holds(rule[-1:]))
                table = counts(rows)
        if not rule:
            break
        # cut back to the prefix that is worth most in the held-out rows
        worth = [(c[2] - c[3]) / (c[2] + c[3]) if c[2] + c[3] else -1.0 for c in path]
        length = max(range(len(path)), key=lambda i: (worth[i], -i)) + 1
        p, n, hp, hn = path[length - 1]
        right = p + hp >= min_precision * (p + n + hp + hn) and hp >= min_precision * (hp + hn)
        if not right or p + hp < enough:
            break
        rules.append(tuple(rule[:length]))
        remaining = remaining.filter(~holds(rule[:length]))
    return [tuple(Condition(f, above, cuts[f][k]) for f, above, k in rule) for rule in rules]


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **learning) -> DataFrame:
    """One row per document: the statistics, ``base_failed`` and ``kept``. The texts are read once."""
    statistics = materialized(with_statistics(docs, id_col, text_col), "text-statistics")
    rules = learn_rules(statistics, labels, **learning)
    return statistics.withColumns({"base_failed": base_failed(), "kept": kept(rules)})


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **learning) -> DataFrame:
    """The rows of ``docs`` that pass base rules and learned rules, with all their columns.

    Only numbers meet the labels; the texts are filtered where they are read.
    """
    rules = learn_rules(materialized(with_statistics(docs, id_col, text_col), "text-statistics"), labels, **learning)
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("whole"), *text_statistics(text))
    counts = [c for c in whole.columns if c not in ("whole", "of_words")]
    return whole.select("whole", "of_words.*", *counts).filter(kept(rules)).select("whole.*")
