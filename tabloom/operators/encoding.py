"""Text columns as numbers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, literal, quoted, string_columns
from ..functions.joins import attach_any
from ..functions.ordering import with_running_totals
from ..functions.quantiles import group_key
from ..sources.workspace import materialized
from .profiling import value_counts, value_hashes

MAX_ONE_HOT = 50  # more distinct values than this get codes instead of flags
APPROXIMATE = 2  # an estimate above so many times the limit means more values than the limit


def encode_binary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Yes as 1 and No as 0."""
    codes = {c: F.expr(f"CASE {quoted(c)} WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END") for c in columns}
    return df.withColumns(codes) if codes else df


@dataclass
class TextFacts:
    """What two small jobs tell about text columns: table size, columns with gaps, categories."""

    rows: int
    incomplete: list[str]
    categories: dict[str, list[str]]


def scan_texts(df: DataFrame, columns: Sequence[str], limit: int = MAX_ONE_HOT) -> TextFacts:
    """Sorted distinct values of the columns that have at most ``limit``.

    An approximate count, which needs no shuffle, sets aside the columns that
    surely have more. The values of the others are counted by hash, and fetched
    only for columns that have no more than the limit.
    """
    rows, *found = df.agg(
        F.count("*"),
        *[F.expr(f"count_if({quoted(c)} IS NULL) AS n{i}") for i, c in enumerate(columns)],
        *[F.expr(f"hll_sketch_estimate(hll_sketch_agg({quoted(c)})) AS d{i}") for i, c in enumerate(columns)],
    ).first()
    incomplete = [c for c, n in zip(columns, found) if n]
    estimates = dict(zip(columns, found[len(columns) :]))
    few = [c for c in columns if (estimates[c] or 0) <= APPROXIMATE * limit + 100]
    categories = {c: [] for c in few}
    if few:
        hashes = value_hashes(df, few)
        sizes = hashes.groupBy("column_name").agg(F.count("*").alias("n")).collect()
        categories = {c: v for c, v in categories.items() if {r.column_name: r.n for r in sizes}.get(c, 0) <= limit}
    if categories:
        for row in value_counts(df, list(categories)).select("column_name", "value").collect():
            categories[row.column_name].append(row.value)
    return TextFacts(rows, incomplete, {c: sorted(v) for c, v in categories.items()})


def fit_categories(df: DataFrame, columns: Sequence[str], limit: int = MAX_ONE_HOT) -> dict[str, list[str]]:
    """Sorted distinct values of the columns that have at most ``limit``."""
    return scan_texts(df, columns, limit).categories


def route_cardinality(df: DataFrame, columns: Sequence[str] | None = None, limit: int = MAX_ONE_HOT) -> DataFrame:
    """Distinct values and the encoding chosen per text column."""
    columns = string_columns(df) if columns is None else list(columns)
    distinct = value_hashes(df, columns).groupBy("column_name").agg(F.count("*").alias("distinct_count"))
    return distinct.withColumn("encoding", F.when(F.col("distinct_count") > limit, "label").otherwise("one_hot"))


def label_dictionary(df: DataFrame, column: str) -> DataFrame:
    """Every distinct value with its 0-based position in ascending order, and its frequency."""
    counts = value_counts(df, [column]).select("value", "value_count")
    return with_running_totals(counts, ["value"], {"code": F.lit(1)}).select(
        "value", "value_count", F.col("code").cast("bigint").alias("code")
    )


def _lookup(df: DataFrame, column: str, dictionary: DataFrame, result: str) -> DataFrame:
    """The frame with ``_found``: the dictionary's result for the column's value.

    Values are compared by 128 bits of their hash, so a dictionary row has a
    bounded width however long its text is. Rows with the most frequent values
    (fewer than a thousand, by definition) and rows without a value are not
    shuffled at all; the others are joined by hash.
    """
    hashed = dictionary.select(
        F.unhex(F.md5("value")).alias("_key"), F.col(result).alias("_found"), F.col("value_count").alias("_weight")
    )
    rows = df.withColumn("_key", F.unhex(F.md5(col(column).cast("string"))))
    return attach_any(rows, hashed, "_key", "_weight", "left").drop("_key", "_weight")


def encode_label(df: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """The column replaced by its codes."""
    keep = [col(c) if c != column else F.col("_found").alias(column) for c in df.columns]
    return _lookup(df, column, dictionary, "code").select(*keep)


def one_hot_names(column: str, categories: Sequence[str]) -> list[str]:
    """Names of the flags; the first category has none."""
    return [f"{column}_{value}" for value in sorted(categories)[1:]]


def encode_one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """Each column replaced by 0/1 flags for all but its first category.

    Flags follow the other columns, in column and category order.
    """
    flags = [
        F.expr(f"CAST(coalesce({quoted(c)} = {literal(v)}, false) AS int) AS {quoted(f'{c}_{v}')}")
        for c, values in categories.items()
        for v in sorted(values)[1:]
    ]
    return df.select(*[col(c) for c in df.columns if c not in categories], *flags)


@dataclass
class Encoding:
    """What was learned about the text columns."""

    binary: list[str] = field(default_factory=list)
    labels: dict[str, DataFrame] = field(default_factory=dict)
    one_hot: dict[str, list[str]] = field(default_factory=dict)


def fit_encoding(df: DataFrame, keys: Iterable[str] = (), facts: TextFacts | None = None) -> Encoding:
    """Yes/No columns, columns with many values, and the categories of the rest.

    Key columns identify rows and are never encoded. A complete column with no
    category but Yes and No is a binary one.
    """
    texts = string_columns(df, keys)
    facts = facts or scan_texts(df, texts)
    found = facts.categories
    binary = [c for c in texts if c in found and c not in facts.incomplete and set(found[c]) <= {"Yes", "No"}]
    rest = [c for c in texts if c not in binary]
    labels = {c: label_dictionary(df, c) for c in rest if c not in found}
    return Encoding(binary, labels, {c: found[c] for c in rest if c in found})


def encode(df: DataFrame, encoding: Encoding) -> DataFrame:
    """Binary, label and one-hot encoding as fitted."""
    out = encode_binary(df, encoding.binary)
    for column, dictionary in encoding.labels.items():
        out = encode_label(out, column, dictionary)
    return encode_one_hot(out, encoding.one_hot)


@dataclass
class TargetMeans:
    """Smoothed target mean per category, and the mean over all rows."""

    table: DataFrame
    overall: float | None


def fit_target_means(df: DataFrame, column: str, target: str, weight: float = 10.0) -> TargetMeans:
    """Mean of a 0/1 target per category, pulled towards the overall mean.

    The pull is as strong as ``weight`` more rows with the overall mean. Fit it
    on training rows only.
    """
    overall = df.agg(F.avg(col(target).cast("double"))).first()[0]
    groups = df.groupBy(col(column).alias("value")).agg(
        F.count(col(target)).alias("value_count"), F.sum(col(target).cast("double")).alias("_total")
    )
    mean = (F.col("_total") + F.lit(overall) * weight) / (F.col("value_count") + weight)
    return TargetMeans(groups.select("value", "value_count", mean.alias("encoded")), overall)


def encode_target(df: DataFrame, column: str, means: TargetMeans) -> DataFrame:
    """The column replaced by its category's mean; other values get the overall mean."""
    found = F.coalesce("_found", F.lit(means.overall)).alias(column)
    known = means.table.where(F.col("value").isNotNull())
    return _lookup(df, column, known, "encoded").select(*[found if c == column else col(c) for c in df.columns])


def _pull(rows: Column, hits: Column, squares: Column, groups: Column, weighted: Column) -> Column:
    """How many rows of the overall mean a category is pulled by, from how much categories differ.

    The method of moments: the spread of category means beyond what chance gives
    them. Where there is none, the pull is infinite (null here).
    """
    share = hits / rows
    chance = share * (1 - share)
    beyond = weighted - rows * share * share - (groups - 1) * chance
    between = F.try_divide(beyond, rows - F.try_divide(squares, rows))
    return F.when(between > 0, chance / between)


def encode_target_out_of_fold(
    df: DataFrame, column: str, target: str, fold: str, weight: float | None = None
) -> DataFrame:
    """The column replaced by its category's target mean over the rows of all other folds.

    No row sees its own target, nor has one of its fold had a part in anything it
    is given: totals of the fold are taken off those of all rows, and so the
    overall mean and, without a ``weight``, the strength of the pull towards it
    are of the other folds as well. Rows are grouped once, by category and fold;
    the table of means is joined without moving rows of frequent categories.
    Missing categories, and those that other folds do not have, get the overall
    mean; a missing target counts for nothing.
    """
    y = col(target).cast("double")
    name, missing = group_key(col(column)), col(column).isNull()
    cells = materialized(
        df.groupBy(F.when(~missing, name).alias("_value"), col(fold).alias("_fold")).agg(
            F.count(y).alias("n"), F.coalesce(F.sum(y), F.lit(0.0)).alias("t"), F.count(F.lit(1)).alias("_rows")
        ),
        "target-cells",
    )
    folds = cells.groupBy("_fold").agg(F.sum("n").alias("fold_n"), F.sum("t").alias("fold_t"))
    whole = cells.agg(F.sum("n").alias("all_n"), F.sum("t").alias("all_t"))
    # one row per fold
    outside = folds.crossJoin(F.broadcast(whole)).select(
        "_fold", (F.col("all_n") - F.col("fold_n")).alias("rows"), (F.col("all_t") - F.col("fold_t")).alias("hits")
    )
    values = cells.where("_value IS NOT NULL").groupBy("_value").agg(F.sum("n").alias("v_n"), F.sum("t").alias("v_t"))
    every = values.crossJoin(F.broadcast(folds.select("_fold")))  # as many rows per category as there are folds
    own = cells.where("_value IS NOT NULL").select("_value", "_fold", F.col("n").alias("own_n"), F.col("t").alias("own_t"), "_rows")
    others = every.join(own, ["_value", "_fold"], "left").select(
        "_value",
        "_fold",
        "_rows",
        (F.col("v_n") - F.coalesce("own_n", F.lit(0))).alias("o_n"),
        (F.col("v_t") - F.coalesce("own_t", F.lit(0.0))).alias("o_t"),
    )
    others = materialized(others, "target-of-others")
    known = others.where("o_n > 0").groupBy("_fold").agg(
        F.sum(F.col("o_n") * F.col("o_n")).alias("squares"),
        F.count(F.lit(1)).alias("groups"),
        F.sum("o_n").alias("g_n"),
        F.sum("o_t").alias("g_t"),
        F.sum(F.col("o_t") * F.col("o_t") / F.col("o_n")).alias("weighted"),
    )
    pull = F.lit(weight) if weight is not None else _pull(*map(F.col, ("g_n", "g_t", "squares", "groups", "weighted")))
    pulls = known.select("_fold", pull.cast("double").alias("pull"))
    settings = outside.join(F.broadcast(pulls), "_fold", "left")
    settings = materialized(settings.select("_fold", F.try_divide("hits", "rows").alias("overall"), "pull"), "target-folds")
    mean = (F.col("o_t") + F.col("overall") * F.col("pull")) / (F.col("o_n") + F.col("pull"))
    key = F.unhex(F.md5(F.concat(F.col("_fold").cast("string"), F.lit(":"), F.col("_value"))))
    means = others.where("o_n > 0 AND _rows IS NOT NULL").join(F.broadcast(settings), "_fold").select(
        key.alias("_key"), F.coalesce(mean, F.col("overall")).alias("_found"), F.col("_rows").alias("_weight")
    )
    means = materialized(means, "target-means")
    marked = df.withColumns({"_value": F.when(~missing, name), "_fold": col(fold)}).withColumn("_key", key)
    met = attach_any(marked, means, "_key", "_weight", "left").join(F.broadcast(settings.select("_fold", "overall")), "_fold", "left")
    found = F.coalesce("_found", "overall").alias(column)
    return met.select(*[found if c == column else col(c) for c in df.columns])
