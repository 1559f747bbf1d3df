"""Exact order statistics in a few scans with bounded state.

Spark's ``percentile`` keeps every distinct value of a column in one task. Here
a value is found by narrowing, whatever the size of the table: a sketch proposes
two pivots around the wanted rank, the next scan counts exactly how many values
lie below, on and between them, and the search goes on in the part that holds
the rank; a part of few values is sorted. Each scan is one global aggregate for
all columns, so no data is shuffled, and heavy duplicates end a search as soon as
they become a pivot. Infinities are values like others.

Quantiles per group come from one range-partitioned order of (group, value)
counts, for any number of groups.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import materialized
from .columns import col, without_nan
from .joins import attach
from .ordering import with_running_totals

GATHER_ROWS = 20_000  # an interval this small is sorted inside the aggregate
SERIES_PER_SCAN = 16  # more series are handled in turns, each reading its own columns only
ACCURACY = 10_000  # sketch size; its rank error is 1 / ACCURACY of the interval
GRID = 500  # sketch points kept when the rank inside the interval is not known yet


@dataclass
class _Search:
    """One wanted order statistic and the open interval known to hold it."""

    series: str
    rank: int
    low: float | None = None
    high: float | None = None
    size: int | None = None
    pivots: tuple[float, float] | None = None
    share: float = 1.0  # of the interval, expected between the pivots
    value: float | None = None

    @property
    def is_small(self) -> bool:
        return self.size is not None and self.size <= GATHER_ROWS

    def between(self, low, high) -> str:
        tests = [f"{self.series} IS NOT NULL"]
        if low is not None:
            tests.append(f"{self.series} > {_number(low)}")
        if high is not None:
            tests.append(f"{self.series} < {_number(high)}")
        return " AND ".join(tests)

    def narrow(self, low, high, skipped: int, size: int | None) -> None:
        self.low, self.high, self.size = low, high, size
        self.rank -= skipped
        self.pivots = None


def _number(value: float) -> str:
    if math.isinf(value):
        return f"CAST('{'' if value > 0 else '-'}Infinity' AS double)"
    return f"({float(value)!r}D)"


def _sketch(test: str, series: str, points: str) -> str:
    return f"percentile_approx(CASE WHEN {test} THEN {series} END, array({points}), {ACCURACY})"


def _grid_points() -> str:
    return ", ".join(f"{i / GRID!r}D" for i in range(GRID + 1))


def _set_pivots(search: _Search, grid: Sequence[float]) -> None:
    at = search.rank / max(search.size - 1, 1) * GRID
    search.pivots = (grid[max(math.floor(at) - 1, 0)], grid[min(math.ceil(at) + 1, GRID)])
    search.share = 4 / GRID


def _advance(values: DataFrame, searches: list[_Search]) -> None:
    """One scan for all open searches."""
    wanted: dict[str, str] = {}

    def ask(expression: str) -> str:
        return wanted.setdefault(expression, f"m{len(wanted)}")

    gathered: dict[tuple, list[int]] = {}
    for s in searches:
        if s.is_small:
            gathered.setdefault((s.series, s.low, s.high), []).append(s.rank)

    replies = []
    for s in searches:
        if s.is_small:
            # ranks in the same interval, such as two neighbours, share its list
            ranks = gathered[s.series, s.low, s.high]
            first, length = min(ranks), max(ranks) - min(ranks) + 1
            listed = f"sort_array(collect_list(CASE WHEN {s.between(s.low, s.high)} THEN {s.series} END))"
            replies.append(("gather", ask(f"slice({listed}, {first + 1}, {length})"), s.rank - first))
        elif s.pivots is None:
            test = s.between(s.low, s.high)
            replies.append(("sketch", ask(f"count_if({test})"), ask(_sketch(test, s.series, _grid_points()))))
        else:
            a, b = s.pivots
            middle = s.between(a, b)
            counts = [
                ask(f"count_if({s.between(s.low, a)})"),
                ask(f"count_if({s.series} = {_number(a)})"),
                ask(f"count_if({middle})"),
                ask(f"count_if({s.series} = {_number(b)})"),
            ]
            # a sketch of the middle saves a scan later, unless the middle is about to be small
            large = s.size is None or s.size * s.share > GATHER_ROWS / 2
            grid = ask(_sketch(middle, s.series, _grid_points())) if large else None
            replies.append(("probe", counts, grid))

    row = values.agg(*[F.expr(e).alias(name) for e, name in wanted.items()]).first()
    for s, (kind, first, grid) in zip(searches, replies):  # for a list, grid is the place in it
        if kind == "gather":
            s.value = row[first][grid]
        elif kind == "sketch":
            s.size = row[first]
            _set_pivots(s, row[grid])
        else:
            a, b = s.pivots
            below, on_a, middle, on_b = (row[name] for name in first)
            if a == b:
                on_b = 0
            if s.rank < below:
                s.narrow(s.low, a, 0, below)
            elif s.rank < below + on_a:
                s.value = a
            elif s.rank < below + on_a + middle:
                s.narrow(a, b, below + on_a, middle)
                if grid is not None:
                    _set_pivots(s, row[grid])
            elif s.rank < below + on_a + middle + on_b:
                s.value = b
            else:
                s.narrow(b, s.high, below + on_a + middle + on_b, None)


def _finish(values: DataFrame, searches: list[_Search]) -> None:
    while open_searches := [s for s in searches if s.value is None]:
        _advance(values, open_searches)


def _series_frame(df: DataFrame, series: Mapping[str, Column]) -> tuple[DataFrame, dict[str, str]]:
    names = {name: f"s{i}" for i, name in enumerate(series)}
    values = df.select(*[series[name].cast("double").alias(alias) for name, alias in names.items()])
    return values.select(*[without_nan(F.col(f.name), f.dataType).alias(f.name) for f in values.schema]), names


def between(a: float, b: float, share: float) -> float:
    """The value a share of the way from a to b; infinite ends stay infinite."""
    if a == b or share == 0:
        return a
    return a + (b - a) * share if math.isfinite(a) else a * (1 - share) + b * share


def quantiles(
    df: DataFrame,
    series: Mapping[str, Column],
    probs: Sequence[float],
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each series, missing values left out.

    A series is any numeric expression.
    """
    if not series:
        return {}
    if len(series) > SERIES_PER_SCAN:
        names = list(series)
        found = {}
        for i in range(0, len(names), SERIES_PER_SCAN):
            found |= quantiles(df, {name: series[name] for name in names[i : i + SERIES_PER_SCAN]}, probs)
        return found

    values, names = _series_frame(df, series)
    slack = 2 / ACCURACY
    near = [f"{min(max(p + d, 0.0), 1.0)!r}D" for p in map(float, probs) for d in (-slack, slack)]
    row = values.agg(
        *[F.expr(f"count({s}) AS n_{s}") for s in names.values()],
        *[F.expr(f"{_sketch('true', s, ', '.join(near))} AS q_{s}") for s in names.values()],
    ).first()

    searches: dict[tuple[str, int], _Search] = {}
    parts: dict[str, list[tuple[int, int, float] | None]] = {}
    for name, s in names.items():
        n, parts[name] = row[f"n_{s}"], []
        for i, p in enumerate(probs):
            if n == 0:
                parts[name].append(None)
                continue
            position = p * (n - 1)
            low, high = math.floor(position), math.ceil(position)
            for rank in (low, high):
                pivots = (row[f"q_{s}"][2 * i], row[f"q_{s}"][2 * i + 1])
                searches.setdefault((s, rank), _Search(s, rank, size=n, pivots=pivots, share=2 * slack))
            parts[name].append((low, high, position - low))
    _finish(values, list(searches.values()))

    def value(s, part):
        if part is None:
            return None
        low, high, share = part
        return between(searches[s, low].value, searches[s, high].value, share)

    return {name: [value(s, part) for part in parts[name]] for name, s in names.items()}


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict:
    """Quantiles of plain columns."""
    return quantiles(df, {c: col(c) for c in columns}, probs)


def ranked_values(
    df: DataFrame,
    series: Mapping[str, Column],
    ranks: Mapping[str, int],
    guesses: Mapping[str, tuple[int, float, float]] | None = None,
) -> dict[str, float]:
    """The value at a 0-based ascending rank of each series.

    A guess (size of the series, low, high) about where the value lies saves
    the first scan. It need not be right: it is checked like any other pivots.
    """
    values, names = _series_frame(df, {name: series[name] for name in ranks})
    searches = {name: _Search(names[name], rank) for name, rank in ranks.items()}
    for name, (size, low, high) in (guesses or {}).items():
        searches[name].size, searches[name].pivots, searches[name].share = size, (low, high), 0.0
    _finish(values, list(searches.values()))
    return {name: s.value for name, s in searches.items()}


def group_key(group: Column) -> Column:
    """A text that is equal for equal groups, of any type, and never null."""
    return F.to_json(F.struct(group.alias("g")))


def grouped_ranks(df: DataFrame, group: Column, value: Column, ranks: Mapping[str, Column]) -> DataFrame:
    """``key``, ``n`` and the value at each rank of every group.

    A rank is an expression of ``n``, the number of values of the group; values
    are ascending and the first has rank 0. Equal values of a group are counted
    before they are ordered, and the order is cut into ranges, so neither a large
    group nor a hot value meets one task, and groups may be many.
    """
    pairs = df.select(group_key(group).alias("key"), value.alias("v")).where("v IS NOT NULL")
    counts = pairs.groupBy("key", "v").agg(F.count(F.lit(1)).alias("m"))
    ordered = materialized(with_running_totals(counts, ["key", "v"], {"before": F.col("m")}), "ordered-values")
    sizes = ordered.groupBy("key").agg(
        F.min("before").alias("start"), F.sum("m").alias("n"), F.count(F.lit(1)).alias("entries")
    )
    placed = attach(ordered, materialized(sizes, "group-sizes"), "key", "entries")
    first = F.col("before") - F.col("start")
    picked = [
        F.max(F.when((first <= rank) & (rank < first + F.col("m")), F.col("v"))).alias(name) for name, rank in ranks.items()
    ]
    return placed.groupBy("key").agg(F.first("n").alias("n"), *picked)


def grouped_quantiles(df: DataFrame, group: Column, value: Column, probs: Mapping[str, float]) -> DataFrame:
    """``key`` (see :func:`group_key`) and interpolated quantiles of each group that has a value."""
    position = {name: (F.col("n") - 1) * F.lit(float(p)) for name, p in probs.items()}
    ranks = {f"low_{name}": F.floor(x) for name, x in position.items()}
    ranks |= {f"high_{name}": F.ceil(x) for name, x in position.items()}
    found = grouped_ranks(df, group, value.cast("double"), ranks)

    def quantile(name):
        low, high, share = F.col(f"low_{name}"), F.col(f"high_{name}"), position[name] - F.floor(position[name])
        infinite = F.abs(low) == F.lit(math.inf)
        return (
            F.when((low == high) | (share == 0), low)
            .when(infinite, low * (1 - share) + high * share)
            .otherwise(low + (high - low) * share)
            .alias(name)
        )

    return found.select("key", *[quantile(name) for name in probs])
