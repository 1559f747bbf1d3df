"""Row-level expressions; all stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; n/0 gives 0 and 0/0 stays missing."""
    n, d = numerator.cast("double"), denominator.cast("double")
    return F.when((d == 0) & (n != 0), F.lit(0.0)).otherwise(F.try_divide(n, d))


def clip(value: Column, low: float | None, high: float | None) -> Column:
    """Value limited to [low, high]; missing stays missing."""
    x = value.cast("double")
    if low is None or high is None:
        return x
    return F.when(x < F.lit(float(low)), F.lit(float(low))).when(x > F.lit(float(high)), F.lit(float(high))).otherwise(x)


def _in_bin(value: Column, edges: Sequence[float], i: int) -> Column:
    above = value > F.lit(float(edges[i]))
    return above & (value <= F.lit(float(edges[i + 1]))) if i + 1 < len(edges) else above


def bin_label(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed bin (edge, next edge]; the last bin is open above.

    Values at or below the first edge, and missing values, have no label.
    """
    out = F.when(_in_bin(value, edges, 0), F.lit(labels[0]))
    for i in range(1, len(labels)):
        out = out.when(_in_bin(value, edges, i), F.lit(labels[i]))
    return out


def bin_flags(value: Column, edges: Sequence[float], labels: Sequence[str], prefix: str) -> list[Column]:
    """One 0/1 column per bin, also for bins no value falls into."""
    return [
        F.coalesce(_in_bin(value, edges, i).cast("int"), F.lit(0)).alias(f"{prefix}_{label}")
        for i, label in enumerate(labels)
    ]


def row_sum(values: Sequence[Column]) -> Column:
    """Sum over the columns of a row, missing counted as 0."""
    total = F.lit(0)
    for value in values:
        total = total + F.coalesce(value, F.lit(0))
    return total


def recoded(value: Column, mapping: Mapping) -> Column:
    """Value looked up in the mapping; anything else becomes missing."""
    out = None
    for key, new in mapping.items():
        test = value == F.lit(key)
        out = F.when(test, F.lit(new)) if out is None else out.when(test, F.lit(new))
    return out if out is not None else F.lit(None)


def hash_number(parts: Sequence[Column], digits: int = 13) -> Column:
    """A reproducible number from the md5 of the parts; 13 hex digits fit a double exactly."""
    text = F.concat_ws("\u0001", *[F.coalesce(p.cast("string"), F.lit("\u0000")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")
