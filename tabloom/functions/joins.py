"""Joins that no frequent key can hold up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than one in so many rows is looked up without a shuffle.
HOT_SHARE = 1000
#: A table of one row per key, of bounded width, is broadcast up to this many rows.
SMALL = 50_000


def attach(rows: DataFrame, groups: DataFrame, key: str, weight: str, how: str = "inner") -> DataFrame:
    """Rows joined with what is known of their key.

    ``groups`` has one row for each non-null key, of bounded width, and the
    number of rows of that key in ``weight``. A key that owns more than one in
    HOT_SHARE rows is broadcast: there are fewer than HOT_SHARE of them, whatever
    the size of the table. The other keys are joined by a shuffle, in which none
    of them is large. Rows without a key are never shuffled; a left join keeps
    them. Both frames are read more than once and should be written tables or
    cheap scans.
    """
    total = groups.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight) > F.lit(total / HOT_SHARE)
    hot, cold = groups.filter(is_hot), groups.filter(~is_hot)
    keyed = rows.filter(F.col(key).isNotNull()) if how == "left" else rows
    settled = keyed.join(F.broadcast(hot), key)
    rest = keyed.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, how)
    joined = settled.unionByName(rest)
    if how != "left":
        return joined
    return joined.unionByName(rows.filter(F.col(key).isNull()), allowMissingColumns=True)


def attach_any(rows: DataFrame, groups: DataFrame, key: str, weight: str, how: str = "inner") -> DataFrame:
    """As :func:`attach`; a counted small table is broadcast whole, so the rows are read once."""
    if groups.count() <= SMALL:
        return rows.join(F.broadcast(groups), key, how)
    return attach(rows, groups, key, weight, how)
