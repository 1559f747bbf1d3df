"""Connected components of a link table, as alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.joins import attach
from tabloom.sources.workspace import materialized


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v") % 1000003)).first()
    return tuple(row)


def _lowest(edges: DataFrame) -> DataFrame:
    """For each u its lowest neighbour or itself, and how many rows it has; combined before the shuffle."""
    grouped = edges.groupBy("u").agg(F.min("v").alias("lowest"), F.count(F.lit(1)).alias("degree"))
    return materialized(grouped.select("u", F.least("u", "lowest").alias("lowest"), "degree"), "lowest")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked to, for every node of a link (a, b).

    Each round links every node to the lowest of its neighbours, then the lower
    neighbours to each other's lowest, until nothing changes: a logarithmic
    number of rounds even for long chains. Rounds are written tables, so a lost
    executor repeats no earlier round; a node with many links is looked up
    without a shuffle.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    now = materialized(pairs, "links")
    mark = _mark(now)
    while mark[0]:
        both = materialized(now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), "neighbours")
        starred = attach(both, _lowest(both), "u", "degree").filter("v > u").select(F.col("v").alias("u"), F.col("lowest").alias("v"))
        large = materialized(starred.filter("u <> v").distinct(), "large-stars")
        lowest = _lowest(large)
        inner = attach(large, lowest, "u", "degree").select(F.col("v").alias("u"), F.col("lowest").alias("v"))
        small = inner.unionByName(lowest.select("u", F.col("lowest").alias("v"))).filter("u <> v").distinct()
        now = materialized(small, "small-stars")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
