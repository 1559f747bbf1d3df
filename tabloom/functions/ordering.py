"""Running totals over a whole table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import checkpointed
from .columns import col


def with_running_totals(df: DataFrame, order_by: Sequence[str], totals: Mapping[str, Column]) -> DataFrame:
    """Adds, per row, the sum of each total over all rows that sort before it.

    A window without partition keys would move the table to one task. Here the
    rows are range-partitioned, the range totals (one small row per partition)
    become offsets, and the window runs inside each range. The ranges are
    checkpointed because a second run of the sampling could cut them
    differently. ``order_by`` has to be unique, so callers group first; that
    also keeps a hot value from filling a range.
    """
    measured = df.withColumns({f"_add_{name}": total for name, total in totals.items()})
    ranged = checkpointed(measured.repartitionByRange(*[col(c) for c in order_by]))
    ranged = ranged.withColumn("_range", F.spark_partition_id())

    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    range_totals = ranged.groupBy("_range").agg(*[F.sum(f"_add_{name}").alias(name) for name in totals])
    offsets = range_totals.select(
        "_range", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_from_{name}") for name in totals]
    )
    before = (
        Window.partitionBy("_range")
        .orderBy(*[col(c) for c in order_by])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = {name: F.coalesce(F.sum(f"_add_{name}").over(before), F.lit(0)) for name in totals}
    # offsets has one row per partition of the table, a bound known at plan time
    summed = ranged.withColumns(inside).join(F.broadcast(offsets), "_range")
    return summed.select(
        *[col(c) for c in df.columns], *[(F.col(name) + F.col(f"_from_{name}")).alias(name) for name in totals]
    )
