"""Sums along an order, without any group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.session import keep


def running(rows: DataFrame, group: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over the rows of its group that come before it.

    The order is cut into ranges, sums run inside each range, and the ranges' totals are added, so
    that a group spreads over as many tasks as it fills. Group and order columns are never null.
    Only rows that agree in all of them are sure to share a range, and which of them is first is open.
    """
    valued = rows.withColumn("_value", value)
    ranged = valued.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id())
    ranged = keep(ranged, "ranges")
    to_here = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*group, "_part").orderBy(*order).rowsBetween(*to_here)
    # One row for each range and group in it.
    parts = ranged.groupBy(*group, "_part").agg(F.sum("_value").alias("_sum"))
    across = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_part").rowsBetween(*to_here)
    parts = parts.withColumn("_ahead", F.coalesce(F.sum("_sum").over(across), F.lit(0))).drop("_sum")
    placed = ranged.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    joined = placed.join(parts, [*group, "_part"])
    return joined.withColumn(name, F.col("_ahead") + F.col("_inside")).drop("_value", "_part", "_ahead", "_inside")
