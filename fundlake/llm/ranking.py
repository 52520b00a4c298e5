"""Positions of rows in the order of their group, whatever the size of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm.common import stage


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with ``place`` (from 0, in the order of ``order`` within ``group``, nulls first) and ``size`` of the group.

    Rows are dealt to tasks by ranges of (group, order), so a group of any size is cut into ranges; a place is the number
    of rows of the group in earlier ranges plus the place within the range. Equal rows are cut too, by where they were
    read. ``group`` must not be null. Only one row per range and group is ordered in a window.
    """
    keys = [group, *order, "_read_at"]
    ranged = rows.withColumn("_read_at", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stage(ranged.drop("_read_at").withColumn("_at", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    ranges = placed.groupBy(group, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(group)
    before = F.sum("_rows").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_rows")
    starts = ranges.select(group, "_range", (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(whole).alias("size"))
    return placed.join(starts, [group, "_range"]).withColumn("place", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")
