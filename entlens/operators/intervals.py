"""Merging of integer ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def merge_ranges(df: DataFrame, group_cols: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Overlapping or adjacent ranges of a group become one.

    A range opens an island when it starts beyond every earlier end plus one; ranges are first reduced to one per
    start, so copies never reach the window.
    """
    reduced = df.groupBy(*group_cols, start).agg(F.max(end).alias(end))
    ordered = Window.partitionBy(*group_cols).orderBy(start)
    reach = F.max(end).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opened = reduced.withColumn("opens", F.when(F.col(start) <= reach + 1, 0).otherwise(1))
    island = F.sum("opens").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return opened.withColumn("island", island).groupBy(*group_cols, "island").agg(
        F.min(start).alias(start), F.max(end).alias(end)).drop("island")
