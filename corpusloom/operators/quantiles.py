"""Exact medians of huge groups.

A median is read from the histogram of the values instead of from the sorted rows: the row-level
work is a count per (group, value), combined on the map side, and only the distinct values of a
measure (milliseconds, characters) meet in one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_positions(histogram: DataFrame, groups: list[str], value: str, count: str = "n") -> DataFrame:
    """Add ``_until`` (rows up to this value) and ``_total`` (rows of the group)."""
    ordered = Window.partitionBy(*groups).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return histogram.withColumns({
        "_until": F.sum(count).over(ordered), "_total": F.sum(count).over(Window.partitionBy(*groups)),
    })


def median(value: Column | str, upper: bool = False) -> Column:
    """Aggregate over ``with_positions``: mean of the two middles, or with ``upper`` the later one
    (index n // 2)."""
    v = F.col(value) if isinstance(value, str) else value
    high = F.floor(F.col("_total") / 2)
    low = high if upper else F.floor((F.col("_total") - 1) / 2)

    def at(index: Column) -> Column:
        return F.min(F.when(F.col("_until") > index, v))

    return ((at(low) + at(high)) / F.lit(2.0)).cast("double")


def medians(df: DataFrame, groups: list[str], value: str, alias: str, upper: bool = False) -> DataFrame:
    """Median of ``value`` per group, nulls left out."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n"))
    return with_positions(counted, groups, value).groupBy(*groups).agg(median(value, upper).alias(alias))
