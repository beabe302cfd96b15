"""Running totals over calendar periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# 2**17 months reach past year 9999.
_LEVELS = 17


def running_by_window(periods: DataFrame, period: str, amount: str, name: str) -> DataFrame:
    """``periods`` holds one row per calendar period, so the unpartitioned window is bounded by
    the calendar (12 rows a year), not by the data."""
    window = Window.orderBy(period).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return periods.select(period, F.sum(amount).over(window).alias(name))


def running_by_self_join(months: DataFrame, month: str, amount: str, name: str) -> DataFrame:
    """The same total from a self-join, with no window function.

    A join on ``b.month <= a.month`` pairs every month with all before it. Here months are summed
    into blocks of 1, 2, 4, ... months, and the stretch up to a month is the disjoint union of the
    blocks named by the bits of its month number: an equi-join with at most 17 rows a month.
    """
    number = F.year(month) * 12 + F.month(month) - 1
    levels = F.sequence(F.lit(0), F.lit(_LEVELS))
    numbered = months.withColumn("_number", number)
    blocks = (
        numbered.select("_number", amount, F.explode(levels).alias("_level"))
        .groupBy("_level", F.expr("shiftright(_number, _level)").alias("_block"))
        .agg(F.sum(amount).alias("_amount"))
    )
    needed = (
        numbered.select(month, (F.col("_number") + 1).alias("_end"), F.explode(levels).alias("_level"))
        .filter(F.expr("shiftright(_end, _level) % 2 = 1"))
        .select(month, "_level", F.expr("shiftright(_end, _level) - 1").alias("_block"))
    )
    return (
        needed.join(blocks, ["_level", "_block"])
        .groupBy(month)
        .agg(F.sum("_amount").alias(name))
    )
