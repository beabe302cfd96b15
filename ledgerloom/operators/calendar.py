"""Calendar months as rows, for reports that must show empty months."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def months_between(df: DataFrame, day: str) -> DataFrame:
    """Every month from the first to the last date in ``df`` (bounded by the calendar)."""
    edges = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    months = F.sequence(F.trunc("lo", "MM"), F.trunc("hi", "MM"), F.expr("interval 1 month"))
    return (
        edges.filter(F.col("lo").isNotNull())
        .select(F.explode(months).alias("month"))
        .select(F.year("month").alias("year"), F.month("month").alias("month"))
    )


def months_from(spark: SparkSession, first_day: str, last_day: str) -> DataFrame:
    """Every month from that of one day to that of another."""
    days = spark.range(1).select(F.lit(first_day).cast("date").alias("first"), F.lit(last_day).cast("date").alias("last"))
    return months_between(days.select(F.explode(F.array("first", "last")).alias("day")), "day")


def with_empty_months(report: DataFrame, months: DataFrame, sold: DataFrame, zeros: dict[str, object]) -> DataFrame:
    """Add to ``report`` a row of zeros for each of ``months`` that is not in ``sold``.

    Months that had sales but were filtered out of the report stay out.
    """
    empty = months.join(sold.select("year", "month"), ["year", "month"], "left_anti")
    types = dict(report.dtypes)
    columns = [
        F.col(c) if c in ("year", "month") else F.lit(zeros.get(c)).cast(types[c]).alias(c)
        for c in report.columns
    ]
    return report.unionByName(empty.select(*columns))
