"""First rows of an order, with and without ties, over everything or per group.

Nothing here sorts a whole table: the executors keep n rows each and the driver's side of the
job sees only those.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.positions import with_position
from ledgerloom.sources.workspace import materialize


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, skip: int, fetch: int, leading: Sequence[str], rest: Sequence[str]) -> DataFrame:
    """Rows ``skip`` to ``skip + fetch`` in the order of the columns ``leading``, then ``rest``.

    The rows are written and counted by ``leading``, which should have few values (days, not keys); the
    counts tell which values the page touches. Only their rows are numbered, spread over tasks, so a
    deep page costs no more than the first and no task sees the rows skipped.
    """
    rows = materialize(df, "page-rows")
    earlier = Window.orderBy(*leading).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*leading).agg(F.count("*").alias("_rows"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    touched = materialize(
        counts.filter((F.col("_before") < skip + fetch) & (F.col("_before") + F.col("_rows") > skip)), "page-values"
    )
    start = touched.agg(F.coalesce(F.min("_before"), F.lit(0))).first()[0]
    wanted = touched.select(*(F.col(c).alias(f"_{c}") for c in leading))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in leading))
    placed = with_position(rows.join(wanted, same, "left_semi"), [F.col(c) for c in (*leading, *rest)], "_place")
    on_page = F.col("_place").between(skip - start, skip + fetch - start - 1)
    return placed.filter(on_page).orderBy("_place").select(*df.columns)


def top_with_ties(df: DataFrame, n: int, by: str, descending: bool = True) -> DataFrame:
    """The first n rows by one column and every further row equal to the n-th.

    NULL sorts lowest, so it comes last when descending and first when ascending.
    """
    key = F.col(by)
    first = df.select(by).orderBy(key.desc() if descending else key.asc()).limit(n)
    worst = (F.min if descending else F.max)(by)
    edge = first.agg(
        F.struct(worst.alias("value"), F.count_if(key.isNull()).alias("nulls"), F.count("*").alias("rows"))
    ).scalar()
    if descending:
        return df.filter((edge["nulls"] > 0) | (key >= edge["value"]))
    return df.filter(key.isNull() | ((edge["nulls"] < edge["rows"]) & (key <= edge["value"])))


def first_per_group(df: DataFrame, n: int, group: Sequence[str], *order: Column) -> DataFrame:
    """The first n rows of each group.

    The optimizer limits each group to n rows per task before the shuffle, so a hot group reaches
    its final task as at most n rows from each.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(window)).filter(F.col("_row") <= n)


def nth_highest(
    ranked: DataFrame, n: int, group: Sequence[str], value: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Per group, the n-th highest ``value``, as columns for ``reaches``.

    ``ranked`` holds each row to be ranked once: distinct values give a dense rank, distinct
    (item, value) rows a plain rank with ties. Only n rows per group and task go through the window,
    so a hot group is never sorted in one task. NULL ranks last.
    """
    order = [F.col(value).desc(), *(F.col(c) for c in tie_break)]
    return (
        first_per_group(ranked.select(*group, value, *tie_break), n, group, *order)
        .groupBy(*group)
        .agg(F.min(value).alias("_edge"), F.bool_or(F.col(value).isNull()).alias("_all"))
    )


def reaches(value: str) -> Column:
    """Whether ``value`` is at least the n-th highest of its group, after a join to ``nth_highest``."""
    return F.col("_all") | (F.col(value) >= F.col("_edge"))
