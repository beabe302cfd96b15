"""Pivots with given or discovered columns, and unpivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import first_spelling
from ledgerloom.sources.workspace import materialize


def named(column: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + column.replace("`", "``") + "`")


def pivot_count(df: DataFrame, row: str, key: str, counted: str, values: Sequence[str]) -> DataFrame:
    """Count ``counted`` per row and key, one column per value in the order given.

    Empty cells are 0; keys outside ``values`` are ignored, but their rows still appear. Keys that
    differ only in case fall into one column.
    """
    folded = [v.lower() for v in values]
    counts = df.withColumn("_key", F.lower(key)).groupBy(row).pivot("_key", folded).agg(F.count(counted))
    cells = [F.coalesce(named(f), F.lit(0)).alias(v) for f, v in zip(folded, values)]
    return counts.select(row, *cells)


def discovered_values(df: DataFrame, key: str) -> list[str]:
    """The values of ``key`` in order, as pivot columns: the names of the result's schema."""
    return [r[0] for r in distinct_names(df, key).orderBy(F.lower(key)).collect()]


def distinct_names(df: DataFrame, key: str) -> DataFrame:
    """Each non-NULL name once, without regard to case, in its first spelling."""
    named = df.filter(F.col(key).isNotNull())
    return named.groupBy(F.lower(key).alias("_name")).agg(first_spelling(F.col(key)).alias(key)).select(key)


def cell_counts(df: DataFrame, row: str, key: str, counted: str) -> DataFrame:
    """Work table (row, folded, name, cells): counts per row and name without regard to case, with a spelling."""
    counts = df.groupBy(row, F.lower(key).alias("folded")).agg(
        first_spelling(F.col(key)).alias("name"), F.count(counted).alias("cells")
    )
    return materialize(counts, "pivot-cells")


def pivot_count_discovered(df: DataFrame, row: str, key: str, counted: str) -> DataFrame:
    """``pivot_count`` with a column for each name. ``df`` is read once: names and cells come from its counts."""
    cells = cell_counts(df, row, key, counted)
    names = discovered_values(cells, "name")
    folded = [n.lower() for n in names]
    found = cells.groupBy(row).pivot("folded", folded).agg(F.sum("cells"))
    return found.select(row, *(F.coalesce(named(f), F.lit(0)).alias(n) for f, n in zip(folded, names)))


def unpivot_present(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], value: str, source: str = "_source"
) -> DataFrame:
    """One row per id and non-NULL column. The columns must share a type."""
    long = df.unpivot(list(ids), list(columns), source, value)
    return long.filter(F.col(value).isNotNull())


def unpivot_as_text(
    df: DataFrame, ids: Sequence[str], columns: dict[str, Column], value: str, source: str = "_source"
) -> DataFrame:
    """Unpivot columns of different types, each written as text."""
    as_text = df.select(*ids, *(c.cast("string").alias(name) for name, c in columns.items()))
    return unpivot_present(as_text, ids, list(columns), value, source)
