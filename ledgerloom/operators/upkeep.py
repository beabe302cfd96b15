"""Results kept up to date from a change log, without reading the table again.

A sum over rows changes by what the new rows add less what the old rows added. The log (``deleted_...``, action,
``inserted_...``) has both, so the work follows the changes, not the table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.running import running_by_window

ROWS = "rows"


def log_sides(log: DataFrame, columns: list[str]) -> DataFrame:
    """The log as signed rows: each old row with sign -1 and each new one with +1."""
    old = log.filter("action <> 'INSERT'").select(*(F.col(f"deleted_{c}").alias(c) for c in columns), F.lit(-1).alias("sign"))
    new = log.filter("action <> 'DELETE'").select(*(F.col(f"inserted_{c}").alias(c) for c in columns), F.lit(1).alias("sign"))
    return old.unionByName(new)


def totals(df: DataFrame, month: Column, sums: Mapping[str, Column]) -> DataFrame:
    """(month, rows, sums) of a table, the state that ``updated_totals`` carries on; NULL adds nothing."""
    zero = {n: F.coalesce(F.sum(c), F.lit(0)) for n, c in sums.items()}
    return df.groupBy(month.alias("month")).agg(F.count("*").alias(ROWS), *(c.alias(n) for n, c in zero.items()))


def updated_totals(state: DataFrame, log: DataFrame, month: Column, sums: Mapping[str, Column]) -> DataFrame:
    """``state`` after the changes of ``log``. Months without rows left go, new ones come.

    Sums of whole numbers or decimals only: a floating-point sum does not take back exactly what it added.
    ``month`` and ``sums`` are those of ``totals``, in the table's column names.
    """
    kinds = dict(state.dtypes)
    if any(kinds[n] in ("float", "double") for n in sums):
        raise ValueError("floating-point sums cannot be kept up to date exactly")
    columns = [c.removeprefix("deleted_") for c in log.columns if c.startswith("deleted_")]
    signed = log_sides(log, columns)
    # one row for each touched month, whatever the log's size
    deltas = signed.groupBy(month.alias("month")).agg(
        F.sum("sign").alias(ROWS), *(F.sum(F.col("sign") * F.coalesce(c, F.lit(0))).alias(n) for n, c in sums.items())
    )
    both = state.unionByName(deltas)
    found = both.groupBy("month").agg(*(F.sum(n).cast(kinds[n]).alias(n) for n in (ROWS, *sums)))
    return found.filter(F.col(ROWS) > 0)


def running_totals(state: DataFrame, amount: str, name: str) -> DataFrame:
    """(month, ``name``): running sums over a state's months, so a changed month moves the later ones here only.

    The window has no partitions; the grouping before it makes sure that it sees one row per month.
    """
    months = state.filter("month IS NOT NULL").groupBy("month").agg(F.sum(amount).alias(amount))
    return running_by_window(months, "month", amount, name)
