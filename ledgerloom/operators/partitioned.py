"""Table changes that rewrite only the months they touch.

The table lies in folders by month (``MonthTable``). Each change finds the months of the rows it concerns, makes their
next content with the operators of ``mutation``, writes it as a work table and puts it in place of those months' folders.
All return the change log: old values, action, new values. Only the list of touched months goes to the driver; it is
bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import mutation
from ledgerloom.sources.layouts import MONTH, MonthTable, month_of
from ledgerloom.sources.workspace import materialize


def _months(df: DataFrame, month: Column) -> list:
    return [r[0] for r in df.select(month.alias(MONTH)).distinct().collect()]


def change_log(rows: DataFrame, action: str, new: Mapping[str, Column] | None = None) -> DataFrame:
    """Log of ``rows``: inserted, deleted, or updated to their columns with ``new`` assigned."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    has_old, has_new, new = action != "INSERT", action != "DELETE", dict(new or {})

    def side(prefix: str, there: bool, values: Mapping[str, Column]):
        return (((values.get(c, F.col(c)) if there else F.lit(None)).cast(t).alias(f"{prefix}_{c}")) for c, t in types.items())

    return rows.select(*side("deleted", has_old, {}), F.lit(action).alias("action"), *side("inserted", has_new, new))


def insert_months(table: MonthTable, rows: DataFrame) -> DataFrame:
    """Append ``rows`` as new files."""
    rows = materialize(rows.select(*table.schema.names), "inserted")
    table.append(rows)
    return change_log(rows, "INSERT")


def delete_months(table: MonthTable, predicate: Column) -> DataFrame:
    """Delete the rows for which ``predicate`` is true; unknown keeps the row."""
    hit = F.coalesce(predicate, F.lit(False))
    months = _months(table.read().filter(hit), F.col(MONTH))
    touched = table.of_months(months)
    gone = materialize(touched.filter(hit), "deleted")
    rest = materialize(mutation.delete_where(touched, predicate), "rest")
    table.replace(rest, months)
    return change_log(gone, "DELETE")


def update_months(table: MonthTable, predicate: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """Assign columns where ``predicate`` is true. A new day moves the row to its month."""
    hit = F.coalesce(predicate, F.lit(False))
    found = table.read().filter(hit)
    new_day = assignments.get(table.day, F.col(table.day)).cast("date")
    months = _months(found, F.col(MONTH))
    both = list(dict.fromkeys([*months, *_months(found, month_of(new_day))]))
    old = materialize(table.of_months(months).filter(hit), "updated")
    rows = materialize(mutation.update_where(table.of_months(both), predicate, assignments), "rows")
    table.replace(rows, both)
    return change_log(old, "UPDATE", assignments)


def merge_months(
    table: MonthTable,
    source: DataFrame,
    on: Sequence[str],
    updates: Sequence[str],
    key: str | None = None,
    insert_constants: Mapping[str, Column] | None = None,
    ignore_case: bool = False,
) -> DataFrame:
    """``mutation.merge`` into the table, rewriting the months of matched and of new rows.

    Which months hold matched rows is read from the match columns alone, without moving the table's rows; if
    ``source`` is large both sides are shuffled by the match columns. New rows must have a ``day``.
    """
    source = materialize(source, "merge-source")
    whole = table.read()
    names = mutation.with_match_keys(source.select(*on), on, ignore_case).drop(*on)
    matched = mutation.with_match_keys(whole.select(*on, MONTH), on, ignore_case).drop(*on).join(names, names.columns, "left_semi")
    months = [*_months(matched, F.col(MONTH)), *_months(source, month_of(table.day))]
    months = list(dict.fromkeys(months))
    merged = mutation.merge(
        table.of_months(months), source, on, updates, key, insert_constants, ignore_case, keys_of=whole if key else None
    )
    rows, log = materialize(merged.snapshot, "rows"), materialize(merged.changes, "log")
    table.replace(rows, months)
    return log
