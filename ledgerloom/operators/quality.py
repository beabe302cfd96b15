"""Declared table constraints as jobs that list the rows breaking them.

Every job returns ``(table_name, rule, row_key, detail)``. A check passes when it is unknown, as it
does for a table constraint.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import first_spelling
from ledgerloom.sources.workspace import materialize


@dataclass(frozen=True)
class RowRule:
    """A rule one row can break on its own; ``broken`` is the negated constraint."""

    name: str
    broken: Column
    detail: Column


def not_null(column: str) -> RowRule:
    return RowRule(f"not_null_{column}", F.col(column).isNull(), F.lit(None))


def max_length(column: str, n: int) -> RowRule:
    length = F.length(column)
    return RowRule(f"max_length_{column}", length > n, length)


def check(name: str, constraint: Column, detail: Column) -> RowRule:
    return RowRule(f"check_{name}", ~constraint, detail)


def _key_text(columns: Sequence[str]) -> Column:
    return F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns))


def _report(df: DataFrame, table: str, rule: Column, key: Column, detail: Column) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"),
        rule.alias("rule"),
        key.alias("row_key"),
        detail.cast("string").alias("detail"),
    )


def row_violations(df: DataFrame, table: str, key: Sequence[str], rules: Sequence[RowRule]) -> DataFrame:
    """All rules of a table in one scan, no shuffle: a row yields one result per rule it breaks."""
    broken = F.array(
        *(
            F.when(r.broken, F.struct(F.lit(r.name).alias("rule"), r.detail.cast("string").alias("detail")))
            for r in rules
        )
    )
    # rules kept are NULL in the array; dropping them after the explode keeps the scan compiled
    found = df.withColumn("_broken", F.explode(broken)).filter(F.col("_broken").isNotNull())
    return _report(found, table, F.col("_broken.rule"), _key_text(key), F.col("_broken.detail"))


def _key_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per key value; text keys count without regard to case and show their first spelling."""
    text = [c for c in columns if dict(df.dtypes)[c] == "string"]
    folded = [F.lower(c).alias(f"_{c}") if c in text else F.col(c) for c in columns]
    return df.groupBy(*folded).agg(F.count("*").alias("_n"), *(first_spelling(F.col(c)).alias(c) for c in text))


def repeated_keys(df: DataFrame, table: str, rule: str, columns: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their number. Counted map-side first."""
    counts = _key_counts(df, columns).filter(F.col("_n") > 1)
    return _report(counts, table, F.lit(rule), _key_text(columns), F.col("_n"))


def primary_key(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Key values that repeat, and NULL keys even when single."""
    counts = _key_counts(df, columns)
    any_null = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns))
    return _report(
        counts.filter((F.col("_n") > 1) | any_null),
        table,
        F.lit("primary_key"),
        _key_text(columns),
        F.col("_n"),
    )


def unique(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    return repeated_keys(df, table, f"unique_{'_'.join(columns)}", columns)


def foreign_keys(
    child: DataFrame, table: str, key: Sequence[str], parents: dict[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Child rows whose non-NULL reference has no parent.

    ``parents`` names the parent and its key for each referencing column. One pass over the children
    takes all their distinct references, which meet the parents, so a hot one counts once. The orphan
    values are written, and a second pass marks the child rows that hold them: without a shuffle as
    long as orphans are few.
    """
    each = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in parents))
    references = child.select(F.inline(each)).filter(F.col("value").isNotNull()).distinct()
    known = reduce(
        DataFrame.unionByName,
        (
            parent.select(F.lit(column).alias("column"), F.col(name).cast("string").alias("value"))
            for column, (parent, name) in parents.items()
        ),
    )
    orphans = materialize(references.join(known, ["column", "value"], "left_anti"), "orphans")
    marked = child.select(*dict.fromkeys([*key, *parents]))
    rules = []
    for column in parents:
        kind = child.schema[column].dataType
        own = orphans.filter(F.col("column") == column).select(F.col("value").cast(kind).alias(column))
        marked = marked.join(own.withColumn(f"_orphan_{column}", F.lit(True)), column, "left")
        rules.append(RowRule(f"foreign_key_{column}", F.col(f"_orphan_{column}"), F.col(column)))
    return row_violations(marked, table, key, rules)


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill columns left empty at insert."""
    return df.withColumns({c: F.coalesce(F.col(c), value) for c, value in defaults.items()})
