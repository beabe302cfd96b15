"""Violations kept up to date from a change log, looking up only the keys that changed.

``violations`` is what the full jobs of ``quality`` found before the changes; the functions here give what they would
find after them. Row rules depend on a row alone, so they need the log only. Keys and references also need the rows
that hold a touched key now, which ``rows_with`` fetches without reading others where the table's layout allows it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import quality
from ledgerloom.operators.joins import listed
from ledgerloom.operators.quality import RowRule
from ledgerloom.operators.upkeep import log_sides
from ledgerloom.sources.workspace import materialize

def log_columns(log: DataFrame) -> list[str]:
    return [c.removeprefix("deleted_") for c in log.columns if c.startswith("deleted_")]


def rows_with(table: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows of ``table`` whose ``column`` is among ``keys`` (one column, a small written table); NULL is like no key."""
    found = keys.toDF("_key").filter("_key is not null").distinct()
    few = listed(found)
    if few is None:
        return table.join(found, F.col(column) == F.col("_key"), "left_semi")
    return table.filter(F.col(column).isin(few)) if few else table.limit(0)


def _sides(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    signed = log_sides(log, log_columns(log))
    return signed.filter("sign < 0").drop("sign"), signed.filter("sign > 0").drop("sign")


def _exchanged(violations: DataFrame, gone: DataFrame, come: DataFrame) -> DataFrame:
    """Each row of ``gone`` takes one equal row away, if there is one."""
    return violations.unionByName(come).exceptAll(gone)


def row_rules(violations: DataFrame, log: DataFrame, table: str, key: Sequence[str], rules: Sequence[RowRule]) -> DataFrame:
    """``quality.row_violations`` after the changes of ``log``, without reading the table."""
    old, new = (quality.row_violations(side, table, key, rules) for side in _sides(log))
    return _exchanged(violations, old, new)


def _recounted(violations: DataFrame, log: DataFrame, current: DataFrame, column: str, rule: str, found) -> DataFrame:
    old, new = _sides(log)
    text = dict(current.dtypes)[column] == "string"
    touched = materialize(old.select(column).unionByName(new.select(column)).distinct(), "touched-keys")
    if text:  # keys that differ in case only are one key: look all spellings up
        folded = current.withColumn("_folded", F.lower(column))
        held = rows_with(folded, "_folded", touched.select(F.lower(column))).drop("_folded")
    else:
        held = rows_with(current, column, touched)
    if not touched.filter(F.col(column).isNull()).isEmpty():
        held = held.unionByName(current.filter(F.col(column).isNull()))
    shown = F.coalesce(F.col(column).cast("string"), F.lit("NULL"))
    names = touched.select((F.lower(shown) if text else shown).alias("_name")).distinct()
    own = F.col("rule") == rule
    name = F.lower("row_key") if text else F.col("row_key")
    rest = violations.filter(own).withColumn("_name", name).join(names, "_name", "left_anti").drop("_name")
    return violations.filter(~own).unionByName(rest.select(*violations.columns)).unionByName(found(held))


def primary_key(violations: DataFrame, log: DataFrame, current: DataFrame, table: str, column: str) -> DataFrame:
    """``quality.primary_key`` of a one-column key after the changes; reads the rows that hold a touched key."""
    return _recounted(violations, log, current, column, "primary_key", lambda held: quality.primary_key(held.select(column), table, [column]))


def unique(violations: DataFrame, log: DataFrame, current: DataFrame, table: str, column: str) -> DataFrame:
    """``quality.unique`` of one column after the changes; reads the rows that hold a touched value."""
    return _recounted(
        violations, log, current, column, f"unique_{column}", lambda held: quality.unique(held.select(column), table, [column])
    )


def foreign_keys(
    violations: DataFrame,
    log: DataFrame,
    current: DataFrame,
    table: str,
    key: Sequence[str],
    parents: Mapping[str, tuple[DataFrame, str]],
    parent_logs: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """``quality.foreign_keys`` after the changes of the children (``log``) and of parents (by referencing column).

    ``current`` and ``parents`` are the tables after the changes. Children that did not change are read only where
    a parent key came or went, and then those of that key.
    """
    old, new = _sides(log)
    needed = [*dict.fromkeys([*key, *parents])]
    for column, (parent, name) in parents.items():
        rule = f"foreign_key_{column}"
        moved = None
        parent_log = (parent_logs or {}).get(column)
        if parent_log is not None:
            sides = _sides(parent_log)
            moved = materialize(sides[0].select(name).unionByName(sides[1].select(name)).distinct().dropna(), "moved-parents")

        def others(df: DataFrame, value: str) -> DataFrame:
            if moved is None:
                return df
            own = moved.select(F.col(name).cast("string").alias("_moved"))
            return df.join(own, F.col(value).cast("string") == F.col("_moved"), "left_anti")

        def orphans(rows: DataFrame) -> DataFrame:
            keys = parent.select(F.col(name).alias("_parent"))
            return rows.dropna(subset=[column]).join(keys, F.col(column) == F.col("_parent"), "left_anti")

        always = [RowRule(rule, F.lit(True), F.col(column))]
        gone = quality.row_violations(others(old.select(*needed).dropna(subset=[column]), column), table, key, always)
        come = quality.row_violations(orphans(others(new.select(*needed), column)), table, key, always)
        own = F.col("rule") == rule
        kept = _exchanged(others(violations.filter(own), "detail"), gone, come)
        if moved is not None:
            vanished = moved.join(parent.select(F.col(name)), name, "left_anti")
            held = rows_with(current.select(*needed), column, materialize(vanished, "vanished-parents"))
            kept = kept.unionByName(quality.row_violations(held, table, key, always))
        violations = violations.filter(~own).unionByName(kept)
    return violations
