"""Table changes as jobs from a snapshot to the next snapshot, with a change log where asked.

Plain parquet tables cannot be updated in place. Each function returns the rows of the new
snapshot; the caller writes them to a new path. A large snapshot is only filtered or mapped: the
picked keys and the change set are the small side of every join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import joins
from ledgerloom.operators.joins import keep_absent, keep_present
from ledgerloom.operators.positions import with_position
from ledgerloom.sources.workspace import materialize


def with_new_keys(rows: DataFrame, snapshot: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Give ``rows`` the keys after the highest one of ``snapshot``, in ``order``."""
    key_type = snapshot.schema[key].dataType
    highest = snapshot.agg(F.coalesce(F.max(key), F.lit(0).cast(key_type))).scalar()
    placed = with_position(rows, order, "_place")
    return placed.withColumn(key, (highest + F.col("_place") + 1).cast(key_type)).drop("_place")


def insert_rows(
    snapshot: DataFrame,
    rows: DataFrame,
    key: str | None = None,
    order: Sequence[Column] = (),
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Append ``rows``, matched by column name, generating ``key`` if one is named.

    Columns missing from ``rows`` take their default, or NULL.
    """
    for name, value in (defaults or {}).items():
        current = F.col(name) if name in rows.columns else F.lit(None)
        rows = rows.withColumn(name, F.coalesce(current, value))
    if key:
        rows = with_new_keys(rows, snapshot, key, order)
    return snapshot.unionByName(rows, allowMissingColumns=True)


def pick_rows(snapshot: DataFrame, predicate: Column, n: int, key: str) -> tuple[DataFrame, Column]:
    """``snapshot``, and which of its rows hold the keys of the first n matching rows, by key.

    The choice is made once, so a run of changes reads its snapshot once instead of twice per step. Few keys are
    listed in the condition, so that it stays a filter; more become a work table of n rows that is joined.
    """
    first = snapshot.filter(predicate).select(key).orderBy(key).limit(n)
    if n <= joins.LISTED_KEYS:
        keys = [r[0] for r in first.collect() if r[0] is not None]
        return snapshot, F.coalesce(F.col(key).isin(keys), F.lit(False)) if keys else F.lit(False)
    picked = materialize(first, "picked").dropna().distinct().withColumn("_picked", F.lit(True))
    return snapshot.join(picked, key, "left"), F.col("_picked").isNotNull()


def delete_top(snapshot: DataFrame, predicate: Column, n: int, key: str) -> DataFrame:
    marked, picked = pick_rows(snapshot, predicate, n, key)
    return marked.filter(~picked).select(*snapshot.columns)


def delete_where(snapshot: DataFrame, predicate: Column) -> DataFrame:
    """Drop rows where the predicate is true; unknown keeps the row."""
    return snapshot.filter(~F.coalesce(predicate, F.lit(False)))


def delete_all(snapshot: DataFrame) -> DataFrame:
    return snapshot.limit(0)


def _assigned(
    snapshot: DataFrame, columns: Sequence[str], condition: Column, assignments: Mapping[str, Column]
) -> DataFrame:
    types = {field.name: field.dataType for field in snapshot.schema.fields}
    return snapshot.select(
        *(
            F.when(condition, assignments[c].cast(types[c])).otherwise(F.col(c)).alias(c)
            if c in assignments
            else F.col(c)
            for c in columns
        )
    )


def update_where(snapshot: DataFrame, predicate: Column, assignments: Mapping[str, Column]) -> DataFrame:
    return _assigned(snapshot, snapshot.columns, predicate, assignments)


def update_top(
    snapshot: DataFrame, predicate: Column, n: int, key: str, assignments: Mapping[str, Column]
) -> DataFrame:
    marked, picked = pick_rows(snapshot, predicate, n, key)
    return _assigned(marked, snapshot.columns, picked, assignments)


@dataclass(frozen=True)
class Merge:
    """The next snapshot, and one row per changed row: old values, action, new values."""

    snapshot: DataFrame
    changes: DataFrame


_MATCH = "_match_"


def with_match_keys(df: DataFrame, on: Sequence[str], ignore_case: bool) -> DataFrame:
    """``df`` with the columns by which a merge compares rows, in lower case where case is ignored."""
    types = dict(df.dtypes)
    return df.withColumns(
        {
            _MATCH + c: F.lower(c) if ignore_case and types[c] == "string" else F.col(c)
            for c in on
        }
    )


def _reject_ambiguous(target: DataFrame, source: DataFrame, on: Sequence[str]) -> None:
    repeated = (
        source.dropna(subset=list(on)).groupBy(*on).agg(F.count("*").alias("_n")).filter("_n > 1")
    )
    if not repeated.isEmpty() and not keep_present(repeated, target, on).isEmpty():
        names = ", ".join(c.removeprefix(_MATCH) for c in on)
        raise ValueError(f"several source rows match one target row on {names}")


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    updates: Sequence[str],
    key: str | None = None,
    insert_constants: Mapping[str, Column] | None = None,
    ignore_case: bool = False,
    keys_of: DataFrame | None = None,
) -> Merge:
    """Update target rows that match a source row on ``on``; insert source rows that match none.

    ``updates`` are the columns a match takes from the source. Inserted rows take every shared
    column, then ``insert_constants``, and a new ``key`` if one is named. A target row matched
    twice is an error. Matched rows are logged as UPDATE even if nothing differs. ``ignore_case``
    matches text columns of ``on`` as names are compared elsewhere. ``keys_of`` is the whole table, where
    ``target`` is a part of it: new keys come after its highest.

    The target is the left side of a left join rather than of a full join: it then stays in
    place when the source is small, and a hot key in it can be split when it is not.
    """
    # read several times below, and often the result of parsing files
    source = with_match_keys(materialize(source, "merge-source"), on, ignore_case)
    target = with_match_keys(target, on, ignore_case)
    keys = [_MATCH + c for c in on]
    columns = [c for c in target.columns if c not in keys]
    renamed = source.select(
        *keys, *(F.col(c).alias(f"_source_{c}") for c in updates), F.lit(True).alias("_matched")
    )
    assignments = {c: F.col(f"_source_{c}") for c in updates}
    updated = _assigned(target.join(renamed, keys, "left"), columns, F.col("_matched"), assignments)

    # The target rows that the source names, written once: the log, the check for a row matched twice and
    # the search for new rows all read them. A small source shuffles nothing here.
    matched = materialize(target.join(renamed.dropna(subset=keys), keys), "matched")
    _reject_ambiguous(matched, source, keys)
    fresh = keep_absent(source, matched, keys)
    fresh = fresh.select(*(c for c in columns if c in source.columns and c != key or c in on))
    for name, value in (insert_constants or {}).items():
        fresh = fresh.withColumn(name, value)
    if key:
        order = [F.col(c) for c in dict.fromkeys([*on, *fresh.columns])]
        fresh = with_new_keys(fresh, target if keys_of is None else keys_of, key, order)
    types = {field.name: field.dataType for field in target.schema.fields}
    inserted = fresh.select(
        *(
            (F.col(c) if c in fresh.columns else F.lit(None)).cast(types[c]).alias(c)
            for c in columns
        )
    )

    update_log = matched.select(
        *(F.col(c).alias(f"deleted_{c}") for c in columns),
        F.lit("UPDATE").alias("action"),
        *(assignments.get(c, F.col(c)).cast(types[c]).alias(f"inserted_{c}") for c in columns),
    )
    insert_log = inserted.select(
        *(F.lit(None).cast(types[c]).alias(f"deleted_{c}") for c in columns),
        F.lit("INSERT").alias("action"),
        *(F.col(c).alias(f"inserted_{c}") for c in columns),
    )
    return Merge(updated.unionByName(inserted), update_log.unionByName(insert_log))
