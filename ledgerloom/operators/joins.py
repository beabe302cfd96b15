"""Semi- and anti-joins when one key may hold a large part of the rows.

The adaptive skew rule splits a hot key only on the left of a semi- or anti-join, and only if both
inputs come straight out of a shuffle. So there are two cases:

* the right side is the large, repetitive one: reduce it to distinct keys first (the functions here);
* the left side is: join it to the plain right side, or to a work table, with ``left_semi``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# up to so many keys are looked up by value, which lets a scan skip files, buckets and row groups
LISTED_KEYS = 1_000


def listed(keys: DataFrame) -> list | None:
    """The non-NULL values of ``keys`` (one column), or None if it has more than ``LISTED_KEYS`` rows with one."""
    found = keys.toDF("_key").filter("_key is not null").limit(LISTED_KEYS + 1).collect()
    return sorted({r[0] for r in found}) if len(found) <= LISTED_KEYS else None


def distinct_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Each non-NULL key once.

    Partial aggregation collapses a hot key before the shuffle.
    """
    present = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))
    return df.filter(present).select(*columns).distinct()


def keep_present(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``; ``df`` holds a key only a few times."""
    return df.join(distinct_keys(other, *on), list(on), "left_semi")


def keep_absent(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``; a NULL key occurs nowhere.

    ``df`` holds a key only a few times.
    """
    return df.join(distinct_keys(other, *on), list(on), "left_anti")
