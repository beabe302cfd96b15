"""Folds and bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL for a NULL id."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, held_out: Column, rows: int, chars: int, id_col: str = "doc_id"
) -> DataFrame:
    """Up to ``rows`` labelled rows outside ``held_out``, as (id, label, text), the same at every run.

    Rows are drawn by the hash of their id, first the ids alone; texts over ``chars`` characters are
    not used to learn from. Both bounds hold what the driver gets, whatever the tables' size.
    """
    known = labels.filter(F.col(label).isin(0, 1) & ~held_out).select(
        F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label")
    )
    fit = docs.filter(F.length("text") <= chars).select(
        F.col(id_col).alias("_doc"), F.xxhash64("text").alias("_hash"), F.col("text").alias("text")
    )
    drawn = (
        known.join(fit.select("_doc", F.col("_hash").alias("_text")), F.col("_id") == F.col("_doc"))
        .select("_id", "_label", "_text")
        .distinct()
        .orderBy(F.xxhash64("_id"), "_id", "_label", "_text")
        .limit(rows)
    )
    # at most ``rows`` ids: small enough to broadcast by construction
    found = fit.join(F.broadcast(drawn), (F.col("_doc") == F.col("_id")) & (F.col("_hash") == F.col("_text")))
    return found.select("_id", "_label", "text").dropDuplicates()
