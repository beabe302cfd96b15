"""Packing by optimal length buckets.

A global histogram of lengths goes through dynamic programming, which chooses the bucket boundaries
with the least padding. Inside a bucket all sequences are padded to its longest one, and batches
hold as many rows as fit the token budget at that length. Lengths above 4,096 share a cell with others up to 1/2,048
longer and go into one bucket with them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import digest_of, numbered, shard_of, shards_for, with_offsets, word_count
from ledgerloom.sources.workspace import materialize

BUCKETS = 16
TOKEN_BUDGET = 8192
# lengths up to 2**12 have cells of their own; above, a cell spans 1 / 2**11 of its octave
EXACT_BITS = 12
ROWS_PER_SHARD = 500


def cell_top(length: Column) -> Column:
    """Largest length of the histogram cell that holds ``length``.

    Exact up to 4,096; above, a cell is at most 1/2,048 of its lengths wide. 64-bit lengths have
    under 110,000 cells, which bounds the histogram whatever the table holds.
    """
    octave = F.length(F.bin(length)) - 1
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.greatest(octave - (EXACT_BITS - 1), F.lit(0)))
    return F.when(length <= (1 << EXACT_BITS), length).otherwise(length + F.pmod(-length, width))


def optimal_boundaries(lengths: Sequence[int], counts: Sequence[int], buckets: int) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets with the least total padding.

    ``lengths`` rise. The padding of cells i..j in one bucket is lengths[j] * rows - tokens, so with
    fixed tokens the padded size is minimised: best[k][j] = min over i of best[k-1][i] + lengths[j] *
    rows(i+1..j). The best i rises with j (the cost is a product of two rising terms), so each layer
    is filled by divide and conquer over whole levels.
    """
    size = len(lengths)
    if size == 0:
        return []
    tops = np.asarray(lengths, dtype=np.float64)
    rows = np.concatenate([[0.0], np.cumsum(np.asarray(counts, dtype=np.float64))])
    best = np.concatenate([[0.0], tops * rows[1:]])
    best[0] = 0.0
    choices = []
    for _ in range(min(buckets, size) - 1):
        found, choice = np.full(size + 1, np.inf), np.zeros(size + 1, dtype=np.int64)
        found[0] = 0.0
        spans = [(1, size, 0, size - 1)]
        while spans:
            low, high, first, last = spans.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(first, min(last, j - 1) + 1)
            cost = best[i] + tops[j - 1] * (rows[j] - rows[i])
            at = int(np.argmin(cost))
            found[j], choice[j] = cost[at], i[at]
            spans += [(low, j - 1, first, int(i[at])), (j + 1, high, int(i[at]), last)]
        choices.append(choice)
        best = found
    ends, j = [], size
    for choice in reversed(choices):
        if j == 0:
            break
        ends.append(int(lengths[j - 1]))
        j = int(choice[j])
    if j:
        ends.append(int(lengths[j - 1]))
    return sorted(ends)


def pack_in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``pack`` of a written table, whose batches follow the order in which its rows were written.

    ``position`` is the number of the row in that order. It tells repeated rows apart. NULL and empty texts have
    nothing to pack, as in ``pack``; an empty table gives no rows; other columns are ignored.
    """
    table = numbered(docs).select(F.col(f"doc.{id_col}").alias("id"), F.col(f"doc.{text_col}").alias("text"), "row")
    return pack(table, "id", order=F.col("row"), **options).withColumnRenamed("id", id_col)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    length: Column | None = None,
    buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET,
    rows_per_shard: int = ROWS_PER_SHARD,
    order: Column | None = None,
) -> DataFrame:
    """One row per input row: id, length, bucket, padded_length, batch, batch_row, padding.

    ``length`` is the number of words of ``text`` unless given. Batches are numbered inside a bucket
    from 0 and hold ``token_budget // padded_length`` rows (at least one: a longer document is a
    batch of its own) in a reproducible random order; only the last batch of a bucket may be short.
    ``order`` gives another order: a whole number for each row, unlike all others and nearly without gaps from 0,
    which is returned too, as ``position``.
    Rows of length 0 or NULL have nothing to pack: bucket, batch and the rest are NULL. An empty
    table gives no rows; repeated rows are packed each.
    """
    size = word_count(F.col("text")) if length is None else F.coalesce(length, F.lit(0)).cast("bigint")
    digest = digest_of(F.col(id_col), F.col("text") if "text" in docs.columns else size) if order is None else order.cast("bigint")
    rows = docs.select(F.col(id_col).alias("_id"), size.alias("length"), digest.alias("digest"))
    rows = materialize(rows.withColumn("cell", cell_top(F.col("length"))), "pack-lengths")
    cells = rows.filter("length > 0").groupBy("cell").agg(F.count("*").alias("rows"), F.max("length").alias("longest")).orderBy("cell").collect()
    tops = optimal_boundaries([c["longest"] for c in cells], [c["rows"] for c in cells], buckets)
    bucket, padded = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for number, top in reversed(list(enumerate(tops))):
        inside = (F.col("length") > 0) & (F.col("length") <= top)
        bucket = F.when(inside, F.lit(number)).otherwise(bucket)
        padded = F.when(inside, F.lit(top).cast("bigint")).otherwise(padded)
    placed = rows.withColumn("bucket", bucket).withColumn("padded_length", padded)
    if order is None:
        shards = shards_for(sum(c["rows"] for c in cells), rows_per_shard)
        shard = shard_of(F.col("digest"), shards)
    else:
        shards = shards_for((rows.agg(F.max("digest")).first()[0] or 0) + 1, rows_per_shard)
        shard = F.floor(F.col("digest") / rows_per_shard).cast("bigint")
    position = [] if order is None else [F.col("digest").alias("position")]
    numbered = with_offsets(
        placed.filter("bucket is not null")
        .withColumn("shard", shard)
        .withColumn("tie", F.struct("_id", "length"))
        .withColumn("one", F.lit(1)),
        ["bucket"],
        "one",
        shards,
        "place",
    )
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.col("padded_length"))).cast("bigint")
    packed = numbered.select(
        F.col("_id").alias(id_col),
        "length",
        "bucket",
        "padded_length",
        F.floor(F.col("place") / per_batch).cast("bigint").alias("batch"),
        (F.col("place") % per_batch).alias("batch_row"),
        (F.col("padded_length") - F.col("length")).alias("padding"),
        *position,
    )
    nothing = placed.filter("bucket is null").select(
        F.col("_id").alias(id_col), "length", "bucket", "padded_length",
        *[F.lit(None).cast("bigint").alias(c) for c in ("batch", "batch_row", "padding")],
        *position,
    )
    return packed.unionByName(nothing)
