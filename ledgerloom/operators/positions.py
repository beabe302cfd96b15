"""Row numbers, neighbours and tiles over one order of a whole table.

A window without PARTITION BY runs in one task. Here the rows are range-partitioned by the order
instead, numbered inside each partition, and the number of rows in the partitions before is added.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.workspace import materialize

# monotonically_increasing_id: partition number above bit 33, row number in the partition below.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def with_position(df: DataFrame, order: Sequence[Column], position: str = "position", total: str | None = None) -> DataFrame:
    """Add the 0-based place of each row in ``order`` (and the number of rows as ``total``).

    ``order`` should end with a unique column: equal keys cannot be spread over partitions. The
    numbered rows become a work table, because a second run would sample other range boundaries.
    """
    numbered = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id()),
        "positions",
    ).select(
        "*",
        F.shiftright("_id", _ROW_BITS).cast("int").alias("_part"),
        F.col("_id").bitwiseAND(F.lit(_ROW_MASK)).alias("_row"),
    )
    # one row per shuffle partition, whatever the table holds
    counts = sorted(numbered.groupBy("_part").agg(F.count("*").alias("_rows")).collect())
    before = list(accumulate((rows for _, rows in counts), initial=0))
    offsets = df.sparkSession.createDataFrame(
        [(part, start) for (part, _), start in zip(counts, before)], "_part int, _before bigint"
    )
    placed = numbered.join(F.broadcast(offsets), "_part").withColumn(
        position, F.col("_before") + F.col("_row")
    )
    if total:
        placed = placed.withColumn(total, F.lit(before[-1]).cast("bigint"))
    return placed.drop("_id", "_part", "_row", "_before")


@dataclass(frozen=True)
class Neighbour:
    """``column`` of the row ``offset`` places further on (negative: back), or ``default``."""

    name: str
    column: str
    offset: int
    default: object = None


def with_neighbours(df: DataFrame, position: str, neighbours: Sequence[Neighbour], block: int = 200_000) -> DataFrame:
    """LEAD and LAG by position.

    Rows are grouped in blocks of equal length; the few rows at a block's edges are copied to the
    block next to it, so each block answers on its own. One balanced shuffle, no hot task.
    """
    back = max([-n.offset for n in neighbours if n.offset < 0], default=0)
    ahead = max([n.offset for n in neighbours if n.offset > 0], default=0)
    if block < max(back, ahead):
        raise ValueError("a block must be at least as long as the farthest neighbour")
    home = F.floor(F.col(position) / block)
    place = F.col(position) % block
    blocks = F.array_compact(
        F.array(
            home,
            F.when(place >= block - back, home + 1),
            F.when(place < ahead, home - 1),
        )
    )
    window = Window.partitionBy("_block").orderBy(position)
    spread = df.withColumn("_block", F.explode(blocks))
    shifted = spread.select(
        "*",
        *(
            (
                F.lead(n.column, n.offset, n.default)
                if n.offset > 0
                else F.lag(n.column, -n.offset, n.default)
            )
            .over(window)
            .alias(n.name)
            for n in neighbours
        ),
    )
    return shifted.filter(F.col("_block") == home).drop("_block")


def tile(position: Column, total: Column, tiles: int) -> Column:
    """NTILE from a 0-based position: the first ``total % tiles`` tiles hold one row more."""
    small = F.floor(total / tiles)
    extra = total % tiles
    in_large = extra * (small + 1)
    return (
        F.when(position < in_large, F.floor(position / (small + 1)) + 1)
        .otherwise(extra + F.floor((position - in_large) / F.greatest(small, F.lit(1))) + 1)
        .cast("int")
    )
