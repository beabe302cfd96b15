"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

The first scan counts (length, prefix hash) cells, which also gives the counts by length. Cells of
one row are done: nothing equals them. The second scan hashes the full text only where the row's
cell holds several rows. Texts are never shuffled; a bitmap of fixed size tells the scan which
cells survive (a false hit costs one hash and changes nothing).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import numbered, one_spaced, without_rows
from ledgerloom.sources.workspace import materialize, settled

PREFIX_CHARS = 128
# 2**22 bits in 65,536 words: the broadcast has at most that many rows, whatever the input
BITMAP_BITS = 22
_WORD_BITS = 6


def text_sha256(text: Column) -> Column:
    """SHA-256, in lower-case hex, of the text with white space normalised; NULL counts as empty."""
    return F.sha2(one_spaced(text), 256)


def _slot() -> Column:
    return F.pmod(F.xxhash64("length", "prefix"), F.lit(1 << BITMAP_BITS))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per input row: ``id_col``, ``keep_id``, ``group_size``, ``kept``, then ``carry``.

    Equal are texts that agree after runs of white space become one space; NULL is the empty text.
    The smallest id of a group stays (a NULL id only if there is no other); of rows that repeat the
    same id and text exactly one is kept. An empty table gives no rows. Other columns are ignored;
    ``carry`` adds expressions of the input.
    """
    text = F.col(text_col)
    norm = one_spaced(text)
    cell = [
        F.octet_length(norm).alias("length"),
        F.xxhash64(F.substring(norm, 1, PREFIX_CHARS)).alias("prefix"),
    ]
    cells = docs.select(*cell).groupBy("length", "prefix").agg(F.count("*").alias("rows"))
    surviving = cells.filter("rows > 1").select(_slot().alias("slot"))
    bitmap = (
        surviving.groupBy(F.shiftright("slot", _WORD_BITS).alias("_word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(slot & {(1 << _WORD_BITS) - 1} as int))")).alias("_bits"))
    )
    bitmap = materialize(bitmap, "dedup-cells")
    carried = dict(carry or {})
    rows = docs.select(
        F.col(id_col).alias("_id"), norm.alias("_norm"), *cell, *[c.alias(n) for n, c in carried.items()]
    )
    rows = rows.withColumn("slot", _slot()).join(
        F.broadcast(bitmap), F.shiftright("slot", _WORD_BITS) == F.col("_word"), "left"
    )
    hit = F.expr(f"(shiftrightunsigned(_bits, cast(slot & {(1 << _WORD_BITS) - 1} as int)) & 1) = 1")
    hashed = rows.select(
        "_id", "length", "prefix", F.when(hit, F.sha2("_norm", 256)).alias("full"), *carried,
        F.monotonically_increasing_id().alias("_row"),
    )
    hashed = materialize(hashed, "dedup-hashes")
    groups = (
        hashed.filter("full is not null")
        .groupBy(F.col("length").alias("_length"), F.col("prefix").alias("_prefix"), F.col("full").alias("_full"))
        .agg(
            F.min(F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), F.col("_row").alias("row"))).alias("_first"),
            F.count("*").alias("_size"),
        )
        .filter("_size > 1")
    )
    # written, so that the join shuffles both sides by itself and can split a large group
    groups = materialize(groups, "dedup-groups")
    joined = hashed.join(
        groups,
        (F.col("length") == F.col("_length")) & (F.col("prefix") == F.col("_prefix")) & (F.col("full") == F.col("_full")),
        "left",
    )
    return joined.select(
        F.col("_id").alias(id_col),
        F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_first.id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce(F.col("_first.row") == F.col("_row"), F.lit(True)).alias("kept"),
        *carried,
    )


def one_row_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one ``exact_groups`` marks as kept.

    Rows are told apart by a number of their own, so rows that repeat id and text leave one, and an id
    may stand for several texts. A row without an id is the one that stays only if no other has one. NULL and
    empty texts are one group; an empty table gives no rows. Only the numbers of the rows that go are kept as a work
    table, and only they and the texts' row numbers meet.
    """
    table = numbered(docs)
    rows = table.select(F.col(f"doc.{id_col}").alias("id"), F.col(f"doc.{text_col}").alias("text"), "row")

    def gone() -> DataFrame:
        return exact_groups(rows, "id", "text", carry={"row": F.col("row")}).filter(~F.col("kept")).select("row")

    return without_rows(table, settled(docs.sparkSession, "copies", gone))
