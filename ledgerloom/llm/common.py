"""What several operators share: words, text normal form and offsets over large groups."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.workspace import materialize

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# the empty place after a word: splitting there keeps all white space
WORD_END = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"
# the 32-bit order key of a row is the head of the MD5 of its id
KEY_BITS = 32


def word_count(text: Column) -> Column:
    """Number of words of ``text``; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def one_spaced(text: Column) -> Column:
    """``text`` with every run of white space as one space; empty for NULL."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _placed(docs: DataFrame) -> tuple[DataFrame, list]:
    """(file, place, doc) by the place of each row in its file, and the files' row counts."""
    rows = docs.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"), F.struct("*").alias("doc"))
    files = rows.groupBy("_file").agg(F.count("*").alias("rows"), F.max("_place").alias("last"), F.sum("_place").alias("total")).collect()
    return rows, files


def _file_order(path: str) -> tuple:
    folder, _, name = path.rpartition("/")
    part = re.match(r"part-(\d+)", name)
    return folder, int(part[1]) if part else -1, name


def numbered(docs: DataFrame) -> DataFrame:
    """Table (row, doc) with a number of its own for each row, whatever its columns hold.

    Numbers run from 0 in the order of the files and of the rows in them, so a table that was written in some order
    has them in that order. Rows of a Parquet table are numbered where they lie and nothing is written; any other
    rows are written first. The driver gets one row for each file, as it does to list the table.
    """
    spark = docs.sparkSession
    rows, files = None, []
    if "_metadata" not in docs.columns:
        try:
            rows, files = _placed(docs)
        except AnalysisException:  # not the rows of a file
            rows = None
    # every place of every file exactly once: else rows were left out or repeated since they were read
    if rows is None or any(f["last"] != f["rows"] - 1 or f["total"] != f["rows"] * f["last"] // 2 for f in files):
        rows, files = _placed(materialize(docs.select(F.struct("*").alias("_doc")), "numbered"))
        rows = rows.select("_file", "_place", F.col("doc._doc").alias("doc"))
    starts, at = [], 0
    for file in sorted(files, key=lambda f: _file_order(f["_file"])):
        starts.append((file["_file"], at))
        at += file["rows"]
    begins = spark.createDataFrame(starts, "_path string, _begin bigint")
    return rows.join(F.broadcast(begins), F.col("_file") == F.col("_path")).select((F.col("_begin") + F.col("_place")).alias("row"), "doc")


def without_rows(table: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of a ``numbered`` table that are not in ``gone`` (one column), with the columns they had."""
    return table.join(gone.toDF("_gone"), F.col("row") == F.col("_gone"), "left_anti").select("doc.*")


def digest_of(identity: Column, text: Column | None = None) -> Column:
    """Text by which rows are put into a reproducible random order; rows without an id go by their ``text``."""
    other = F.lit("") if text is None else F.md5(F.coalesce(text.cast("string"), F.lit("")))
    return F.md5(F.coalesce(identity.cast("string"), other))


def shard_of(digest: Column, shards: int) -> Column:
    """Shard of a row, rising with its digest, so that shards in order are the digests in order."""
    head = F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("bigint")
    return F.shiftright(head * F.lit(shards), KEY_BITS)


def shards_for(rows: int, rows_per_shard: int) -> int:
    return max(1, -(-rows // rows_per_shard))


def _before(sums: DataFrame, groups: Sequence[str], shards: int, fanout: int) -> DataFrame:
    """``sums`` (groups, shard, total) with ``before``: the total of the group's shards below."""
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)

    def running(window):
        return F.coalesce(F.sum("total").over(window), F.lit(0)).cast("bigint")

    if shards <= fanout:
        return sums.withColumn("before", running(earlier.partitionBy(*groups)))
    blocked = sums.withColumn("block", F.floor(F.col("shard") / fanout).cast("bigint"))
    blocks = blocked.groupBy(*groups, F.col("block").alias("shard")).agg(F.sum("total").alias("total"))
    offsets = _before(blocks, groups, -(-shards // fanout), fanout).select(
        *groups, F.col("shard").alias("block"), F.col("before").alias("_offset")
    )
    return (
        blocked.withColumn("before", running(earlier.partitionBy(*groups, "block")))
        .join(offsets, [*groups, "block"])
        .select(*groups, "shard", "total", (F.col("before") + F.col("_offset")).alias("before"))
    )


def with_offsets(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    shards: int,
    offset: str = "offset",
    facts: DataFrame | None = None,
    fanout: int = 1000,
) -> DataFrame:
    """Add the sum of ``value`` over the rows of the same group that come before, by (``digest``, ``tie``).

    ``df`` has the columns ``digest``, ``shard`` (``shard_of``) and ``tie`` (unique within a digest);
    ``groups`` hold no NULL. No task holds a group: a window sees one shard of one group, and the
    shards' totals are added up in blocks of ``fanout``. ``facts``, one row per group, is joined to
    the shards' totals, so that rows get its columns without a join on the group alone.
    """
    totals = df.groupBy(*groups, "shard").agg(F.sum(value).alias("total"))
    starts = _before(totals, groups, shards, fanout).drop("total").withColumnRenamed("before", "_start")
    if facts is not None:
        starts = starts.join(facts, list(groups))
    inside = (
        Window.partitionBy(*groups, "shard")
        .orderBy("digest", "tie")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)).cast("bigint"))
        .join(starts, [*groups, "shard"])
        .withColumn(offset, F.col("_inside") + F.col("_start"))
        .drop("_inside", "_start")
    )
