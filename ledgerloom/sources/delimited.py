"""Delimited text in UTF-16, the exchange format of bulk export and load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom.sources.tables import Loaded
from ledgerloom.sources.workspace import materialize

# An empty field is NULL; an empty string is written as two quotes.
_FORMAT = {
    "encoding": "UTF-16LE",
    "header": "false",
    "lineSep": "\n",
    "quote": '"',
    "escape": '"',
    "emptyValue": '""',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# what a line by itself is parsed with
_LINE_FORMAT = {k: v for k, v in _FORMAT.items() if k not in ("encoding", "header", "lineSep")}
# stands for an empty string between parser and result, where an empty text would become NULL
_EMPTY_MARK = "\u0001"


def export_delimited(df: DataFrame, path: str, separator: str = "@", rows_per_file: int = 1_000_000) -> None:
    """Write files of at most ``rows_per_file`` rows, so that a load has files to spread."""
    df.write.options(**_FORMAT, sep=separator, maxRecordsPerFile=str(rows_per_file)).csv(path)


def write_lines(lines: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write the one text column of ``lines`` in UTF-16 as it is, a line a row."""
    as_is = {**_FORMAT, "quote": "\u0000", "escapeQuotes": "false"}
    lines.write.options(**as_is, sep="\u0002", maxRecordsPerFile=str(rows_per_file)).csv(path)


def load_delimited(spark: SparkSession, path: str, schema: StructType | str, separator: str = "@") -> DataFrame:
    """Read the export back with a declared schema; bad rows are an error.

    ``multiLine`` decodes a file as a whole stream. Splitting UTF-16 at line-end bytes could cut
    inside a character, and a quoted field may hold a line end.
    """
    reader = spark.read.schema(schema).options(
        **{**_FORMAT, "emptyValue": _EMPTY_MARK}, sep=separator, multiLine="true", mode="FAILFAST"
    )
    return _unmarked(reader.csv(path))


def _unmarked(loaded: DataFrame) -> DataFrame:
    return loaded.select(
        *(
            F.when(F.col(c) == _EMPTY_MARK, "").otherwise(F.col(c)).alias(c) if t == "string" else F.col(c)
            for c, t in loaded.dtypes
        )
    )


def _pieces(spark: SparkSession, path: str, line_end: str) -> DataFrame:
    """Table (file, block, seq, bytes) of what lies between any two byte sequences of a line end; ``seq`` rises in a block."""
    text = spark.read.options(encoding="UTF-16LE", lineSep=line_end).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").cast("binary").alias("bytes"),
    )


def _whole_lines(pieces: DataFrame, line_end: str, longest: int) -> DataFrame:
    """Lines (file, bytes, joined) of UTF-16 ``pieces``, where those that were cut inside a character are joined again.

    The bytes of a line end can also be the second half of one character and the first of the next. Such a cut stands at an odd
    byte of the file, so it is found by the parity of the lengths before it: counted by block, then inside the few blocks that
    hold such a cut. A line of more than ``longest`` bytes after joining is left in its pieces, with ``joined`` false.
    """
    odd = F.length("bytes") % 2
    blocks = materialize(pieces.groupBy("file", "block").agg(F.sum(odd).alias("odd")), "blocks")
    if blocks.filter("odd > 0").isEmpty():
        return pieces.select("file", "bytes", F.lit(True).alias("joined"))
    by_block = Window.partitionBy("file").orderBy("block")
    earlier = by_block.rowsBetween(Window.unboundedPreceding, -1)
    care = blocks.withColumn("shift", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).filter("odd > 0 or shift > 0")
    care = materialize(care.select(F.col("file").alias("_file"), F.col("block").alias("_block"), "shift"), "cut-blocks")
    here = (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block"))
    in_block = Window.partitionBy("file", "block").orderBy("seq")
    before = F.coalesce(F.sum(odd).over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = pieces.join(care, here).withColumn("begins", (F.col("shift") + before) % 2 == 0)
    placed = placed.withColumn("line", F.max(F.when(F.col("begins"), F.col("seq"))).over(in_block)).drop("_file", "_block", "shift")
    placed = materialize(placed, "cut-pieces")
    # pieces ahead of the first line of a block belong to the last one of the blocks before
    lasts = placed.groupBy("file", "block").agg(F.max("line").alias("line"))
    carried = lasts.select(
        F.col("file").alias("_file"), F.col("block").alias("_block"), F.last("line", ignorenulls=True).over(earlier).alias("_line")
    )
    placed = placed.join(carried, here).withColumn("line", F.coalesce("line", "_line")).drop("_file", "_block", "_line")
    sizes = placed.groupBy(F.col("line").alias("_of")).agg(F.sum(F.length("bytes") + len(line_end) * 2).alias("size"))
    placed = placed.join(sizes, F.col("line") == F.col("_of"))
    ends = line_end.encode("utf-16-le").hex()
    part = F.struct("block", "seq", F.hex("bytes").alias("hex"))
    joined = placed.filter(F.col("size") <= longest).groupBy("file", "line").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    joined = joined.select("file", F.unhex(F.array_join("parts.hex", ends)).alias("bytes"), F.lit(True).alias("joined"))
    left = placed.filter(F.col("size") > longest).select("file", "bytes", F.lit(False).alias("joined"))
    return pieces.join(care, here, "left_anti").select("file", "bytes", F.lit(True).alias("joined")).unionByName(joined).unionByName(left)


def _broken(data: Column) -> Column:
    """Whether little-endian UTF-16 ``data`` has half a surrogate pair."""
    units = F.regexp_replace(F.hex(data), "(..)(..)", "$2$1 ")
    return units.rlike("D[89AB][0-9A-F]{2} (?!D[C-F])|(?<!D[89AB][0-9A-F]{2} )D[C-F][0-9A-F]{2} ")


def load_delimited_split(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    separator: str = "@",
    line_end: str = "\n",
    longest_line: int = 1 << 24,
) -> Loaded:
    """Read large files in UTF-16, each by many tasks, and set bad lines aside instead of ending the load.

    For files without line ends inside quotes: by calling this the caller declares that there are none. A line with an open
    quote is rejected. Rejected as well are lines of another number of fields or with a value of another type, half
    characters, and what is longer than ``longest_line`` bytes because line ends stand at odd bytes. Empty lines are no rows.
    Every other line is in exactly one of the results. The parsed lines become a work table, which both results read.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    bad = "_bad"
    while bad in wanted.names:
        bad += "_"
    fields = [StructField(f.name, f.dataType) for f in wanted.fields]
    parse = {**_LINE_FORMAT, "emptyValue": _EMPTY_MARK, "sep": separator, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    lines = _whole_lines(_pieces(spark, path, line_end), line_end, longest_line).filter(F.length("bytes") > 0)
    data = F.col("bytes")
    unreadable = (
        F.when(~F.col("joined"), "line ends at odd bytes")
        .when(F.length(data) % 2 == 1, "half a character")
        .when(_broken(data), "half a character")
    )
    lines = lines.withColumn("reason", unreadable)
    lines = lines.withColumn("line", F.when(F.col("reason").isNull(), F.decode(data, "UTF-16LE")))
    quotes = F.regexp_count("line", F.lit('"'))
    lines = lines.withColumn("reason", F.when(quotes % 2 == 1, "quote left open").otherwise(F.col("reason")))
    row = F.when(F.col("reason").isNull(), F.from_csv("line", StructType([*fields, StructField(bad, StringType())]).toDDL(), parse))
    parsed = lines.withColumn("row", row)
    wrong = F.col("reason").isNull() & (F.col("row").isNull() | F.col(f"row.{bad}").isNotNull())
    table = materialize(
        parsed.select(
            "file",
            F.when(wrong, "not a valid row").otherwise(F.col("reason")).alias("reason"),
            F.coalesce("line", F.hex(data)).alias("record"),
            "row",
        ),
        "lines",
    )
    good = table.filter("reason is null").select(*(F.col("row")[n].alias(n) for n in wanted.names))
    return Loaded(_unmarked(good), table.filter("reason is not null").select("file", "reason", "record"))
