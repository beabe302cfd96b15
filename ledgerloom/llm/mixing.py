"""Mixing sources to target weights as a curriculum over training time.

Targets: sources get the words of the whole table by weight, never more than ``max_repeats`` times
their own size. Positions: each source has a weight schedule over training time [0, 1]; its integral
is the source's cumulative demand. The documents of a source lie end to end in a reproducible random
order, repeated as often as the target asks, and a document's training position is the time at which
the cumulative demand reaches its middle word. Sorting by position gives the training order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD_END, digest_of, numbered, shard_of, shards_for, with_offsets, word_count
from ledgerloom.operators.positions import with_position
from ledgerloom.sources.workspace import materialize, settled

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
# (time, relative weight) corners, linear between them; one schedule for each weight
SCHEDULES = (
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 2.0), (0.3, 1.0), (1.0, 0.5)),
)
ROWS_PER_SHARD = 500


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``sources`` (source, no_source, source_size) with rank, weight and target.

    The sizes' sum is shared by weight. Where a share exceeds ``max_repeats`` sizes, the target
    stops there and the excess is shared again by weight. Every round is one aggregate over one row
    per source and stops at least one more source; there are no more rounds than that.
    """
    ranked = with_position(sources, [F.col("no_source"), F.col("source")], "rank")
    cycle = F.array(*[F.lit(w).cast("bigint") for w in weights])
    ranked = ranked.withColumn("weight", F.get(cycle, (F.col("rank") % len(weights)).cast("int"))).withColumn(
        "most", F.col("source_size") * max_repeats
    )
    ranked = materialize(ranked, "mix-sources")
    words = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, stopped = None, -1
    while True:
        at_most = F.lit(False) if level is None else F.col("most") < F.col("weight") * F.lit(level)
        held, taken, weight = ranked.agg(
            F.coalesce(F.count_if(at_most), F.lit(0)),
            F.coalesce(F.sum(F.when(at_most, F.col("most"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~at_most, F.col("weight"))), F.lit(0)),
        ).first()
        if held == stopped or not weight:
            break
        stopped, level = held, (words - taken) / weight
    share = F.col("weight") * F.lit(level or 0.0)
    return ranked.withColumn("target", F.when(F.col("most") < share, F.col("most").cast("double")).otherwise(share))


def time_of_share(share: Column, corners: Sequence[tuple[float, float]]) -> Column:
    """Time at which a source with this schedule has been given ``share`` (0 to 1) of its words.

    The integral of a piecewise linear schedule is quadratic on each piece, so it is inverted there.
    """
    pieces, area = [], 0.0
    for (t0, w0), (t1, w1) in zip(corners, corners[1:]):
        pieces.append((t0, t1, w0, w1, area))
        area += (w0 + w1) * (t1 - t0) / 2
    demand = share * F.lit(area)
    time = F.lit(float(corners[-1][0]))
    for t0, t1, w0, w1, start in reversed(pieces):
        slope = (w1 - w0) / (t1 - t0)
        inside = demand - F.lit(start)
        # 2d / (w + sqrt(w^2 + 2 slope d)) is the root that also holds for slope 0
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * inside, F.lit(0.0)))
        at = F.lit(t0) + F.coalesce(F.try_divide(F.lit(2.0) * inside, F.lit(w0) + root), F.lit(0.0))
        end = start + (w0 + w1) * (t1 - t0) / 2
        time = F.when(demand < F.lit(end), F.least(at, F.lit(t1))).otherwise(time)
    return time


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    max_repeats: int = MAX_REPEATS,
    rows_per_shard: int = ROWS_PER_SHARD,
    row_col: str | None = None,
) -> DataFrame:
    """One row per input row: id, source, size, source_size, weight, target, taken, placements.

    ``placements`` holds (repeat, position, words) of each time the document is used, in order of
    time; ``taken`` is the sum of its words. All placements have the whole size but the one that
    the end of the target cuts. Documents without words have no placement. A NULL text has size 0,
    a NULL source is a source of its own (the last), an empty table gives no rows, and repeated
    rows are documents of their own. ``row_col`` names a column with a number of its own for each row,
    which tells repeated rows apart and is returned too. Rows without an id are ordered by their text.
    """
    row = [] if row_col is None else [F.col(row_col).alias("_row")]
    source = F.col(source_col).cast("string")
    sized = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(source, F.lit("")).alias("source"),
        source.isNull().alias("no_source"),
        word_count(F.col(text_col)).alias("size"),
        digest_of(F.col(id_col), F.col(text_col)).alias("digest"),
        *row,
    )
    sized = materialize(sized, "mix-sizes")
    key = ["source", "no_source"]
    totals = materialize(
        sized.groupBy(*key).agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows")), "mix-totals"
    )
    rows = totals.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    targets = source_targets(totals.select(*key, "source_size"), weights, max_repeats)
    shards = shards_for(rows, rows_per_shard)
    sharded = sized.withColumn("shard", shard_of(F.col("digest"), shards)).withColumn("tie", F.struct("_id", "size", *(["_row"] if row else [])))
    laid = with_offsets(sharded, key, "size", shards, facts=targets)
    whole = F.floor("target").cast("bigint")

    def placed(repeat: Column) -> Column:
        start = F.col("source_size") * repeat + F.col("offset")
        words = F.greatest(F.least(F.col("size"), whole - start), F.lit(0))
        share = F.try_divide(start + words / 2, F.col("target"))
        time = F.lit(None).cast("double")
        for i, corners in enumerate(schedules):
            time = F.when(F.col("rank") % len(schedules) == i, time_of_share(share, corners)).otherwise(time)
        return F.struct(repeat.alias("repeat"), time.alias("position"), words.alias("words"))

    all_uses = F.array(*[placed(F.lit(r).cast("bigint")) for r in range(max_repeats)])
    uses = F.filter(all_uses, lambda use: use["words"] > 0)
    found = laid.select(
        F.col("_id").alias(id_col),
        F.when(~F.col("no_source"), F.col("source")).alias(source_col),
        "size",
        "source_size",
        "weight",
        "target",
        uses.alias("placements"),
        *([F.col("_row").alias(row_col)] if row else []),
    )
    taken = F.aggregate("placements", F.lit(0).cast("bigint"), lambda total, use: total + use["words"])
    return found.withColumn("taken", taken)


def training_order(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per use of a document, range-sorted by training position."""
    uses = mixed.select("*", F.inline("placements")).drop("placements")
    return uses.repartitionByRange("position", id_col, "repeat").sortWithinPartitions("position", id_col, "repeat")


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The documents of the mix in training order, one row per use, with the columns of ``docs``.

    A document used twice is there twice. The one use per source that the target cuts keeps the
    words the mix takes. ``n_chars``, if there is such a column, is kept true to the text.
    Repeated rows and rows without an id are documents of their own, joined to their uses by a row number.
    Documents without words (NULL, empty and blank texts) are in no mix; an empty table gives no rows.
    """
    table = numbered(docs)
    rows = table.select(*[F.col(f"doc.{c}").alias(n) for n, c in (("id", id_col), ("text", text_col), ("source", source_col))], "row")

    def placed() -> DataFrame:
        found = mix(rows, "id", "text", "source", row_col="row", **options)
        return found.select(F.col("row").alias("_row"), F.col("id").alias("_id"), "size", F.inline("placements"))

    uses = settled(docs.sparkSession, "uses", placed)
    joined = table.join(uses, F.col("row") == F.col("_row"))
    cut = F.col("words") < F.col("size")
    text = F.col(f"doc.{text_col}")
    head = F.array_join(F.slice(F.split(text, WORD_END), F.lit(1), F.col("words").cast("int")), "")
    changed = {text_col: head}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(head).cast(docs.schema["n_chars"].dataType)
    order = ["position", "_id", "repeat", "row"]
    ordered = joined.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select(
        *[
            F.when(cut, changed[c]).otherwise(F.col(f"doc.{c}")).alias(c) if c in changed else F.col(f"doc.{c}")
            for c in docs.columns
        ]
    )
