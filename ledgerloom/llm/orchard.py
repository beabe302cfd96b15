"""Vector codes by part codebooks, whose nearest entries are found by Orchard's search.

Components become whole numbers, so every distance and mean is exact. Each codebook entry keeps a list of all entries
by distance from it. A search holds the best entry so far and goes down its list; an entry that is nearer takes over
with its own list, entries seen before are passed over, and the search ends where the list is beyond twice the current
distance: by the triangle inequality nothing further down can be nearer, or as near.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.workspace import materialize

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# list places looked at in one step of all searches of a batch
STEP = 8
BATCH_ROWS = 4096


class Codebook:
    """Entries of one part position and, for each entry, the others sorted by distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        # squared distances of whole numbers: exact in 64 bits
        gaps = np.empty((len(entries), len(entries)), dtype=np.int64)
        for at, entry in enumerate(entries):
            gaps[at] = ((entries - entry) ** 2).sum(axis=1)
        self.order = np.argsort(gaps, axis=1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.order, axis=1)
        sums = entries.sum(axis=1)
        self.by_sum = np.argsort(sums, kind="stable")
        self.sums = sums[self.by_sum]

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest entry of each row (the lowest of equals), its squared distance, and distances computed in all."""
        count, size = len(rows), len(self.entries)
        best = self.by_sum[np.minimum(np.searchsorted(self.sums, rows.sum(axis=1)), size - 1)]
        near = ((rows - self.entries[best]) ** 2).sum(axis=1)
        seen = np.zeros((count, size), dtype=bool)
        seen[np.arange(count), best] = True
        at, open_, computed = np.zeros(count, dtype=np.int64), np.arange(count), count
        while len(open_):
            current = best[open_]
            places = at[open_][:, None] + np.arange(STEP)
            inside = places < size
            places = np.minimum(places, size - 1)
            others = self.order[current[:, None], places]
            # squared distances: beyond twice the distance is beyond four times its square
            inside &= self.gaps[current[:, None], places] <= 4 * near[open_][:, None]
            fresh = inside & ~seen[open_[:, None], others]
            row, slot = np.nonzero(fresh)
            other = others[row, slot]
            seen[open_[row], other] = True
            gap = ((rows[open_[row]] - self.entries[other]) ** 2).sum(axis=1)
            computed += len(row)
            # the nearest new entry of each search, the lowest of equals
            order = np.lexsort((other, gap, row))
            first = order[np.append(True, row[order][1:] != row[order][:-1])] if len(order) else order
            query, gap, other = open_[row[first]], gap[first], other[first]
            better = (gap < near[query]) | ((gap == near[query]) & (other < best[query]))
            at[open_] += STEP
            moved = query[better]
            best[moved], near[moved], at[moved] = other[better], gap[better], 0
            # a list goes on while its next place is inside twice the distance
            following = at[open_]
            more = (following < size) & (self.gaps[best[open_], np.minimum(following, size - 1)] <= 4 * near[open_])
            open_ = open_[more]
        return best, near, computed


def _parts(vectors: list[bytes], part: int, width: int, parts: int) -> np.ndarray:
    rows = np.frombuffer(b"".join(vectors), dtype="<i8").reshape(-1, parts * width)
    return rows[:, part * width : (part + 1) * width]


def _scaled(dim: int, limit: int):
    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            rows = np.clip(np.floor(values * SCALE), -limit, limit).astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r.tobytes() for r in rows], pa.binary())], names=["id", "label", "vector"]
            )

    return scaled


def _totalled(shared, parts: int, width: int):
    """Sums and counts of each entry's parts in this task, as (part, entry, place, total, rows)."""

    def totalled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(e) for e in shared.value]
        size = len(books[0].entries)
        totals = np.zeros((parts, size, width), dtype=np.int64)
        rows = np.zeros((parts, size), dtype=np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH_ROWS):
                vectors = batch.column(0).slice(begin, BATCH_ROWS).to_pylist()
                for part, book in enumerate(books):
                    own = _parts(vectors, part, width, parts)
                    entry, _, _ = book.nearest(own)
                    np.add.at(totals[part], entry, own)
                    rows[part] += np.bincount(entry, minlength=size)
        part, entry = np.nonzero(rows)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(part, width), pa.int32()), pa.array(np.repeat(entry, width), pa.int32()),
                pa.array(np.tile(np.arange(width), len(part)), pa.int32()),
                pa.array(totals[part, entry].ravel(), pa.int64()), pa.array(np.repeat(rows[part, entry], width), pa.int64()),
            ],
            names=["part", "entry", "place", "total", "rows"],
        )

    return totalled


def _coded(shared, parts: int, width: int):
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(e) for e in shared.value]
        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH_ROWS):
                own = batch.slice(begin, BATCH_ROWS)
                vectors = own.column("vector").to_pylist()
                codes, error = np.empty((len(vectors), parts), dtype=np.uint8), np.zeros(len(vectors), dtype=np.int64)
                for part, book in enumerate(books):
                    entry, gap, _ = book.nearest(_parts(vectors, part, width, parts))
                    codes[:, part] = entry
                    error += gap
                yield pa.RecordBatch.from_arrays(
                    [own.column("id"), own.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error, pa.int64())],
                    names=["id", "label", "code", "error"],
                )

    return coded


def codebooks_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and place, as decimals with commas."""
    return hashlib.sha256(",".join(str(v) for book in books for v in book.ravel().tolist()).encode()).hexdigest()


def train(vectors: DataFrame, dim: int, parts: int, entries: int, rounds: int) -> list[np.ndarray]:
    """Codebooks after ``rounds`` of assigning every vector and moving entries to the floor of their means.

    ``vectors`` is a table (id, vector). Tasks send one sum for each entry and place, so the driver and the shuffle
    get no more than a codebook from each task.
    """
    width = dim // parts
    first = vectors.filter("id is not null").orderBy("id", "vector").limit(entries).collect()
    start = np.frombuffer(b"".join(r["vector"] for r in first), dtype="<i8").reshape(-1, dim)
    books = [np.ascontiguousarray(start[:, p * width : (p + 1) * width]) for p in range(parts)]
    schema = "part int, entry int, place int, total bigint, rows bigint"
    for _ in range(rounds if len(start) else 0):
        shared = vectors.sparkSession.sparkContext.broadcast(books)
        sums = vectors.select("vector").mapInArrow(_totalled(shared, parts, width), schema)
        found = sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("rows").alias("rows")).toArrow()
        part, entry, place, total, rows = (found.column(n).to_numpy() for n in ("part", "entry", "place", "total", "rows"))
        books = [book.copy() for book in books]
        for number, book in enumerate(books):
            own = part == number
            book[entry[own], place[own]] = total[own] // rows[own]
    return books


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per kept vector: id, code, error, label_error, codebooks_sha256.

    Kept are vectors without NULL or non-finite components whose length is a multiple of ``parts``, not 0, and that
    of the smallest (id, vector) among such ones: others cannot be compared. Components are floor(1,024 x), held
    within bounds that keep squared distances in 64 bits (beyond 2**20 only). Codebooks start from the ``entries``
    smallest ids (of rows that repeat an id, from the smaller vectors first); with fewer rows they have fewer entries.
    Rows without an id are coded, but start no entry; if there are only such, there are no entries and no rows.
    ``label_error`` adds up the errors of equal labels, NULLs together; it is NULL beyond 64 bits. Repeated rows are
    rows of their own; an empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    schema = f"`{id_col}` bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
    values = F.col(vector_col).cast("array<double>")
    kind = vectors.schema[label_col].dataType.simpleString()
    usable = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).alias("label"), values.alias("values")).filter(
        (F.size("values") > 0)
        & (F.size("values") % parts == 0)
        & ~F.exists("values", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    )
    head = usable.filter("id is not null").orderBy("id", "values").limit(1).collect()
    if not head:
        return spark.createDataFrame([], schema)
    dim = len(head[0]["values"])
    limit = min(1 << 30, int((2**62 / dim) ** 0.5) // 2)
    rows = usable.filter(F.size("values") == dim).mapInArrow(_scaled(dim, limit), f"id bigint, label {kind}, vector binary")
    rows = materialize(rows, "whole-vectors")
    books = train(rows, dim, parts, entries, rounds)
    shared = spark.sparkContext.broadcast(books)
    coded = rows.mapInArrow(_coded(shared, parts, dim // parts), f"id bigint, label {kind}, code string, error bigint")
    coded = materialize(coded, "vector-codes")
    # written, so that the join shuffles both sides by itself and can split a large label
    sums = materialize(coded.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error")), "label-errors")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )
