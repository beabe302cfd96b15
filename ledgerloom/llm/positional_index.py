"""Benchmark decontamination with a distributed positional inverted index.

Documents are dealt into shards of bounded size. A shard stores, for each term, the places at which it stands
(its posting list); places run through the shard's documents with a gap after each, so that no phrase reaches from one
document into the next. A phrase is found by starting from the posting list of its rarest word, taking that word's
offset off, and intersecting with the offset-adjusted lists of the next rarest words until none is left. All lists of a
shard are in one task, so nothing but the lists of wanted terms is shuffled, and a very frequent term is spread over
all shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.workspace import materialize

WINDOW = 10
# bounds: words of a shard (a longer document is a shard of its own) and its documents, words of a piece of a test
# text and of the pieces searched for at once, and different test terms up to which the index is restricted to them
SHARD_WORDS = 250_000
SHARD_DOCS_BITS = 14
SEGMENT_WORDS = 20_000
BLOCK_WORDS = 200_000
VOCABULARY_TERMS = 1_000_000
# candidate starts compared at once
CANDIDATES = 1_000_000

# A-Z become lower case, what is neither a digit, a letter a-z nor part of a non-ASCII character becomes a space
_WORD_BYTES = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 0x20 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8; none for NULL."""
    return text.translate(_WORD_BYTES).split() if text else []


@dataclass(frozen=True)
class Index:
    """A written table of posting lists (``term`` not NULL) and of the documents they point into (``term`` NULL).

    Columns: shard, term, n (places in the list, or words of the document), places (little-endian int32), id,
    begin (first place of the document), row (a number of its own for each document).
    """

    table: DataFrame

    @property
    def postings(self) -> DataFrame:
        return self.table.filter("term is not null").select("shard", "term", "n", "places")

    @property
    def documents(self) -> DataFrame:
        return self.table.filter("term is null").select("row", "id", F.col("n").alias("n_words"))


def _indexed(names: list[str], wanted, shard_words: int, gap: int):
    def flushed(shard: int, ids: list, counts: list[int], terms: list[int], spelled) -> pa.RecordBatch:
        sizes = np.asarray(counts, dtype=np.int64)
        begins = np.cumsum(sizes + gap) - (sizes + gap)
        words = np.asarray(terms, dtype=np.int64)
        places = np.arange(len(words)) + np.repeat(np.arange(len(sizes)) * gap, sizes)
        known = np.flatnonzero(words >= 0)
        known = known[np.argsort(words[known], kind="stable")]
        found, first = np.unique(words[known], return_index=True)
        last = np.append(first[1:], len(known))
        places = places[known].astype("<i4")
        docs, lists = len(sizes), len(found)
        none = [None] * docs
        rows = (shard << SHARD_DOCS_BITS) + np.arange(docs)
        columns = [
            pa.array(np.full(docs + lists, shard), pa.int64()),
            pa.array(none + [spelled[t].decode() for t in found.tolist()], pa.string()),
            pa.array(np.concatenate([sizes, last - first]), pa.int64()),
            pa.array(none + [places[a:b].tobytes() for a, b in zip(first, last)], pa.binary()),
            pa.concat_arrays([*ids, pa.nulls(lists, ids[0].type)]),
            pa.array(begins.tolist() + [None] * lists, pa.int64()),
            pa.array(rows.tolist() + [None] * lists, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed = None if wanted is None else wanted.value
        numbers = {} if fixed is None else {w: i for i, w in enumerate(fixed)}
        shard = TaskContext.get().partitionId() << 24
        ids, counts, terms = [], [], []
        for batch in batches:
            for at, text in enumerate(batch.column(1)):
                found = words_of(text.as_py())
                if terms and len(terms) + len(found) > shard_words or len(ids) == 1 << SHARD_DOCS_BITS:
                    yield flushed(shard, ids, counts, terms, fixed or list(numbers))
                    shard, ids, counts, terms = shard + 1, [], [], []
                    if fixed is None:
                        numbers = {}
                ids.append(batch.column(0).slice(at, 1))
                counts.append(len(found))
                if fixed is None:
                    terms += [numbers.setdefault(w, len(numbers)) for w in found]
                else:
                    terms += [numbers.get(w, -1) for w in found]
        if ids:
            yield flushed(shard, ids, counts, terms, fixed or list(numbers))

    return indexed


def build_index(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    terms: list[bytes] | None = None,
    shard_words: int = SHARD_WORDS,
    gap: int = WINDOW,
) -> Index:
    """Write the posting lists of all documents in one map: those of ``terms`` only, or of all words if None.

    Every document has a row, those without words too. Repeated rows are documents of their own. Phrases of more
    than ``gap`` + 1 words could reach over the end of a document, so ``gap`` must not be smaller than a window.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["shard", "term", "n", "places", "id", "begin", "row"]
    wanted = None if terms is None else spark.sparkContext.broadcast(sorted(terms))
    rows = docs.select(F.col(id_col), F.col(text_col).cast("binary")).mapInArrow(
        _indexed(names, wanted, shard_words, gap),
        f"shard bigint, term string, n bigint, places binary, id {kind}, begin bigint, row bigint",
    )
    return Index(materialize(rows, "positional-index"))


def _segmented(window: int, segment_words: int):
    def segmented(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, numbers, widths, lists = [], [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = [w.decode() for w in words_of(text.as_py())]
                width = min(window, len(words))
                for number, begin in enumerate(range(0, len(words) - width + 1 if width else 0, segment_words)):
                    items.append(item)
                    numbers.append(number)
                    widths.append(width)
                    lists.append(words[begin : begin + segment_words + width - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(numbers, pa.int32()), pa.array(widths, pa.int32()), pa.array(lists, pa.list_(pa.string()))],
                names=["item", "segment", "width", "words"],
            )

    return segmented


def test_segments(
    items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, segment_words: int = SEGMENT_WORDS
) -> DataFrame:
    """Work table (item, segment, width, words): the test texts in pieces that hold every window once.

    Texts of fewer than ``window`` words are one window; texts without words have no row. A NULL id is ''.
    """
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("binary").alias("text"))
    return materialize(
        rows.mapInArrow(_segmented(window, segment_words), "item string, segment int, width int, words array<string>"), "test-segments"
    )


test_segments.__test__ = False  # not a test


@dataclass(frozen=True)
class Phrases:
    """A block of different windows: term numbers (-1 after the end), offsets from the rarest word on, and items."""

    terms: list[str]
    windows: np.ndarray
    order: np.ndarray
    widths: np.ndarray
    items: list[str]
    item_from: np.ndarray
    item_of: np.ndarray


def _phrases(segments: list, frequency: dict[str, int]) -> Phrases | None:
    """Windows of the pieces whose words all occur in the index; None if there is none."""
    terms = sorted(frequency)
    number = {t: i for i, t in enumerate(terms)}
    items = sorted({s["item"] for s in segments})
    place = {item: i for i, item in enumerate(items)}
    longest = max((s["width"] for s in segments), default=0)
    rows, owners = [np.zeros((0, longest), dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for s in segments:
        ids = np.asarray([number.get(w, -1) for w in s["words"]], dtype=np.int64)
        found = np.lib.stride_tricks.sliding_window_view(ids, s["width"])
        found = found[(found >= 0).all(axis=1)]
        rows.append(np.pad(found, ((0, 0), (0, longest - s["width"])), constant_values=-1))
        owners.append(np.full(len(found), place[s["item"]]))
    windows, at = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    if not len(windows):
        return None
    pairs = np.unique(np.stack([at.ravel(), np.concatenate(owners)], axis=1), axis=0)
    counts = np.append(np.asarray([frequency[t] for t in terms], dtype=np.int64), np.iinfo(np.int64).max)
    return Phrases(
        terms, windows, np.argsort(counts[windows], axis=1, kind="stable"), (windows >= 0).sum(axis=1),
        items, np.searchsorted(pairs[:, 0], np.arange(len(windows) + 1)), pairs[:, 1],
    )


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indexes starts[i] .. starts[i] + sizes[i] - 1 of every i, one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Shard:
    """The posting lists of one shard for the terms of a block of phrases, and its documents."""

    def __init__(self, rows: pa.Table, phrases: Phrases):
        self.phrases = phrases
        is_term = rows.column("term").is_valid().to_numpy(zero_copy_only=False)
        docs = rows.filter(pa.array(~is_term)).sort_by("begin")
        self.begins = docs.column("begin").to_numpy().astype(np.int64)
        self.sizes = docs.column("n").to_numpy().astype(np.int64)
        self.rows = docs.column("row").to_numpy()
        number = {t: i for i, t in enumerate(phrases.terms)}
        lists = rows.filter(pa.array(is_term))
        found = {}
        for term, places in zip(lists.column("term").to_pylist(), lists.column("places")):
            if term in number:
                found[number[term]] = np.frombuffer(places.as_buffer(), dtype="<i4").astype(np.int64)
        self.counts = np.zeros(len(phrases.terms) + 1, dtype=np.int64)
        for term, places in found.items():
            self.counts[term] = len(places)
        self.first = np.cumsum(self.counts) - self.counts
        self.places = np.concatenate([found[t] for t in sorted(found)] or [np.zeros(0, dtype=np.int64)])
        self.span = int((self.begins + self.sizes).max(initial=0)) + 2 * WINDOW + self.phrases.windows.shape[1]
        # posting lists end to end, so that a place in a list is found by one search over all lists
        self.keys = np.repeat(np.arange(len(self.counts)), self.counts) * self.span + self.places

    def held(self, terms: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether the list of each term has a place from ``low`` to ``high``."""
        at = np.searchsorted(self.keys, terms * self.span + low)
        inside = at < len(self.keys)
        inside[inside] = self.keys[at[inside]] <= (terms * self.span + high)[inside]
        return inside

    def _starts(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, place of its rarest word), in bounded pieces."""
        p = self.phrases
        alive = np.flatnonzero(((self.counts[p.windows] > 0) | (p.windows < 0)).all(axis=1))
        rarest = p.windows[alive, p.order[alive, 0]]
        sizes = self.counts[rarest]
        turn = (np.cumsum(sizes) - sizes) // CANDIDATES
        for piece in np.unique(turn):
            own = turn == piece
            yield np.repeat(alive[own], sizes[own]), self.places[ragged(self.first[rarest[own]], sizes[own])]

    def exact(self) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of every occurrence of a window: intersection from the rarest term on."""
        p, out = self.phrases, [(np.zeros(0, dtype=np.int64),) * 2]
        for window, place in self._starts():
            start = place - p.order[window, 0]
            window, start = window[start >= 0], start[start >= 0]
            for turn in range(1, p.windows.shape[1]):
                offset = p.order[window, turn]
                term, at = p.windows[window, offset], start + offset
                stays = (term < 0) | self.held(np.maximum(term, 0), at, at)
                window, start = window[stays], start[stays]
            out.append((window, start))
        return tuple(np.concatenate(x) for x in zip(*out))

    def near(self, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, place of its rarest word) where every other word stands within ``reach`` words, in any order."""
        p, out = self.phrases, [(np.zeros(0, dtype=np.int64),) * 2]
        for window, place in self._starts():
            doc = self.document(place)
            low = np.maximum(place - reach, self.begins[doc])
            high = np.minimum(place + reach, self.begins[doc] + self.sizes[doc] - 1)
            for turn in range(1, p.windows.shape[1]):
                term = p.windows[window, p.order[window, turn]]
                stays = (term < 0) | self.held(np.maximum(term, 0), low, high)
                window, place, low, high = window[stays], place[stays], low[stays], high[stays]
            out.append((window, place))
        return tuple(np.concatenate(x) for x in zip(*out))

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, place, side="right") - 1

    def items(self, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the given windows belong to which item: (index into ``window``, item)."""
        p = self.phrases
        sizes = np.diff(p.item_from)[window]
        return np.repeat(np.arange(len(window)), sizes), p.item_of[ragged(p.item_from[window], sizes)]

    def spans(self, group: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unions of the spans of each group, as (group, begin, end)."""
        order = np.lexsort((begin, group))
        group, begin, end = group[order], begin[order], end[order]
        shifted = group * self.span
        reach = np.maximum.accumulate(shifted + end) if len(end) else end
        new = np.ones(len(group), dtype=bool)
        new[1:] = (shifted + begin)[1:] > reach[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(group)) - 1 if len(first) else first
        return group[first], begin[first], reach[last] - shifted[last]


def _contaminated(block):
    def contaminated(rows: pa.Table) -> pa.Table:
        shard = Shard(rows, block.value)
        window, start = shard.exact()
        doc = shard.document(start)
        _, begin, end = shard.spans(np.zeros(len(start), dtype=np.int64), start, start + block.value.widths[window])
        owner = shard.document(begin)
        once = np.unique(np.stack([doc, window], axis=1), axis=0) if len(doc) else np.zeros((0, 2), dtype=np.int64)
        at, item = shard.items(once[:, 1])
        pairs = np.unique(np.stack([once[at, 0], item], axis=1), axis=0) if len(at) else np.zeros((0, 2), dtype=np.int64)
        hit = np.unique(doc)
        names, spans = block.value.items, [[] for _ in hit]
        for d, a, b in zip(np.searchsorted(hit, owner).tolist(), (begin - shard.begins[owner]).tolist(), (end - shard.begins[owner]).tolist()):
            spans[d].append({"begin": a, "end": b})
        found = [[] for _ in hit]
        for d, i in zip(np.searchsorted(hit, pairs[:, 0]).tolist(), pairs[:, 1].tolist()):
            found[d].append(names[i])
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        return pa.table({"row": pa.array(shard.rows[hit], pa.int64()), "spans": pa.array(spans, span), "items": pa.array(found, pa.list_(pa.string()))})

    return contaminated


def _matched(block, reach: int | None):
    def matched(rows: pa.Table) -> pa.Table:
        shard, p = Shard(rows, block.value), block.value
        if reach is None:
            window, begin = shard.exact()
            end = begin + p.widths[window]
        else:
            window, begin = shard.near(reach)
            end = begin + 1
        at, item = shard.items(window)
        doc = shard.document(begin[at])
        group, begin, end = shard.spans(doc * len(p.items) + item, begin[at], end[at])
        doc, item = group // len(p.items), group % len(p.items)
        return pa.table({
            "row": pa.array(shard.rows[doc], pa.int64()), "item": pa.array([p.items[i] for i in item.tolist()], pa.string()),
            "begin": pa.array(begin - shard.begins[doc], pa.int64()), "end": pa.array(end - shard.begins[doc], pa.int64()),
        })

    return matched


def _searched(index: Index, segments: DataFrame, search, schema: str, label: str, block_words: int) -> DataFrame:
    """Rows that ``search`` finds in every shard, for one block of test pieces after the other, as a work table."""
    spark = segments.sparkSession
    words = segments.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    blocks = max(1, -(-words // block_words))
    own = F.pmod(F.xxhash64("item", "segment"), F.lit(blocks))
    frequency = materialize(index.postings.groupBy("term").agg(F.sum("n").alias("places")), "term-frequencies")
    found = None
    for number in range(blocks):
        block = segments.filter(own == number)
        terms = block.select(F.explode("words").alias("term")).distinct()
        # a block has about BLOCK_WORDS words, so this is what the driver gets whatever the tables hold
        known = {r["term"]: r["places"] for r in frequency.join(terms, "term", "left_semi").collect()}
        phrases = _phrases(block.collect(), known)
        if phrases is None:
            continue
        wanted = index.table
        if blocks > 1:
            wanted = wanted.join(terms, "term", "left_semi").unionByName(wanted.filter("term is null"))
        shared = spark.sparkContext.broadcast(phrases)
        rows = wanted.select("shard", "term", "n", "places", "begin", "row").groupBy("shard").applyInArrow(search(shared), schema)
        rows = materialize(rows, label)
        found = rows if found is None else found.unionByName(rows)
    return spark.createDataFrame([], schema) if found is None else found


def _prepared(
    docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str,
    window: int, shard_words: int, vocabulary_terms: int,
) -> tuple[Index, DataFrame]:
    segments = test_segments(items, item_col, item_text_col, window)
    terms = materialize(segments.select(F.explode("words").alias("term")).distinct(), "test-terms")
    # the terms are broadcast below the bound; beyond it the index holds all words
    known = [r[0].encode() for r in terms.collect()] if terms.count() <= vocabulary_terms else None
    return build_index(docs, id_col, text_col, known, shard_words, window), segments


def matches(
    docs: DataFrame,
    items: DataFrame,
    reach: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    vocabulary_terms: int = VOCABULARY_TERMS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Where test texts occur: id, item, begin, end (words of the document, from 0), row (a number for each document).

    Without ``reach``, spans covered by exact occurrences of windows of the item, overlapping ones joined. With
    ``reach``, places of a window's rarest word around which all its other words stand within that many words, in
    any order (proximity); neighbouring places are joined. NULL or empty texts have no matches.
    """
    index, segments = _prepared(docs, items, id_col, text_col, item_col, item_text_col, window, shard_words, vocabulary_terms)
    found = _searched(
        index, segments, lambda block: _matched(block, reach), "row bigint, item string, begin bigint, end bigint", "matches", block_words
    )
    # blocks may cut a span of a long item: join what overlaps or touches
    earlier = Window.partitionBy("row", "item").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    apart = F.coalesce(F.max("end").over(earlier) < F.col("begin"), F.lit(True)).cast("int")
    upto = Window.partitionBy("row", "item").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, 0)
    spans = found.withColumn("apart", apart).withColumn("span", F.sum("apart").over(upto))
    whole = spans.groupBy("row", "item", "span").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    names = index.documents.select(F.col("row").alias("_row"), F.col("id").alias(id_col))
    return whole.join(names, F.col("row") == F.col("_row")).select(id_col, "item", "begin", "end", "row")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    vocabulary_terms: int = VOCABULARY_TERMS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: id, n_words, n_hit (words inside an occurrence of a window), items, spans.

    ``items`` are the ids, as text and sorted, of the test texts with such windows; ``spans`` are the hit words.
    NULL or empty texts have no words and are not hit; repeated rows are documents of their own; test texts that
    repeat an id are one item, one with a NULL id is the item ''. Spans are sorted. An empty table of documents gives no rows, an empty
    one of items no hits. Other columns are ignored.
    """
    index, segments = _prepared(docs, items, id_col, text_col, item_col, item_text_col, window, shard_words, vocabulary_terms)
    found = _searched(
        index, segments, _contaminated, "row bigint, spans array<struct<begin:bigint,end:bigint>>, items array<string>", "contaminated", block_words
    )
    by_row = found.groupBy(F.col("row").alias("_row")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
    )
    # spans of different blocks may overlap: each adds what lies beyond the ends before it
    none = F.struct(F.lit(0).cast("bigint").alias("words"), F.lit(0).cast("bigint").alias("end"))

    def added(done: Column, span: Column) -> Column:
        beyond = F.greatest(span["end"] - F.greatest(span["begin"], done["end"]), F.lit(0))
        return F.struct((done["words"] + beyond).alias("words"), F.greatest(done["end"], span["end"]).alias("end"))

    hit = F.aggregate("spans", none, added, lambda done: done["words"])
    return index.documents.join(by_row, F.col("row") == F.col("_row"), "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce(hit, F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        "spans",
    )
