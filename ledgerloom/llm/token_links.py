"""Links between the tokens of two tokenizers on the same text, by sparse products of incidence matrices.

A tokenizer's matrix has a row for each token occurrence and a column for each byte; the product of one matrix with the
other's transpose has an entry for each pair of tokens that share bytes. Where both end at the same byte, the text is
cut into groups, and the product of the token-group matrices has an entry for each pair in the same group. Matrices
are in compressed rows (CSR) built here, products are Gustavson's row by row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ledgerloom.llm.token_counts import LONG, Hashes, byte_letters, character_classes, code_points, pre_token_starts
from ledgerloom.sources.workspace import materialize

# bounds: characters encoded at once, products expanded at once, pre-tokens a task remembers
CHUNK_CHARS = 1_000_000
PRODUCTS = 2_000_000
REMEMBERED = 1_000_000
# the piece model writes a space so (fixed value)
SPACE_MARK = "▁"


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indexes starts[i] .. starts[i] + sizes[i] - 1 of every i, one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


@dataclass(frozen=True)
class Rows:
    """A sparse matrix in compressed rows: the entries of row i are ``columns[start[i]:start[i + 1]]``."""

    start: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    def transposed(self) -> Rows:
        # a stable sort of what is sorted already, as tokens in their order are, takes one pass
        order = np.argsort(self.columns, kind="stable")
        row = np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))
        start = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Rows(start, row[order], self.values[order], len(self.start) - 1)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start)), self.columns


def byte_incidence(ends: np.ndarray) -> Rows:
    """Token occurrences against bytes, for tokens that end at ``ends`` and lie end to end from byte 0."""
    size = int(ends[-1]) if len(ends) else 0
    return Rows(np.concatenate([[0], ends]).astype(np.int64), np.arange(size), np.ones(size, dtype=np.int64), size)


def group_incidence(groups: np.ndarray, count: int) -> Rows:
    """Token occurrences against the groups they lie in, one entry each."""
    return Rows(np.arange(len(groups) + 1), groups.astype(np.int64), np.ones(len(groups), dtype=np.int64), count)


def product(left: Rows, right: Rows) -> Rows:
    """``left`` times ``right`` by Gustavson: row i is the sum of the rows of ``right`` that row i of ``left`` names.

    Rows are taken together up to ``PRODUCTS`` single products (a row with more is taken alone).
    """
    reach = np.diff(right.start)[left.columns]
    upto = np.concatenate([[0], np.cumsum(reach)])[left.start]
    rows, sizes, columns, values, begin = len(left.start) - 1, [], [], [], 0
    while begin < rows:
        end = max(begin + 1, int(np.searchsorted(upto, upto[begin] + PRODUCTS, side="right")) - 1)
        own = slice(left.start[begin], left.start[end])
        picked, width = left.columns[own], reach[own]
        row = np.repeat(np.repeat(np.arange(begin, end), np.diff(left.start[begin : end + 1])), width)
        at = ragged(right.start[picked], width)
        key = row * right.width + right.columns[at]
        value = np.repeat(left.values[own], width) * right.values[at]
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
        sizes.append(np.bincount(key[first] // right.width - begin, minlength=end - begin))
        columns.append(key[first] % right.width)
        values.append(np.add.reduceat(value, first) if len(first) else value)
        begin = end
    joined = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (sizes, columns, values)]
    return Rows(np.concatenate([[0], np.cumsum(joined[0])]).astype(np.int64), joined[1], joined[2], right.width)


@dataclass(frozen=True)
class Alignment:
    """Two tokenisations of the same bytes: overlap links (with shared bytes), links that end together, groups."""

    overlaps: Rows
    ending: tuple[np.ndarray, np.ndarray]
    group_a: np.ndarray
    group_b: np.ndarray
    ends: np.ndarray

    def group_links(self) -> Rows:
        """All pairs of tokens in the same group."""
        count = len(self.ends)
        return product(group_incidence(self.group_a, count), group_incidence(self.group_b, count).transposed())


def align(sizes_a: np.ndarray, sizes_b: np.ndarray) -> Alignment:
    """Align token occurrences of these byte lengths; both must add up to the same bytes."""
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    overlaps = product(byte_incidence(ends_a), byte_incidence(ends_b).transposed())
    a, b = overlaps.entries()
    together = ends_a[a] == ends_b[b]
    a, b = a[together], b[together]

    def groups(size: int, last: np.ndarray) -> np.ndarray:
        ended = np.zeros(size + 1, dtype=np.int64)
        ended[last + 1] = 1
        return np.cumsum(ended)[:-1]

    return Alignment(overlaps, (a, b), groups(len(ends_a), a), groups(len(ends_b), b), ends_a[a])


@dataclass(frozen=True)
class Tokenizers:
    """What tasks need: both vocabulary files and the character classes of the first one's pre-tokens."""

    json: str
    model: bytes
    classes: np.ndarray


def load_tokenizers(json_path: str, model_path: str) -> Tokenizers:
    with open(model_path, "rb") as file:
        model = file.read()
    tokenizer = Tokenizer.from_file(json_path)
    return Tokenizers(tokenizer.to_str(), model, character_classes(tokenizer))


class Encoder:
    """Encodes batches of texts with both tokenizers; one for each task."""

    def __init__(self, files: Tokenizers):
        tokenizer = Tokenizer.from_str(files.json)
        self.bpe, self.pieces, self.classes = tokenizer.model, SentencePieceProcessor(model_proto=files.model), files.classes
        letters = byte_letters()
        self.letters, byte = dict(enumerate(letters)), {c: b for b, c in enumerate(letters)}
        ordinary = {i: t for t, i in tokenizer.get_vocab(with_added_tokens=False).items()}
        self.bytes_a = [bytes(byte.get(c, 0) for c in ordinary.get(i, "")) for i in range(max(ordinary, default=-1) + 1)]
        sp = self.pieces
        self.bytes_b = [
            bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(SPACE_MARK, " ").encode()
            for i in range(sp.get_piece_size())
        ]
        self.sizes_a = np.asarray([len(t) for t in self.bytes_a])
        self.sizes_b = np.asarray([len(t) for t in self.bytes_b])
        self.names_a = [f"{i}{mark}".encode() for mark in ",|" for i in range(len(self.bytes_a))]
        self.names_b = [f"{i}{mark}".encode() for mark in ",;" for i in range(len(self.bytes_b))]
        self.hashes = Hashes()
        self.seen: dict[int, list[int]] = {}

    def _merged(self, piece: str) -> list[int]:
        return [t.id for t in self.bpe.tokenize(piece.encode("utf-8", "replace").decode("latin-1").translate(self.letters))]

    def first(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts by the byte-level vocabulary, and how many each text has.

        Every different pre-token goes through the merges once; those of up to 64 characters are told apart by
        a 64-bit hash and remembered in the task.
        """
        text = "".join(texts)
        codes = code_points(text)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        begins = np.cumsum(lengths) - lengths
        segment = np.zeros(len(codes), dtype=bool)
        segment[begins] = True
        starts = np.flatnonzero(pre_token_starts(codes, self.classes, segment))
        ends = np.append(starts[1:], len(codes))
        hashes = self.hashes.of(codes, starts, ends)
        long = np.flatnonzero(ends - starts > LONG)
        hashes[long] = np.arange(len(long)) * 2  # even, so unlike any hash
        once, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        seen, found = self.seen, []
        for key, a, b in zip(once.tolist(), starts[first].tolist(), ends[first].tolist()):
            ids = None if b - a > LONG else seen.get(key)
            if ids is None:
                ids = self._merged(text[a:b])
                if b - a <= LONG:
                    seen[key] = ids
            found.append(ids)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(sizes.sum()))
        ids = flat[ragged((np.cumsum(sizes) - sizes)[place], sizes[place])]
        upto = np.concatenate([[0], np.cumsum(sizes[place])])
        return ids, np.diff(upto[np.append(np.searchsorted(starts, begins), len(starts))])

    def second(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts by the piece model, and how many each text has."""
        found = self.pieces.encode(list(texts), num_threads=1)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(sizes.sum())), sizes

    def links(self, texts: Sequence[str | None]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, links, groups) of each text; a link is the number a id * 2**16 + b id.

        ``groups`` is the digest of the ids by group; texts without tokens have zeros and ''.
        """
        out: list[tuple] = [(0, 0, 0, 0, b"", "")] * len(texts)
        asked = [at for at, text in enumerate(texts) if text]
        if not asked:
            return out
        plain = [texts[at] for at in asked]
        spaced = [" " + text for text in plain]
        (ids_a, n_a), (ids_b, n_b) = self.first(spaced), self.second(plain)
        raw = [text.encode("utf-8", "surrogatepass") for text in spaced]
        equal = self._given_back(raw, ids_a, n_a, self.bytes_a) & self._given_back(raw, ids_b, n_b, self.bytes_b)
        ids_a, ids_b = ids_a[np.repeat(equal, n_a)], ids_b[np.repeat(equal, n_b)]
        n_a, n_b, asked = n_a[equal], n_b[equal], np.asarray(asked)[equal].tolist()
        if not asked:
            return out
        found = align(self.sizes_a[ids_a], self.sizes_b[ids_b])
        a, b = found.ending
        codes = ((ids_a[a] << 16) | ids_b[b]).astype("<u4")
        # texts end together, so no link or group reaches over the end of one
        last = np.cumsum(n_a)
        n_links = np.diff(np.searchsorted(a, last), prepend=0)
        n_groups = np.diff(found.group_a[last - 1] + 1, prepend=0)
        texts_of = self._spelled(ids_a, ids_b, found)
        at, place = 0, 0
        for number, doc in enumerate(asked):
            links, size = int(n_links[number]), int(n_a[number] + n_b[number])
            digest = hashlib.sha256(b"".join(texts_of[place : place + size])[:-1]).hexdigest()
            out[doc] = (int(n_a[number]), int(n_b[number]), int(n_groups[number]), links, codes[at : at + links].tobytes(), digest)
            at, place = at + links, place + size
        return out

    @staticmethod
    def _given_back(raw: list[bytes], ids: np.ndarray, counts: np.ndarray, table: list[bytes]) -> np.ndarray:
        """Whether the joined bytes of the tokens are those of the text, for each text."""
        given = list(map(table.__getitem__, ids.tolist()))
        stops = np.cumsum(counts).tolist()
        return np.asarray([b"".join(given[stop - count : stop]) == text for text, count, stop in zip(raw, counts.tolist(), stops)])

    def _spelled(self, ids_a: np.ndarray, ids_b: np.ndarray, found: Alignment) -> list[bytes]:
        """The ids with the mark that follows each: group by group, first the A ids, then the B ids."""
        groups = len(found.ends)
        per_a, per_b = np.bincount(found.group_a, minlength=groups), np.bincount(found.group_b, minlength=groups)
        before_a, before_b = np.cumsum(per_a) - per_a, np.cumsum(per_b) - per_b
        spelled = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        last_a = np.append(found.group_a[1:] != found.group_a[:-1], True)
        last_b = np.append(found.group_b[1:] != found.group_b[:-1], True)
        spelled[np.arange(len(ids_a)) + before_b[found.group_a]] = ids_a + last_a * len(self.bytes_a)
        shift = len(self.names_a)
        spelled[np.arange(len(ids_b)) + (before_a + per_a)[found.group_b]] = shift + ids_b + last_b * len(self.bytes_b)
        names = self.names_a + self.names_b
        return list(map(names.__getitem__, spelled.tolist()))


def _linked(shared, names: list[str]):
    kinds = [pa.int64()] * 4 + [pa.binary(), pa.string()]

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            begin, chars = 0, 0
            sizes = [len(t.as_buffer()) if t.is_valid else 0 for t in batch.column(1)]
            for at, size in enumerate(sizes):
                chars += size
                if chars >= CHUNK_CHARS or at == len(sizes) - 1:
                    rows = encoder.links(batch.column(1).slice(begin, at + 1 - begin).to_pylist())
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, at + 1 - begin), *columns], names=names)
                    begin, chars = at + 1, 0

    return linked


def token_links(docs: DataFrame, json_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Work table with one row per input row: id, n_a, n_b, n_groups, n_links, links, groups_sha256.

    ``links`` holds the pairs that end together in order, as little-endian 32-bit numbers a id * 2**16 + b id. A
    text that is NULL, empty or not given back byte for byte by both tokenizers has zeros and ''. A map over the rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_tokenizers(json_path, model_path))
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_a", "n_b", "n_groups", "n_links", "links", "groups_sha256"]
    schema = f"`{id_col}` {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, links binary, groups_sha256 string"
    return materialize(docs.select(F.col(id_col), F.col(text_col)).mapInArrow(_linked(shared, names), schema), "token-links")


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes, counts = np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)
    for batch in batches:
        more, extra = np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype="<u4"), return_counts=True)
        codes, place = np.unique(np.concatenate([codes, more]), return_inverse=True)
        counts = np.bincount(place, weights=np.concatenate([counts, extra]), minlength=len(codes)).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(counts)], names=["pair", "n"])


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n): in how many links of the whole table each id pair is.

    Tokens that end together are suffixes of one another, so there are no more pairs than bytes in both
    vocabularies together (about half a million), however large the corpus; tasks add up their own first.
    """
    return links.select("links").mapInArrow(_tallied, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def _scored(shared):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, best = shared.value
        for batch in batches:
            lists = batch.column("links")
            raw = [b.as_buffer() for b in lists]
            size = np.fromiter((len(b) // 4 for b in raw), dtype=np.int64, count=len(raw))
            at = np.searchsorted(codes, np.frombuffer(b"".join(raw), dtype="<u4"))
            owner = np.repeat(np.arange(len(raw)), size)
            n_best = np.bincount(owner[best[at]], minlength=len(raw))
            upto = np.concatenate([[0], np.cumsum(counts[at])])
            stop = np.cumsum(size)
            total = upto[stop] - upto[stop - size]
            kept = [batch.column(n) for n in batch.schema.names if n != "links"]
            names = [n for n in batch.schema.names if n != "links"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n_best, pa.int64()), pa.array(total, pa.int64())], names=[*names, "n_best", "count_sum"])

    return scored


def aligned_tokens(docs: DataFrame, json_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum.

    ``n_best`` counts the links whose pair is, over all documents, the most frequent of its second id (ties
    included), ``count_sum`` adds up the counts of the links' pairs. Texts without tokens (see ``token_links``) have
    zeros and ''. Repeated rows are rows of their own and are counted each; an empty table gives no rows; other columns
    are ignored.
    """
    links = token_links(docs, json_path, model_path, id_col, text_col)
    counted = pair_counts(links).orderBy("pair").toArrow()
    codes = counted.column("pair").to_numpy().astype("<u4")
    counts = counted.column("n").to_numpy().astype(np.int64)
    top = np.zeros(1 << 16, dtype=np.int64)
    np.maximum.at(top, codes & 0xFFFF, counts)
    shared = docs.sparkSession.sparkContext.broadcast((codes, counts, counts == top[codes & 0xFFFF]))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint"
    return links.mapInArrow(_scored(shared), schema)
