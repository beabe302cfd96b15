"""Token counts by the whole-token shortcut.

Offline it is proved which strings of the vocabulary encode, alone, as exactly one token. Texts are cut
into pre-tokens for a whole batch at once from character classes; pre-tokens that are such strings
count one each through a hash table, and only the different remaining ones go through the merges.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import astuple, dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import PreTokenizer

SPACE, LETTER, NUMBER, OTHER = range(4)
# code points put to the library at once
PROBED = 128
# pre-tokens above this length are compared as text, below by a 64-bit polynomial hash
LONG = 64
CHUNK_CHARS = 1_000_000
REMEMBERED = 500_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 18


def _joined(split: PreTokenizer, lead: str, text: str) -> int:
    """How many characters at the head of ``text`` the library leaves in one pre-token with ``lead``."""
    return split.pre_tokenize_str(lead + text)[0][1][1] - 1


@cache
def _probed(serialized: str) -> bytes:
    split = Tokenizer.from_str(serialized).pre_tokenizer
    leads = {LETTER: "A", NUMBER: "1", OTHER: "!"}
    table, guessed = np.full(0x110000, OTHER, dtype=np.uint8), {kind: [] for kind in leads}
    kinds = {"L": LETTER, "N": NUMBER}
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000:  # surrogates are no characters
            guessed[kinds.get(unicodedata.category(chr(code))[0], OTHER)].append(chr(code))
    for guess, lead in leads.items():
        for begin in range(0, len(guessed[guess]), PROBED):
            rest = "".join(guessed[guess][begin : begin + PROBED])
            while rest:
                right = _joined(split, lead, rest)
                table[[ord(c) for c in rest[:right]]] = guess
                if right < len(rest):
                    wrong = rest[right]
                    table[ord(wrong)] = next((k for k, l in leads.items() if _joined(split, l, wrong)), SPACE)
                rest = rest[right + 1 :]
    return table.tobytes()


def character_classes(tokenizer: Tokenizer) -> np.ndarray:
    """Class of every code point as the library's own pre-tokenizer has it: white space, letter, number, other.

    Python's character tables are another Unicode version than the library's, so they are only a first guess: every
    code point is put to the library, many of one guess at once after a character known to be of that class.
    """
    return np.frombuffer(_probed(tokenizer.to_str()), dtype=np.uint8)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """What tasks need: the tokenizer, its special strings and the proven whole tokens as hashes."""

    tokenizer_json: str
    specials: tuple[str, ...]
    classes: np.ndarray
    slots: np.ndarray
    rounds: int


def _mixed(codes: np.ndarray) -> np.ndarray:
    x = codes.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


class Hashes:
    """Hashes of many substrings of one code point array, by prefix sums."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.up) <= size:
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            self.up, self.down = np.full(size + 1, _BASE), np.full(size + 1, inverse)
            self.up[0] = self.down[0] = 1
            np.multiply.accumulate(self.up, out=self.up)
            np.multiply.accumulate(self.down, out=self.down)

    def of(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._grow(len(codes))
        sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(_mixed(codes) * self.up[: len(codes)], out=sums[1:])
        found = (sums[ends] - sums[starts]) * self.down[starts]
        found ^= found >> np.uint64(32)
        return found | np.uint64(1)  # never 0, the mark of an empty slot


def _slot(hashes: np.ndarray, turn: int) -> np.ndarray:
    mixed = hashes * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed >> np.uint64(64 - _SLOT_BITS)).astype(np.int64) + turn) & ((1 << _SLOT_BITS) - 1)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def pre_token_starts(codes: np.ndarray, classes: np.ndarray, segment_start: np.ndarray) -> np.ndarray:
    """True where a pre-token starts, for texts laid end to end (``segment_start`` marks their first characters).

    Pre-tokens are runs of one class with these exceptions: the last white space before a run is a
    pre-token of its own, or part of the run if it is a space; an apostrophe alone takes the letters
    of a contraction with it.
    """
    size = len(codes)
    kind = classes[codes]
    start = segment_start.copy()
    start[1:] |= kind[1:] != kind[:-1]
    after_space = np.flatnonzero(start[1:] & ~segment_start[1:] & (kind[:-1] == SPACE)) + 1
    start[after_space - 1] = True
    start[after_space[codes[after_space - 1] == 0x20]] = False
    mark = np.flatnonzero((codes[:-1] == 0x27) & start[:-1] & (kind[1:] == LETTER) & ~segment_start[1:])
    if len(mark):
        first = codes[mark + 1]
        third = np.minimum(mark + 2, size - 1)
        inside = (mark + 2 < size) & ~segment_start[third]
        second = np.where(inside, codes[third], 0)
        short = np.isin(first, [ord(c) for c in "stmd"])
        pair = ((first == ord("r")) | (first == ord("v"))) & (second == ord("e")) | (first == ord("l")) & (second == ord("l"))
        hit = short | pair
        start[mark[hit] + 1] = False
        end = mark[hit] + np.where(short[hit], 2, 3)
        end = end[end < size]
        start[end[(kind[end] == LETTER)]] = True
    return start


def load_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level BPE file and prove its whole tokens. Runs once, on the driver; its size is the file's."""
    tokenizer = Tokenizer.from_file(path)
    letters = {c: b for b, c in enumerate(byte_letters())}
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    whole = []
    for token in tokenizer.get_vocab(with_added_tokens=False):
        if token not in special and len(tokenizer.model.tokenize(token)) == 1:
            try:
                whole.append(bytes(letters[c] for c in token).decode())
            except (UnicodeDecodeError, KeyError):
                pass  # part of a character: never a whole pre-token
    whole = [w for w in whole if w and len(w) <= LONG]
    codes = code_points("".join(whole))
    ends = np.cumsum([len(w) for w in whole])
    hashes = np.unique(Hashes().of(codes, np.concatenate([[0], ends[:-1]]), ends))
    slots, turn = np.zeros(1 << _SLOT_BITS, dtype=np.uint64), 0
    while len(hashes):
        at = _slot(hashes, turn)
        at, index = np.unique(at, return_index=True)
        free = slots[at] == 0
        slots[at[free]] = hashes[index[free]]
        hashes = hashes[slots[_slot(hashes, turn)] != hashes]
        turn += 1
    return Vocabulary(tokenizer.to_str(), tuple(special), character_classes(tokenizer), slots, turn)


class Counter:
    """Counts the tokens of batches of texts; one per task."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.model = Tokenizer.from_str(vocabulary.tokenizer_json).model
        self.letters = dict(enumerate(byte_letters()))
        self.hashes = Hashes()
        self.seen: dict[int, int] = {}

    def merged(self, piece: str) -> int:
        """Tokens of one pre-token, through the merges."""
        return len(self.model.tokenize(piece.encode("utf-8", "replace").decode("latin-1").translate(self.letters)))

    def _merged_once(self, text: str, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Counts of different pre-tokens; those seen lately in this task are remembered."""
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        seen, sizes = self.seen, []
        for key, a, b in zip(hashes.tolist(), starts.tolist(), ends.tolist()):
            size = seen.get(key)
            if size is None:
                size = seen[key] = self.merged(text[a:b])
            sizes.append(size)
        return np.asarray(sizes, dtype=np.int64)

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        known = np.zeros(len(hashes), dtype=bool)
        open_ = np.arange(len(hashes))
        for turn in range(self.vocabulary.rounds):
            held = self.vocabulary.slots[_slot(hashes[open_], turn)]
            known[open_[held == hashes[open_]]] = True
            open_ = open_[(held != hashes[open_]) & (held != 0)]
        return known

    def _segments(self, texts: Sequence[str | None]) -> tuple[list[str], list[int], np.ndarray]:
        segments, owner, extra = [], [], np.zeros(len(texts), dtype=np.int64)
        for at, text in enumerate(texts):
            parts = [text or ""]
            for special in self.vocabulary.specials:
                parts = [p for part in parts for p in part.split(special)]
            extra[at] = len(parts) - 1
            segments += [p for p in parts if p]
            owner += [at for p in parts if p]
        return segments, owner, extra

    def count(self, texts: Sequence[str | None]) -> np.ndarray:
        segments, owner, counts = self._segments(texts)
        if not segments:
            return counts
        text = "".join(segments)
        codes = code_points(text)
        lengths = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
        segment_start = np.zeros(len(codes), dtype=bool)
        segment_start[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = True
        starts = np.flatnonzero(pre_token_starts(codes, self.vocabulary.classes, segment_start))
        ends = np.append(starts[1:], len(codes))
        tokens = np.ones(len(starts), dtype=np.int64)
        long = ends - starts > LONG
        hashes = self.hashes.of(codes, starts, ends)
        rest = np.flatnonzero(~long)
        rest = rest[~self._known(hashes[rest])]
        _, first, place = np.unique(hashes[rest], return_index=True, return_inverse=True)
        once = rest[first]
        tokens[rest] = self._merged_once(text, hashes[once], starts[once], ends[once])[place]
        for at in np.flatnonzero(long):
            tokens[at] = self.merged(text[starts[at] : ends[at]])
        document = np.repeat(np.asarray(owner), lengths)[starts]
        return counts + np.bincount(document, weights=tokens, minlength=len(texts)).astype(np.int64)


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024
) -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit (more tokens than ``limit``).

    Counts are those of the vocabulary's own library without added special tokens; a special string
    inside a text is one token. NULL and empty texts have 0. Texts of any length are counted whole,
    batches of short texts are cut at ``CHUNK_CHARS``. A map over the rows, nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(astuple(load_vocabulary(path)))
    kind = docs.schema[id_col].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(Vocabulary(*shared.value))
        for batch in batches:
            texts = batch.column(2).to_pylist()
            counts, begin, chars = [np.zeros(0, dtype=np.int64)], 0, 0
            for at, text in enumerate(texts):
                chars += len(text or "")
                if chars >= CHUNK_CHARS or at == len(texts) - 1:
                    counts.append(counter.count(texts[begin : at + 1]))
                    begin, chars = at + 1, 0
            total = np.concatenate(counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(total), pa.array(total > limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(
        F.col(id_col),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.col(text_col),
    )
    return rows.mapInArrow(counted, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
