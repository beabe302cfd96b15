"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score of a document with features x is sigmoid(w0 + w.x + sum over pairs of <v_i, v_j> x_i x_j).
The pairs cost linear time: half of sum over factors of (V'x)^2 - (V^2)'x^2. It is trained with numpy on a
bounded sample of labelled rows and scores whole texts in a map over the rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.labelled import fold, labelled_sample

WORD_BUCKETS = 1 << 14
# metadata and structure statistics, each as a value and as one of BINS intervals
STATS = 14
BINS = 12
FACTORS = 8
TRAIN_ROWS = 8000
TRAIN_CHARS = 40_000
EPOCHS = 8
THRESHOLD = 0.3
_REMEMBERED = 500_000


class WordBuckets(dict):
    """Bucket of a word; words seen lately in a task are remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        found = self[word] = zlib.crc32(word.encode("utf-8", "replace")) % WORD_BUCKETS
        return found


def structure(text: str, words: list[str]) -> list[float]:
    """Metadata (sizes) and structure statistics of a text and its words, each about 0 to 1."""
    chars = max(len(text), 1)
    count = max(len(words), 1)
    sample = text.encode("utf-8", "replace")
    codes = np.bincount(np.frombuffer(sample, dtype=np.uint8), minlength=256) if sample else np.zeros(256, dtype=int)
    upper, lower = int(codes[65:91].sum()), int(codes[97:123].sum())
    digits, spaces, lines = int(codes[48:58].sum()), int(codes[9:14].sum() + codes[32]), int(codes[10]) + 1
    high = int((codes[0xC2:0xF5]).sum())
    ordinary = int(codes[44] + codes[46])
    marks = int(codes[33:48].sum() + codes[58:65].sum() + codes[91:97].sum() + codes[123:127].sum()) - ordinary
    letters = upper + lower + high
    repeats = sum(map(str.__eq__, words, words[1:])) if len(words) > 1 else 0
    different = len(set(words))
    return [
        math.log1p(len(text)) / 12,
        math.log1p(len(words)) / 10,
        upper / max(letters, 1),
        digits / chars,
        marks / chars * 4,
        codes[33] / count,
        codes[124] / count,
        ordinary / count,
        spaces / chars * 3,
        repeats / count,
        different / count,
        math.log(count / different) / 6 if words else 0.0,
        min(letters / count / 12, 1.0),
        min(lines / count * 4, 1.0),
    ]


def features(text: str | None, buckets: WordBuckets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(statistics, word buckets, their weights); the weights of the words have length 1 together."""
    text = text or ""
    words = text.split()
    ids, counts = np.unique(np.fromiter(map(buckets.__getitem__, words), np.int64, len(words)), return_counts=True)
    weights = np.sqrt(counts)
    norm = np.sqrt((weights * weights).sum())
    return np.asarray(structure(text, words)), ids, weights / norm if len(ids) else weights


def encode(stats: np.ndarray, edges: np.ndarray, ids: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One sparse row: words, then values of the statistics, then their intervals."""
    bins = np.array([np.searchsorted(edges[s], stats[s], side="right") for s in range(STATS)])
    at = WORD_BUCKETS + np.arange(STATS)
    spread = WORD_BUCKETS + STATS + np.arange(STATS) * BINS + bins
    return np.concatenate([ids, at, spread]), np.concatenate([weights, np.clip(stats, -2, 2), np.ones(STATS)])


SIZE = WORD_BUCKETS + STATS + STATS * BINS


@dataclass(frozen=True)
class Machine:
    edges: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        taken = self.factors[index] * value[:, None]
        total = taken.sum(axis=0)
        pairs = 0.5 * float((total * total).sum() - (taken * taken).sum())
        z = self.bias + float(self.linear[index] @ value) + pairs
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def train(rows: Sequence[tuple[np.ndarray, np.ndarray, np.ndarray, int]], seed: int = 7) -> Machine:
    """Fit on (statistics, word buckets, weights, label) by AdaGrad; the same rows give the same machine.

    Without rows of both labels the machine is the share of label 1 (0.5 without rows).
    """
    labels = np.array([r[3] for r in rows], dtype=float)
    share = (labels.sum() + 1) / (len(labels) + 2)
    bias = math.log(share / (1 - share))
    rng = np.random.default_rng(seed)
    linear, factors = np.zeros(SIZE), rng.normal(0, 0.02, (SIZE, FACTORS))
    if not len(labels) or labels.min() == labels.max():
        return Machine(np.zeros((STATS, BINS - 1)), bias, linear, factors * 0)
    stats = np.stack([r[0] for r in rows])
    edges = np.stack([np.quantile(stats[:, s], np.arange(1, BINS) / BINS) for s in range(STATS)])
    sparse = [encode(r[0], edges, r[1], r[2]) for r in rows]
    seen_linear, seen_factors, seen_bias = np.full(SIZE, 1e-2), np.full((SIZE, FACTORS), 1e-2), 1e-2
    for epoch in range(EPOCHS):
        rate = 0.1 / (1 + epoch * 0.3)
        for at in rng.permutation(len(rows)):
            index, value = sparse[at]
            taken = factors[index] * value[:, None]
            total = taken.sum(axis=0)
            z = bias + linear[index] @ value + 0.5 * ((total * total).sum() - (taken * taken).sum())
            error = 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - labels[at]
            to_linear = error * value + 1e-5 * linear[index]
            to_factors = error * (value[:, None] * (total - taken)) + 1e-5 * factors[index]
            seen_linear[index] += to_linear**2
            seen_factors[index] += to_factors**2
            seen_bias += error**2
            linear[index] -= rate * to_linear / np.sqrt(seen_linear[index])
            factors[index] -= rate * 0.3 * to_factors / np.sqrt(seen_factors[index])
            bias -= rate * 0.3 * error / math.sqrt(seen_bias)
    return Machine(edges, float(bias), linear, factors)


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality", rows: int = TRAIN_ROWS) -> Machine:
    """Machine for ``label``, from at most ``rows`` labelled rows of at most ``TRAIN_CHARS`` characters."""

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = WordBuckets()
        for batch in batches:
            found = [features(t, buckets) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)]
                + [pa.array([f[part].astype(kind).tobytes() for f in found], pa.binary()) for part, kind in enumerate(("f8", "i8", "f8"))],
                names=["id", "label", "stats", "words", "weights"],
            )

    sample = labelled_sample(docs, labels, label, held_out, rows, TRAIN_CHARS)
    sample = sample.select(F.col("_id").cast("string").alias("id"), F.col("_label").alias("label"), "text")
    found = sample.mapInArrow(featured, "id string, label int, stats binary, words binary, weights binary").collect()
    found.sort(key=lambda r: (r.id or "", r.label, bytes(r.words), bytes(r.stats)))
    return train([
        (np.frombuffer(r.stats), np.frombuffer(r.words, dtype=np.int64), np.frombuffer(r.weights), r.label) for r in found
    ])


def scored(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` of every row. NULL and empty texts are scored as texts without words."""
    shared = docs.sparkSession.sparkContext.broadcast(astuple(machine))
    kind = docs.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, buckets = Machine(*shared.value), WordBuckets()
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                stats, ids, weights = features(text, buckets)
                found.append(model.score(*encode(stats, model.edges, ids, weights)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=[id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(score, f"`{id_col}` {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Learns from labelled rows outside the held-out fold only; lang, source, labels and ids are no
    features. Documents without a label, without text or with an unknown id are scored like others
    (a NULL id is never held out); an empty table gives no rows.
    """
    machine = fit(docs, labels, F.coalesce(fold(F.col("doc_id"), folds) == held_fold, F.lit(True)))
    out = scored(docs, machine)
    return out.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), folds) == held_fold, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those the classifier rejects, all columns as they were, in one map over the rows."""
    machine = fit(docs, labels, F.coalesce(fold(F.col("doc_id"), folds) == held_fold, F.lit(True)))
    shared = docs.sparkSession.sparkContext.broadcast(astuple(machine))

    def kept(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, buckets = Machine(*shared.value), WordBuckets()
        for batch in texts:
            yield pa.array([model.score(*encode(s, model.edges, i, w)) >= threshold for s, i, w in (features(t, buckets) for t in batch.to_pylist())], pa.bool_())

    return docs.filter(F.arrow_udf(kept, "boolean")(F.col("text")))
