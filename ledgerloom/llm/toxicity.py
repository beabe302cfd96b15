"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A step of the network is a word. Its input joins a character part (mean embeddings of hashed character
n-grams, so that unseen forms of a word stay near the seen ones) and a word part (a hashed embedding), each
with the evidence the labels give for it: log odds of the n-gram or word in documents of label 1. States of
both directions are pooled by attention to one logit per window. All overlapping windows of the whole text
are scored; a document's score weighs its worst windows, their share and their number. Since inputs depend
on the word alone, each task projects a word once and then only looks it up.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.labelled import fold, labelled_sample

WINDOW, STRIDE = 32, 16
STATE = 12
CHAR_BUCKETS, CHAR_SIZE, GRAMS = 1 << 14, 8, (3, 4, 5, 6)
WORD_BUCKETS, WORD_SIZE = 1 << 12, 4
# evidence: hashed n-grams and words share one table
ODDS_BUCKETS, EVIDENCE = 1 << 19, 3
TRAIN_FOLDS = 4
SUMMARY = 7
TRAIN_ROWS = 3000
TRAIN_CHARS = 8_000
THRESHOLD = 0.3
_REMEMBERED = 150_000
_BATCH_WINDOWS = 2048
EPOCH_ROWS, EPOCHS = 18_000, (4, 30)
_WORDS = re.compile(r"\w+")

Params = dict[str, np.ndarray]


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def word_features(words: Sequence[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each n of GRAMS (n-gram hashes, first n-gram of each word); and the words' own hashes."""
    end = "\x03" * (max(GRAMS) - 1)
    marked = "".join(f"\x02{w}{end}" for w in words)
    codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + len(end) + 1
    owner = np.repeat(np.arange(len(words)), lengths)
    inner = np.arange(len(codes)) - np.repeat(np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    grams = []
    for n in GRAMS:
        count = len(codes) - n + 1
        rolled = np.full(count, n, dtype=np.uint64)
        for at in range(n):
            rolled = (rolled ^ codes[at : at + count]) * np.uint64(0x9E3779B97F4A7C15)
            rolled ^= rolled >> np.uint64(29)
        # up to two end marks, at least one n-gram for each word
        sizes = np.maximum(lengths - len(end) + 2 - n + 1, 1)
        inside = inner[:count] < sizes[owner[:count]]
        grams.append((rolled[inside], np.concatenate([[0], np.cumsum(sizes)[:-1]])))
    own = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) for w in words), np.uint64, len(words))
    return grams, own


def _counts(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.append(first, len(grams)))[:, None].astype(np.float32)


def _bucket(hashes: np.ndarray, size: int) -> np.ndarray:
    return (hashes % np.uint64(size)).astype(np.int64)


def evidence(odds: np.ndarray, features) -> np.ndarray:
    """Of each word the highest and the mean log odds of its n-grams, and its own."""
    grams, own = features
    found = [odds[_bucket(g, ODDS_BUCKETS)] for g, _ in grams]
    high = np.max([np.maximum.reduceat(o, first) for o, (_, first) in zip(found, grams)], axis=0)
    mean = sum(np.add.reduceat(o, first) / _counts(o, first)[:, 0] for o, (_, first) in zip(found, grams)) / len(grams)
    return np.stack([high, mean, odds[_bucket(own * np.uint64(31) + np.uint64(7), ODDS_BUCKETS)]], axis=1).astype(np.float32)


def log_odds(holds: np.ndarray, labels: np.ndarray, strength: float = 4.0) -> np.ndarray:
    """Shrunk log odds of label 1 by bucket, against the share of label 1; ``holds`` counts documents (label, bucket)."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    odds = np.log((holds[1] + strength * share) / (holds[0] + strength * (1 - share))) - np.log(share / (1 - share))
    return odds.astype(np.float32)


def inputs(params: Params, features, seen: np.ndarray) -> np.ndarray:
    grams, own = features
    chars = sum(np.add.reduceat(params["chars"][_bucket(g, CHAR_BUCKETS)], first, axis=0) / _counts(g, first) for g, first in grams)
    return np.concatenate([chars, params["words"][_bucket(own, WORD_BUCKETS)], seen], axis=1)


def initial(seed: int) -> Params:
    rng = np.random.default_rng(seed)

    def normal(scale, *shape):
        return rng.normal(0, scale, shape).astype(np.float32)

    size = CHAR_SIZE + WORD_SIZE + EVIDENCE
    return {
        "chars": normal(0.1, CHAR_BUCKETS, CHAR_SIZE),
        "words": normal(0.1, WORD_BUCKETS, WORD_SIZE),
        "in": normal(size**-0.5, size, 6 * STATE),
        "bias": np.zeros(6 * STATE, dtype=np.float32),
        "ahead": normal(STATE**-0.5, STATE, 3 * STATE),
        "back": normal(STATE**-0.5, STATE, 3 * STATE),
        "attend": normal(0.3, 2 * STATE),
        "out": normal(0.3, 2 * STATE),
        "shift": np.full(1, -2.0, dtype=np.float32),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(x: np.ndarray, mask: np.ndarray, recur: np.ndarray, order: Sequence[int], keep: bool):
    """Gated recurrence over the steps of ``order``: states (windows, steps, STATE) and what the backward pass needs."""
    count, steps, _ = x.shape
    h = np.zeros((count, STATE), dtype=np.float32)
    states = np.zeros((count, steps, STATE), dtype=np.float32)
    kept = []
    for t in order:
        a = h @ recur
        gates = _sigmoid(x[:, t, : 2 * STATE] + a[:, : 2 * STATE])
        z, r = gates[:, :STATE], gates[:, STATE:]
        new = np.tanh(x[:, t, 2 * STATE :] + r * a[:, 2 * STATE :])
        m = mask[:, t, None]
        if keep:
            kept.append((t, h, z, r, new, a[:, 2 * STATE :]))
        h = h + m * (1 - z) * (new - h)
        states[:, t] = h
    return states, kept


def _run_back(d_states: np.ndarray, mask: np.ndarray, recur: np.ndarray, kept):
    count, steps, _ = d_states.shape
    d_x = np.zeros((count, steps, 3 * STATE), dtype=np.float32)
    d_recur = np.zeros_like(recur)
    d_h = np.zeros((count, STATE), dtype=np.float32)
    for t, h, z, r, new, a_new in reversed(kept):
        d_h = d_h + d_states[:, t]
        m = mask[:, t, None]
        d_new = d_h * m * (1 - z) * (1 - new * new)
        d_z = -d_h * m * (new - h) * z * (1 - z)
        d_r = d_new * a_new * r * (1 - r)
        d_a = np.concatenate([d_z, d_r, d_new * r], axis=1)
        d_x[:, t] = np.concatenate([d_z, d_r, d_new], axis=1)
        d_recur += h.T @ d_a
        d_h = d_h * (1 - m * (1 - z)) + d_a @ recur.T
    return d_x, d_recur


def logits(params: Params, projected: np.ndarray, index: np.ndarray, keep: bool = False):
    """Logit of each window; ``index`` (windows, steps) holds rows of ``projected``, -1 past the end."""
    mask = (index >= 0).astype(np.float32)
    x = projected[index]
    steps = index.shape[1]
    ahead, kept_ahead = _run(x[:, :, : 3 * STATE], mask, params["ahead"], range(steps), keep)
    back, kept_back = _run(x[:, :, 3 * STATE :], mask, params["back"], range(steps - 1, -1, -1), keep)
    states = np.concatenate([ahead, back], axis=2)
    pull = states @ params["attend"] - 1e9 * (1 - mask)
    weight = np.exp(pull - pull.max(axis=1, keepdims=True)) * mask
    weight /= np.maximum(weight.sum(axis=1, keepdims=True), 1e-9)
    pooled = (states * weight[:, :, None]).sum(axis=1)
    z = pooled @ params["out"] + params["shift"][0]
    return (z, (mask, states, weight, pooled, kept_ahead, kept_back)) if keep else z


def gradients(params: Params, features, seen: np.ndarray, index: np.ndarray, labels: np.ndarray) -> Params:
    x = inputs(params, features, seen)
    projected = x @ params["in"] + params["bias"]
    z, (mask, states, weight, pooled, kept_ahead, kept_back) = logits(params, projected, index, True)
    d_z = (_sigmoid(z) - labels).astype(np.float32) / len(labels)
    grad = {"shift": d_z.sum(keepdims=True), "out": pooled.T @ d_z}
    d_pooled = d_z[:, None] * params["out"]
    d_weight = (states @ d_pooled[:, :, None])[:, :, 0]
    d_pull = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
    grad["attend"] = np.einsum("nts,nt->s", states, d_pull)
    d_states = weight[:, :, None] * d_pooled[:, None, :] + d_pull[:, :, None] * params["attend"]
    d_ahead, grad["ahead"] = _run_back(d_states[:, :, :STATE], mask, params["ahead"], kept_ahead)
    d_back, grad["back"] = _run_back(d_states[:, :, STATE:], mask, params["back"], kept_back)
    d_x = np.concatenate([d_ahead, d_back], axis=2)[index >= 0]
    d_projected = np.zeros_like(projected)
    np.add.at(d_projected, index[index >= 0], d_x)
    grad["bias"] = d_projected.sum(axis=0)
    grad["in"] = x.T @ d_projected
    d_input = d_projected @ params["in"].T
    grads, own = features
    grad["chars"] = np.zeros_like(params["chars"])
    for g, first in grads:
        each = d_input[:, :CHAR_SIZE] / _counts(g, first)
        np.add.at(grad["chars"], _bucket(g, CHAR_BUCKETS), np.repeat(each, np.diff(np.append(first, len(g))), axis=0))
    grad["words"] = np.zeros_like(params["words"])
    np.add.at(grad["words"], _bucket(own, WORD_BUCKETS), d_input[:, CHAR_SIZE : CHAR_SIZE + WORD_SIZE])
    return grad


def windows(ids: np.ndarray) -> np.ndarray:
    """All overlapping windows of a text's word ids, the last one filled up with -1; none without words."""
    if not len(ids):
        return np.zeros((0, WINDOW), dtype=np.int32)
    count = max(1, -(-(len(ids) - (WINDOW - STRIDE)) // STRIDE))
    padded = np.full((count - 1) * STRIDE + WINDOW, -1, dtype=np.int32)
    padded[: len(ids)] = ids
    return padded[np.arange(count)[:, None] * STRIDE + np.arange(WINDOW)]


class Words(dict):
    """Ids of words in the order they come."""

    def __missing__(self, word: str) -> int:
        self[word] = found = len(self)
        return found


def ids_of(text: str | None, known: Words) -> np.ndarray:
    found = words_of(text)
    return np.fromiter(map(known.__getitem__, found), np.int64, len(found))


def _all_logits(params: Params, projected: np.ndarray, index: np.ndarray) -> np.ndarray:
    parts = [logits(params, projected, index[a : a + _BATCH_WINDOWS]) for a in range(0, len(index), _BATCH_WINDOWS)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.float32)


def summary(found: np.ndarray) -> np.ndarray:
    """What a document's score is made of: its worst windows' logits, the mean share and the number of windows."""
    top = np.sort(found)[::-1]
    share = _sigmoid(found)
    ranked = [top[min(k, len(top) - 1)] for k in (0, 1, 2, 4)]
    return np.array([*np.clip(ranked, -12, 12), np.log1p(share.sum()) * 2, share.mean() * 4, np.log(len(found))])


def _logistic(x: np.ndarray, y: np.ndarray, decay: float = 1e-2) -> np.ndarray:
    """Weights (the last one the shift) of a logistic regression, by Newton steps."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = _sigmoid(x @ w)
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x + decay * np.eye(len(w)), x.T @ (p - y) + decay * w)
    return w


def _adam(params: Params, grad: Params, first: Params, second: Params, step: int, rate: float) -> None:
    for name, g in grad.items():
        if name in ("chars", "words", "in"):
            g = g + 1e-4 * params[name]
        first[name] = 0.9 * first[name] + 0.1 * g
        second[name] = 0.99 * second[name] + 0.01 * g * g
        change = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)
        params[name] = (params[name] - rate * change).astype(np.float32)


def train(rows: Sequence[tuple[str, int]], seed: int = 11, rate: float = 0.005) -> Params:
    """Fit on (text, label) with Adam; the same rows give the same network.

    The evidence that a training document sees comes from the other folds, so that it is as good as
    for unseen texts; afterwards it is taken from all rows. Labels are those of whole documents, so in
    each epoch the document's worst window stands for it, plus a random one where the label is 0. A
    logistic regression on the summaries then gives document scores. Without rows of both labels
    nothing is learnt.
    """
    params = initial(seed)
    labels = np.array([label for _, label in rows], dtype=np.float32)
    params["odds"] = np.zeros(ODDS_BUCKETS, dtype=np.float32)
    params["final"] = np.zeros(SUMMARY + 1)
    if not len(labels) or labels.min() == labels.max():
        params["final"][-1] = 4.0 if len(labels) and labels.max() > 0 else -4.0
        return params
    rng = np.random.default_rng(seed)
    folds = rng.permutation(len(rows)) % TRAIN_FOLDS
    # a word has a place of its own in each fold that holds it
    known = [Words() for _ in range(TRAIN_FOLDS)]
    texts = [ids_of(text, known[fold_]) for (text, _), fold_ in zip(rows, folds)]
    features = [word_features(list(words)) for words in known]
    holds = np.zeros((TRAIN_FOLDS, 2, ODDS_BUCKETS), dtype=np.float32)
    for fold_, (grams, own) in enumerate(features):
        buckets = [(_bucket(g, ODDS_BUCKETS), np.append(begin, len(g))) for g, begin in grams]
        single = _bucket(own * np.uint64(31) + np.uint64(7), ODDS_BUCKETS)
        for doc in np.flatnonzero(folds == fold_):
            words = np.unique(texts[doc])
            held = [single[words]] + [b[_spans(edge[words], edge[words + 1])] for b, edge in buckets]
            holds[fold_, int(labels[doc]), np.unique(np.concatenate(held))] += 1
    seen = np.concatenate(
        [evidence(log_odds(holds.sum(axis=0) - holds[f], labels[folds != f]), features[f]) for f in range(TRAIN_FOLDS)]
    )
    params["odds"] = log_odds(holds.sum(axis=0), labels)
    del holds
    base = np.concatenate([[0], np.cumsum([len(words) for words in known])])
    vocabulary = [word for words in known for word in words]
    cut = [windows(ids + base[fold_]) for ids, fold_ in zip(texts, folds)]
    owner = np.repeat(np.arange(len(rows)), [len(c) for c in cut])
    index, sizes = np.concatenate(cut), np.array([len(c) for c in cut])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    del cut, texts

    def all_logits() -> np.ndarray:
        tables = [
            inputs(params, f, seen[base[at] : base[at + 1]]) @ params["in"] + params["bias"] for at, f in enumerate(features)
        ]
        return _all_logits(params, np.concatenate(tables), index)

    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    step, epochs = 0, int(np.clip(EPOCH_ROWS // len(rows), *EPOCHS))
    for epoch in range(epochs):
        worst = np.lexsort((-all_logits(), owner))[starts[sizes > 0]]
        doc = owner[worst]
        negative = doc[labels[doc] == 0]
        extra = starts[negative] + rng.integers(0, sizes[negative])
        chosen = rng.permutation(np.concatenate([worst, extra]))
        for begin in range(0, len(chosen), 128):
            part = chosen[begin : begin + 128]
            batch = index[part]
            used, local = np.unique(batch[batch >= 0], return_inverse=True)
            small = np.full_like(batch, -1)
            small[batch >= 0] = local
            some = word_features([vocabulary[w] for w in used])
            step += 1
            grad = gradients(params, some, seen[used], small, labels[owner[part]])
            _adam(params, grad, first, second, step, rate * (1 - 0.8 * epoch / epochs))
    found = all_logits()
    some = np.flatnonzero(sizes)
    params["final"] = _logistic(np.stack([summary(found[starts[d] : starts[d] + sizes[d]]) for d in some]), labels[some])
    return params


def _spans(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All positions of the spans, one span after the other."""
    sizes = end - begin
    return np.repeat(end - np.cumsum(sizes), sizes) + np.arange(sizes.sum())


class Scorer:
    """Scores batches of texts; one per task."""

    def __init__(self, params: Params):
        self.params = params
        self._forget()

    def _forget(self) -> None:
        self.known = Words()
        self.projected = np.zeros((0, 6 * STATE), dtype=np.float32)

    def score(self, texts: Sequence[str | None]) -> np.ndarray:
        if len(self.known) > _REMEMBERED:
            self._forget()
        cut = [windows(ids_of(text, self.known)) for text in texts]
        if len(self.known) > len(self.projected):
            features = word_features(list(islice(self.known, len(self.projected), None)))
            more = inputs(self.params, features, evidence(self.params["odds"], features)) @ self.params["in"]
            self.projected = np.concatenate([self.projected, more + self.params["bias"]])
        sizes = np.array([len(c) for c in cut], dtype=np.int64)
        scores, some = np.zeros(len(texts)), np.flatnonzero(sizes)
        if len(some):
            found = np.split(_all_logits(self.params, self.projected, np.concatenate(cut)), np.cumsum(sizes[some])[:-1])
            x = np.stack([summary(f) for f in found])
            scores[some] = _sigmoid(x @ self.params["final"][:-1] + self.params["final"][-1])
        return scores


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, rows: int = TRAIN_ROWS) -> Params:
    """Network from at most ``rows`` labelled rows of at most ``TRAIN_CHARS`` characters each."""
    found = labelled_sample(docs, labels, "toxic", held_out, rows, TRAIN_CHARS).collect()
    return train([(r.text, r._label) for r in sorted(found, key=lambda r: (str(r._id), r.text, r._label))])


def scored(docs: DataFrame, params: Params, id_col: str = "doc_id", text_col: str = "text", batch_chars: int = 400_000) -> DataFrame:
    """``id_col`` and ``score`` of every row; texts without words score 0. A map over the rows."""
    shared = docs.sparkSession.sparkContext.broadcast(params)
    kind = docs.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            texts, parts, begin, chars = batch.column(1).to_pylist(), [np.zeros(0)], 0, 0
            for at, text in enumerate(texts):
                chars += len(text or "")
                if chars >= batch_chars or at == len(texts) - 1:
                    parts.append(scorer.score(texts[begin : at + 1]))
                    begin, chars = at + 1, 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts))], names=[id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(score, f"`{id_col}` {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 4, held_fold: int = 2, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Learns from labelled rows outside the held-out fold only, from their texts alone. Documents without
    a label are scored like others, a NULL id is never held out, NULL, empty and wordless texts score 0,
    repeated rows stay, an empty table gives no rows.
    """
    held = fold(F.col("doc_id"), folds) == held_fold
    out = scored(docs, fit(docs, labels, F.coalesce(held, F.lit(True))))
    return out.select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
