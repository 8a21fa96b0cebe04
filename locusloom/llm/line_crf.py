"""Quality classifier: a linear-chain conditional random field labels every line of a text good or bad.

Each line is described by numbers about its characters and words and by those of the lines before and
after it. A two-state chain turns them, with transitions between neighbours, into each line's probability of
being good (forward-backward marginals); their mean, weighted by line length, is the text's score.

The field is fitted on the driver to a bounded sample of labelled documents: a line's training label is its document's.
A document trains with all its lines. The sample is the documents with the smallest hash of their id, at most ``MAX_FIT`` of
them, of at most ``LONGEST_FIT`` lines each and ``MAX_FIT_LINES`` together. Fitting is deterministic. Scoring uses every line.

Defined cases: null or empty text (no line with a word) is scored from the share of good documents in the
sample, 0.5 without any labels; labels that are null or belong to no document are ignored, of several labels
of one id the smallest counts; a null ``doc_id`` is scored and counts as held out of no fold; repeated rows each get
their row; an empty table gives an empty result; columns other than ``doc_id`` and ``text`` are ignored by
``score``, and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches
from .wordhash import hash_words, slices

# The sample that the field is fitted to: documents, lines of one, lines of all.
MAX_FIT = 4_000
LONGEST_FIT = 1_000
MAX_FIT_LINES = 100_000
FOLDS = 5
THRESHOLD = 0.3
EPOCHS, RATE, RIDGE = 150, 0.1, 1e-3
LINE_CLASSES = "upper lower digit symbol mark pipe".split()
N_OWN = 12

_CLASS = np.zeros((256, len(LINE_CLASSES)), np.float32)
_CLASS[65:91, 0] = 1
_CLASS[97:123, 1] = 1
_CLASS[48:58, 2] = 1
_CLASS[[ord(c) for c in "#*$%&<>{}[]\\^~`_=@"], 3] = 1
_CLASS[[ord(c) for c in "!?"], 4] = 1
_CLASS[ord("|"), 5] = 1
_NEWLINE = 10


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every line with a word, text by text: features, length in bytes; and the number of such lines per text."""
    features, lengths, counts = [], [], []
    for _, raw in slices(texts):
        f, n, c = _slice_features(raw)
        features.append(f)
        lengths.append(n)
        counts.append(c)
    if not counts:
        return np.zeros((0, N_OWN * 3 + 1), np.float32), np.zeros(0), np.zeros(0, np.int64)
    return np.concatenate(features), np.concatenate(lengths), np.concatenate(counts)


def _slice_features(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words, starts, ends, data, words_per_text = hash_words(raw)
    if len(words) == 0:
        return np.zeros((0, N_OWN * 3 + 1), np.float32), np.zeros(0), np.zeros(len(raw), np.int64)
    breaks = np.flatnonzero(data == _NEWLINE)
    line_of_word = np.searchsorted(breaks, starts)
    first = np.flatnonzero(np.diff(line_of_word, prepend=-1))  # the first word of each line that has one
    n_words = np.diff(first, append=len(words)).astype(np.float64)
    line = np.repeat(np.arange(len(first)), n_words.astype(np.int64))
    begin, end = starts[first], ends[np.append(first[1:], len(words)) - 1]
    length = (end - begin).astype(np.float64)

    codes = np.zeros((len(first), len(LINE_CLASSES)))
    for k in range(len(LINE_CLASSES)):
        hits = np.concatenate(([0], np.cumsum(_CLASS[data, k], dtype=np.int64)))
        codes[:, k] = hits[end] - hits[begin]
    word_bytes = np.add.reduceat((ends - starts).astype(np.float64), first)

    # Different words of a line, and words equal to the one before or two before.
    order = np.lexsort((words, line))
    new = np.ones(len(words), bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (line[order][1:] != line[order][:-1])
    distinct = np.add.reduceat(new.astype(np.float64), first)
    again = np.zeros(len(words))
    again[1:] = (words[1:] == words[:-1]) & (line[1:] == line[:-1])
    again = np.add.reduceat(again, first)

    # Lines that stood in the same text before (by the sum of their words' hashes).
    text_of_line = np.searchsorted(np.cumsum(words_per_text), first, side="right")
    total = np.add.reduceat(words, first)
    order = np.lexsort((np.arange(len(first)), total, text_of_line))
    seen = np.zeros(len(first))
    seen[order[1:]] = (total[order][1:] == total[order][:-1]) & (text_of_line[order][1:] == text_of_line[order][:-1])

    size = np.maximum(length, 1)
    own = np.column_stack([
        codes[:, 0] / size, codes[:, 1] / size, codes[:, 2] / size,
        np.sqrt(codes[:, 3] / size), np.sqrt(codes[:, 4] / size), np.sqrt(codes[:, 5] / size),
        np.log1p(length) / 8, np.minimum(word_bytes / n_words, 20) / 10,
        (distinct / n_words) * np.minimum(1, n_words / 8), again / n_words, seen,
        # Variety against what a text of that many words would have.
        np.log(np.maximum(distinct, 1)) / np.log(np.maximum(n_words, 2)),
    ])
    counts = np.bincount(text_of_line, minlength=len(raw))
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = text_of_line[1:] == text_of_line[:-1]
    before[1:][same] = own[:-1][same]
    after[:-1][same] = own[1:][same]
    return np.column_stack([own, before, after, np.ones(len(own))]).astype(np.float32), length, counts


@dataclass
class Field:
    """Weights of the state "good" against "bad" per feature, and log weights of transitions [from, to]."""

    weights: np.ndarray
    moves: np.ndarray
    prior: float


def _by_step(counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Step t with the places of all texts' t-th lines, longest texts first, and the texts themselves."""
    order = np.argsort(-counts, kind="stable")
    offsets = np.concatenate(([0], np.cumsum(counts)[:-1]))[order]
    sizes = counts[order]
    for t in range(int(sizes[0]) if len(sizes) else 0):
        alive = int(np.searchsorted(-sizes, -t, side="left"))
        yield t, offsets[:alive] + t, order[:alive]


def marginals(field: Field, features: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of good per line, and the summed probabilities of transitions (2 x 2)."""
    score = np.zeros((len(features), 2))
    score[:, 1] = features @ field.weights
    moves = np.exp(field.moves)
    steps = list(_by_step(counts))
    local = np.exp(score - score.max(axis=1, keepdims=True))
    forward, scaled = np.zeros_like(local), np.ones_like(local)
    for t, at, _ in steps:
        forward[at] = local[at] if t == 0 else (forward[at - 1] @ moves) * local[at]
        forward[at] /= forward[at].sum(axis=1, keepdims=True)
    pairs = np.zeros((2, 2))
    for t, at, _ in reversed(steps):
        if t == 0:
            break
        out = local[at] * scaled[at]
        pair = forward[at - 1][:, :, None] * moves[None] * out[:, None, :]
        pairs += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        back = out @ moves.T
        scaled[at - 1] = back / back.sum(axis=1, keepdims=True)
    both = forward * scaled
    return both[:, 1] / np.maximum(both.sum(axis=1), 1e-300), pairs


def fit(x: np.ndarray, counts: np.ndarray, labels: np.ndarray, prior: float) -> Field:
    """Gradient ascent (Adam) on the conditional likelihood of chains of lines, every chain weighing alike."""
    weights = np.zeros(N_OWN * 3 + 1)
    if len(x) == 0 or prior in (0.0, 1.0):
        weights[-1] = np.log((prior + 1e-3) / (1 - prior + 1e-3))
        return Field(weights, np.zeros((2, 2)), prior)
    x = x.astype(np.float64)
    y = np.repeat(labels.astype(float), counts)
    weight = np.repeat(1 / counts, counts)
    scale = weight.sum()
    truth = np.zeros((2, 2))
    for label, n in zip(labels, counts, strict=True):
        truth[label, label] += (n - 1) / n
    field = Field(weights, np.zeros((2, 2)), prior)
    state = [np.zeros(len(weights)), np.zeros(len(weights)), np.zeros((2, 2)), np.zeros((2, 2))]
    for epoch in range(1, EPOCHS + 1):
        p, pairs = marginals(field, x, counts)
        grad_w = (x * ((y - p) * weight)[:, None]).sum(axis=0) / scale - RIDGE * field.weights
        # Transition counts weigh as the mean chain does.
        grad_m = (truth - pairs * truth.sum() / max(pairs.sum(), 1e-9)) / scale - RIDGE * field.moves
        for value, grad, m, v in ((field.weights, grad_w, state[0], state[1]), (field.moves, grad_m, state[2], state[3])):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value += RATE * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-8)
        np.clip(field.moves, -3, 3, out=field.moves)
    return field


def score_texts(field: Field, texts: list[str | None]) -> np.ndarray:
    features, lengths, counts = line_features(texts)
    p, _ = marginals(field, features, counts)
    text_of_line = np.repeat(np.arange(len(counts)), counts)
    weight = np.bincount(text_of_line, weights=lengths, minlength=len(counts))
    total = np.bincount(text_of_line, weights=lengths * p, minlength=len(counts))
    return np.where(weight > 0, total / np.maximum(weight, 1e-9), field.prior)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Field:
    """A field from at most ``MAX_FIT`` labelled documents outside the held-out fold.

    The driver gets at most ``MAX_FIT_LINES`` rows of features, 15 MB.
    """
    small_batches(docs.sparkSession)
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_FIT)
    # Bounded by MAX_FIT rows of two numbers.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality"))

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            features, _, counts = line_features(batch["text"].tolist())
            ends = np.cumsum(counts)
            fits = counts <= LONGEST_FIT
            yield pd.DataFrame({
                "doc_id": batch["doc_id"],
                "quality": batch["quality"],
                "n_lines": counts,
                "features": [features[e - n : e].tobytes() for e, n in zip(ends, counts, strict=True)],
            })[fits]

    kind = docs.schema["doc_id"].dataType.simpleString()
    described = sample.mapInPandas(describe, f"doc_id {kind}, quality int, n_lines bigint, features binary")
    upto = F.sum("n_lines").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))  # over the sample's rows
    rows = described.withColumn("_upto", upto).where(F.col("_upto") <= MAX_FIT_LINES).collect()
    rows.sort(key=lambda r: r.doc_id)
    x = np.frombuffer(b"".join(r.features for r in rows), np.float32).reshape(-1, N_OWN * 3 + 1)
    counts = np.array([r.n_lines for r in rows], np.int64)
    y = np.array([r.quality for r in rows], np.int64)
    lines = counts > 0
    return fit(x, counts[lines], y[lines], sum(r.quality for r in rows) / len(rows) if rows else 0.5)


def score(docs: DataFrame, labels: DataFrame, field: Field | None = None) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` per document."""
    field = train(docs, labels) if field is None else field
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = score_texts(field, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those whose predicted label is bad; all columns stay."""
    field = train(docs, labels)

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series(score_texts(field, texts.tolist()))

    return docs.where(scores("text") >= THRESHOLD)
