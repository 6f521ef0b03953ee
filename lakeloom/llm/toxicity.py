"""Toxicity by multiple-instance learning: a document is a bag of sentences, its probability a noisy-or of theirs.

A sentence's score is a logistic model of its hashed words and their beginnings (stems that take many endings); the document's is ``1 - prod(1 - p_sentence)``. Training
sees document labels only: the noisy-or passes its gradient to the sentences that explain a toxic label and pushes down
every sentence of a clean document. Sentence scores then locate the offending passages.

Edge cases: null and empty texts have no sentence and score 0; repeated rows score alike; with no labelled row of one
class every score is the other class's; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import bound_batches, labelled_sample, text_groups, words_of

BITS = 18
#: Bounds of the training sample: rows of each class, and bytes of all of them (whole texts).
PER_CLASS, MAX_BYTES = 4000, 32 << 20
#: Lengths in bytes of the beginnings of words that are features of their own.
PREFIXES = (4, 5, 6, 7, 8)
#: A word's least number of toxic documents, and how many times its share of them must exceed its share of clean ones.
MIN_TOXIC, LIFT = 3, 6.0
#: Log-odds of a sentence without evidence: so low that thousands of them leave a long document clean.
BIAS = -12.0
#: ``.``, ``!``, ``?`` and line ends close a sentence.
_CLOSES = np.zeros(256, bool)
_CLOSES[[10, 13, 33, 46, 63]] = True


def sentences(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features of flat text with their sentences: feature, sentence of each feature, row of each sentence, and the
    sentence's first and end byte. A sentence is a run of words of a row between closing marks."""
    value, row, start, end, more = words_of(raw, offsets, PREFIXES)
    if not len(value):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty
    marks = np.cumsum(_CLOSES[raw])
    before = marks[start]
    new = np.ones(len(value), bool)
    new[1:] = (row[1:] != row[:-1]) | (before[1:] != before[:-1])
    sentence = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(value)) - 1
    feature = (np.concatenate([value, *(h for _, h in more)]) >> np.uint64(64 - BITS)).astype(np.int64)
    sentence = np.concatenate([sentence, *(sentence[at] for at, _ in more)])
    return feature, sentence, row[first], start[first], end[last]


def sentence_logits(weights: np.ndarray, bias: float, feature: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
    """Bias plus the weights of a sentence's different features: a repeated word counts once."""
    live = np.flatnonzero(weights[feature])
    pair = np.unique((sentence[live] << BITS) + feature[live])
    return bias + np.bincount(pair >> BITS, weights[pair & ((1 << BITS) - 1)], n)


def noisy_or(logits: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """1 - prod(1 - sigmoid(logit)) of each row, in logarithms."""
    return 0.0 - np.expm1(-np.bincount(row, np.logaddexp(0, logits), n))


class ToxicityModel:
    """Word weights and a bias of the sentence model."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Score of each row, and of each sentence: logit, row, first and end byte."""
        feature, sentence, row, start, end = sentences(raw, offsets)
        logits = sentence_logits(self.weights, self.bias, feature, sentence, len(row))
        return np.clip(noisy_or(logits, row, len(offsets) - 1), 0, 1), logits, row, start, end


def train(rows: list[tuple[str, int]], epochs: int = 400, rate: float = 0.3, decay: float = 1e-4) -> ToxicityModel:
    """Full-batch Adagrad on the noisy-or likelihood, classes weighted alike, over words seen in several rows."""
    y = np.array([label for _, label in rows], float)
    if not len(y) or y.min() == y.max():
        return ToxicityModel(np.zeros(1 << BITS), 30.0 if len(y) and y[0] else -30.0)
    column = pa.array([t for t, _ in rows], pa.string())
    # Words that toxic documents have clearly more often than clean ones; a word of few documents says nothing.
    n1, n0 = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for first, _, raw, offsets in text_groups(column):
        feature, sentence, row, _, _ = sentences(raw, offsets)
        pair = np.unique((row[sentence] << BITS) + feature)
        toxic = y[first + (pair >> BITS)] == 1
        n1 += np.bincount(pair[toxic] & ((1 << BITS) - 1), minlength=1 << BITS)
        n0 += np.bincount(pair[~toxic] & ((1 << BITS) - 1), minlength=1 << BITS)
    chosen = (n1 >= MIN_TOXIC) & ((n1 - np.sqrt(n1)) / y.sum() > LIFT * (n0 + 0.5) / (len(y) - y.sum()))
    features, owners, bags, made = [], [], [], 0
    for first, _, raw, offsets in text_groups(column):
        feature, sentence, row, _, _ = sentences(raw, offsets)
        keep = chosen[feature]
        pair = np.unique((sentence[keep] << BITS) + feature[keep])
        features.append(pair & ((1 << BITS) - 1))
        owners.append((pair >> BITS) + made)
        bags.append(row + first)
        made += len(row)
    feature, sentence, row = np.concatenate(features), np.concatenate(owners), np.concatenate(bags)
    lift = np.log((n1 + 1e-9) / y.sum() * (len(y) - y.sum()) / (n0 + 0.5))
    used, feature = np.unique(feature, return_inverse=True)
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum())) * len(y)
    w, gw, n = lift[used], np.full(len(used), 1e-3), len(row)
    for _ in range(epochs):
        logits = BIAS + np.bincount(sentence, w[feature], n)
        q = np.logaddexp(0, logits)
        total = np.bincount(row, q, len(y))
        # d/dz of the log-likelihood: p_s for clean documents, -p_s (1 - P) / P for toxic ones.
        p = 1 / (1 + np.exp(-logits))
        slope = np.where(y == 1, -np.exp(-total) / np.maximum(-np.expm1(-total), 1e-9), 1.0) * share / len(y)
        g = np.clip(p * slope[row], -1, 1)
        grad = np.bincount(feature, g[sentence], len(used)) + decay * w / len(y)
        gw += grad * grad
        w -= rate * grad / np.sqrt(gw)
        w *= np.maximum(0, 1 - 4e-3 / np.maximum(np.abs(w), 1e-9))
    full = np.zeros(1 << BITS)
    full[used] = w
    return ToxicityModel(full, BIAS)


def fit(spark: SparkSession, sf_dir: str) -> ToxicityModel:
    """Trains on a bounded sample of the labelled rows outside the held-out fold."""
    return train(labelled_sample(spark, sf_dir, "toxic", PER_CLASS, MAX_BYTES))


SCHEMA = "doc_id long, score double, n_sentences long, offending array<struct<start:long,end:long,score:double>>"
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("score", pa.float64()),
        ("n_sentences", pa.int64()),
        ("offending", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))),
    ]
)


def score(docs: DataFrame, model: ToxicityModel, locate_from: float = 0.5) -> DataFrame:
    """Score of every whole text, with the sentences (code points) whose own score is at least ``locate_from``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, raw, offsets in text_groups(batch.column(1)):
                result, logits, row, start, stop = shared.value.score(raw, offsets)
                found: list[list] = [[] for _ in range(end - first)]
                p = 1 / (1 + np.exp(-logits))
                for s in np.flatnonzero(p >= locate_from):
                    base = offsets[row[s]]
                    at = len(raw[base : start[s]].tobytes().decode("utf-8", "replace"))
                    n = len(raw[start[s] : stop[s]].tobytes().decode("utf-8", "replace"))
                    found[row[s]].append({"start": at, "end": at + n, "score": float(p[s])})
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        pa.array(result),
                        pa.array(np.bincount(row, minlength=end - first)),
                        pa.array(found, _ARROW.field("offending").type),
                    ],
                    schema=_ARROW,
                )

    return bound_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)
