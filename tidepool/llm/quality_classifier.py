"""Quality classifier with supervised subword embeddings.

A word's vector is the mean of the learned vectors of its hashed features (the word itself
and its character n-grams); a document's vector is the mean over its words and over hashed
marks for words that repeat a recent one; a softmax layer scores it. Everything is trained
by stochastic gradient descent in numpy on a bounded sample of labelled documents.
"""

from __future__ import annotations

import math
import operator
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import documents, held_out, text_blocks

BUCKETS = 1 << 17
DIMENSION = 16
NGRAMS = (3, 4)
EPOCHS = 6
RATE = 0.5
TRAIN_DOCS = 5000       # labelled documents the fit uses (bound)
TRAIN_CHARS = 10_000    # of each, one stretch of at most so many characters (bound)
CACHE_WORDS = 300_000   # words a task keeps scores of; the cache starts anew beyond that
SEED = 7
_LAGS = (1, 2, 3)


def word_features(word: str) -> np.ndarray:
    """Bucket numbers of a word: itself and the character n-grams of ``<word>``."""
    w = f"<{word}>"
    grams = [w] + [w[i:i + n] for n in NGRAMS for i in range(len(w) - n + 1)]
    return np.array([zlib.crc32(g.encode()) % BUCKETS for g in grams], np.int64)


def repeats(words: list[str]) -> list[tuple[int, int]]:
    """(bucket, count) of the marks: a word equals the one 1, 2 or 3 places before."""
    return [(zlib.crc32(b"=%d" % lag) % BUCKETS, sum(map(operator.eq, words, words[lag:])))
            for lag in _LAGS]


def _sparse(text: str, cache: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    words = text.split()
    weight: dict[int, float] = {}
    total = len(words)
    for w in words:
        f = cache.get(w)
        if f is None:
            f = cache[w] = word_features(w)
        share = 1.0 / len(f)
        for b in f.tolist():
            weight[b] = weight.get(b, 0.0) + share
    for b, n in repeats(words):
        weight[b] = weight.get(b, 0.0) + n
        total += n
    ids = np.fromiter(weight, np.int64, len(weight))
    return ids, np.fromiter(weight.values(), np.float64, len(weight)) / max(1, total)


class Model:
    """Per-bucket share of the logit (label 1 against 0) and the bias."""

    def __init__(self, logit: np.ndarray, bias: float):
        self.logit, self.bias = logit, bias

    def scorer(self):
        """A function of a text; word and n-gram scores are remembered between texts."""
        grams = _Memory(lambda g: float(self.logit[zlib.crc32(g.encode()) % BUCKETS]))

        def word_score(word: str) -> float:
            w = f"<{word}>"
            parts = [w] + [w[i:i + n] for n in NGRAMS for i in range(len(w) - n + 1)]
            return sum(map(grams.__getitem__, parts)) / len(parts)
        words = _Memory(word_score)

        def score(text: str) -> float:
            ws = text.split()
            marks = repeats(ws)
            total = len(ws) + sum(n for _, n in marks)
            z = sum(map(words.__getitem__, ws)) + sum(float(self.logit[b]) * n for b, n in marks)
            z = z / max(1, total) + self.bias
            return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, z))))
        return score


class _Memory(dict):
    """Values of a function, forgotten all at once beyond ``CACHE_WORDS``."""

    def __init__(self, function):
        super().__init__()
        self.function = function

    def __missing__(self, key):
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[key] = self.function(key)
        return value


def fit(texts: list[str], labels: list[int]) -> Model:
    """Adaptive-rate SGD, one document a step; without documents of both labels the score
    is the share of label 1 (one half without any)."""
    rng = np.random.default_rng(SEED)
    if len(set(labels)) < 2:
        p = 0.5 if not labels else min(0.99, max(0.01, float(labels[0])))
        return Model(np.zeros(BUCKETS), math.log(p / (1 - p)))
    cache: dict[str, np.ndarray] = {}
    docs = [_sparse(t, cache) for t in texts]
    e = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (BUCKETS, DIMENSION))
    out, bias = rng.normal(0, 0.1, (DIMENSION, 2)), np.zeros(2)
    seen_e, seen_o, seen_b = np.full(BUCKETS, 1e-6), np.full(out.shape, 1e-6), np.full(2, 1e-6)
    for epoch in range(EPOCHS):
        for i in rng.permutation(len(docs)):
            ids, weight = docs[i]
            hidden = weight @ e[ids]
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1.0
            back = out @ p
            grad = np.outer(hidden, p)
            seen_o += grad * grad
            seen_b += p * p
            out -= 0.1 * grad / np.sqrt(seen_o)
            bias -= 0.1 * p / np.sqrt(seen_b)
            if len(ids):
                seen_e[ids] += weight * weight * float(back @ back) / DIMENSION
                e[ids] -= np.outer(RATE * weight / np.sqrt(seen_e[ids]) * 0.1, back)
    return Model(e @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]))


def labelled(docs: DataFrame, labels: DataFrame, label: str, most: int, chars: int) -> DataFrame:
    """(text, label) of at most ``most`` labelled documents that are not held out, those
    with the smallest id hashes, a stretch of at most ``chars`` characters of each. An id
    with contradicting labels counts as 1, one with several texts by the smallest."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    marks = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("label"))
    marks = marks.where("label IN (0, 1)").where(~held_out(F.col("id"), 5, 0))
    marks = marks.groupBy("id").agg(F.max("label").alias("label"))
    picked = marks.join(ids, F.col("id") == F.col("doc_id"), "left_semi").orderBy(
        F.xxhash64("id", F.lit("label fit")), "id").limit(most)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    stretch = F.expr(f"substring(coalesce(text, ''), CAST(1 + pmod(xxhash64(doc_id), greatest("
                     f"coalesce(char_length(text), 0) - {chars}, 0) + 1) AS INT), {chars})")
    # at most ``most`` ids are broadcast, so only the sample's texts move
    found = rows.join(F.broadcast(picked), F.col("doc_id") == F.col("id")).select(
        "id", "label", stretch.alias("text"))
    return found.groupBy("id", "label").agg(F.min("text").alias("text")).select("text", "label")


def fit_from_labels(docs: DataFrame, labels: DataFrame) -> Model:
    rows = labelled(docs, labels, "quality", TRAIN_DOCS, TRAIN_CHARS).collect()
    rows.sort(key=lambda r: (zlib.crc32(r["text"].encode()), r["text"]))
    return fit([r["text"] for r in rows], [r["label"] for r in rows])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, th, score) per row: probability of label 1 from the whole text.

    Null text counts as empty and scores by the bias alone; repeated rows and null ids are
    answered like others; extra columns are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for b in batches:
            out = [score(t) for texts in text_blocks(b.column("text")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(out, pa.float64())],
                ["doc_id", "th", "score"])
    return documents(docs).mapInArrow(run, "doc_id long, th long, score double")
