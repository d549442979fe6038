"""Toxic passages by maximum-scoring segments.

Tokens are scored by the log-odds of toxic against clean labelled text under a Dirichlet
prior; tokens without significant odds pull the score down a little. A linear scan finds
all maximal-scoring segments of a document, and the extreme-value statistics of such
segments in clean text turn the best of them, alone or together, into a probability.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import documents, durable, text_blocks
from tidepool.llm.quality_classifier import labelled
from tidepool.llm.quality_rules import let

TRAIN_DOCS = 10_000     # labelled documents the fit uses (bound)
TRAIN_CHARS = 20_000    # of each, one stretch of at most so many characters (bound)
LEXICON = 20_000        # tokens with the highest odds that are kept (fit bound)
PRIOR_SHARE = 0.05      # weight of the Dirichlet prior, as a share of all labelled tokens
SIGNIFICANT = 4.0       # standard deviations of the log-odds a scored token needs
CACHE_WORDS = 300_000   # words a task remembers the score of; it starts anew beyond that
DRIFT = 0.5             # what every other token takes off a segment
K = 1.0                 # bound of the extreme-value constant
STEMS = (5, 7)          # words are also counted, and scored, by their first letters
TOKEN = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    scores: dict[str, float]    # token -> score of the tokens that raise a segment
    rate: float                 # lambda of the extreme-value distribution
    prior: float                # share of toxic documents

    def hits(self, tokens: list[str]) -> list[tuple[int, float]]:
        """(position, score) of the scored tokens: a word's own score, else that of its
        longest scored stem."""
        out, seen = [], self.__dict__.setdefault("_seen", {})
        if len(seen) > CACHE_WORDS:
            seen.clear()
        for i, w in enumerate(tokens):
            if w not in seen:
                seen[w] = self.scores.get(w) or next(
                    (self.scores[x] for n in reversed(STEMS) if len(w) > n
                     and (x := w[:n] + "-") in self.scores), None)
            s = seen[w]
            if s is not None:
                out.append((i, s))
        return out


def decay(clean: dict[float, float], drift: float) -> float:
    """The positive root of sum p(s) exp(x s) = 1 over clean tokens: ``clean`` maps a
    positive score to its frequency, all others score ``-drift``."""
    rest = 1.0 - sum(clean.values())
    low, high = 0.0, 50.0

    def excess(x: float) -> float:
        return sum(p * math.exp(min(700.0, x * s)) for s, p in clean.items()) \
            + rest * math.exp(-x * drift) - 1.0
    if not clean:
        return high
    if sum(p * s for s, p in clean.items()) - rest * drift >= 0:
        return 1e-3
    for _ in range(100):
        x = (low + high) / 2
        low, high = (x, high) if excess(x) < 0 else (low, x)
    return max(low, 1e-3)


def fit_from_labels(docs: DataFrame, labels: DataFrame) -> Model:
    """Counts are taken by Spark over the bounded sample; at most ``LEXICON`` rows come to
    the driver. A token counts once per label for each pair of neighbours it stands
    between, so copies of a text add nothing. Without documents of both labels no token is
    scored."""
    sample = durable(labelled(docs, labels, "toxic", TRAIN_DOCS, TRAIN_CHARS), "toxic-sample")
    tokens = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{M}]+"), F.lit(0))
    uses = let(tokens, lambda w: F.transform(w, lambda x, i: F.struct(
        x.alias("word"), F.xxhash64(F.get(w, i - 1), F.get(w, i + 1)).alias("around"))))
    stems = [F.when(F.char_length("word") > n, F.concat(F.substring("word", 1, n), F.lit("-")))
             for n in STEMS]
    uses = sample.select("label", F.inline(uses)).distinct().select(
        "label", F.explode(F.array_compact(F.array("word", *stems))).alias("token"))
    counts = uses.groupBy("token").agg(F.sum("label").alias("t"),
                                       F.sum(1 - F.col("label")).alias("c"))
    counts = durable(counts, "toxic-counts")
    total = counts.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).first()
    n_docs = sample.agg(F.count("*").alias("n"), F.sum("label").alias("t")).first()
    nt, nc = total["t"] or 0, total["c"] or 0
    prior = (n_docs["t"] or 0) / max(1, n_docs["n"])
    if not nt or not nc:
        return Model({}, 1.0, prior)
    weight = PRIOR_SHARE * (nt + nc)
    a = (F.col("t") + F.col("c")) * PRIOR_SHARE
    t, c = F.col("t") + a, F.col("c") + a
    odds = F.log(t / (nt + weight - t)) - F.log(c / (nc + weight - c))
    z = odds / F.sqrt(1 / t + 1 / c)
    top = (counts.select("token", "c", odds.alias("odds"), z.alias("z"))
           .where(F.col("z") >= SIGNIFICANT).where(F.col("odds") > 2 * DRIFT)
           .orderBy(F.desc("z"), "token").limit(LEXICON).collect())
    scores = {r["token"]: r["odds"] - DRIFT for r in top}
    clean: dict[float, float] = {}
    for r in top:
        s = r["odds"] - DRIFT
        clean[s] = clean.get(s, 0.0) + (r["c"] + 0.5) / (nc + 1.0)
    return Model(scores, decay(clean, DRIFT), prior)


def maximal_segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, score) of a token sequence whose scored
    tokens are ``hits`` (position, score) and whose other tokens score ``-drift``.

    The linear scan keeps a list of candidate segments with the cumulative score before and
    after each; a new one either stands alone or absorbs those it improves on.
    """
    kept: list[tuple[int, int, float, float]] = []      # first, last, before, after
    total, last = 0.0, -1
    for pos, s in hits:
        total -= drift * (pos - last - 1)
        first, before = pos, total
        total += s
        after, last = total, pos
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= before:
                j -= 1
            if j < 0 or kept[j][3] >= after:
                break
            first, before = kept[j][0], kept[j][2]
            del kept[j:]
        kept.append((first, pos, before, after))
    return [(f, t, b - a) for f, t, a, b in kept]


def p_value(segments: list[tuple[int, int, float]], n: int, rate: float) -> float:
    """Chance that clean text of ``n`` tokens has segments like these: of the best r
    segments together for the r that is least likely, by the sum statistic."""
    best, total = 0.0, 0.0
    for r, s in enumerate(sorted((x[2] for x in segments), reverse=True), 1):
        total += rate * s - math.log(K * max(1, n))
        best = max(best, total + math.lgamma(r + 1) - (r - 1) * math.log(2))
        if rate * s <= math.log(K * max(1, n)):
            break
    return -math.expm1(-math.exp(-best))


def judge(text: str, m: Model) -> tuple[float, list[tuple[int, int, float]]]:
    """Score and significant passages (first token, last token, score) of a whole text."""
    tokens = TOKEN.findall(text.lower())
    hits = m.hits(tokens)
    if not hits:
        return 0.0, []
    segments = maximal_segments(hits, DRIFT)
    p = p_value(segments, len(tokens), m.rate)
    prior = min(0.99, max(0.01, m.prior))
    floor = math.exp(-1.0)
    score = prior / (prior + (1 - prior) * p)
    loud = [x for x in segments
            if K * len(tokens) * math.exp(-m.rate * x[2]) < floor]
    return score, loud


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, th, score, passages) per row; ``passages`` lists (first, last, score) of the
    significant toxic passages, in tokens from 0.

    Null text counts as empty; a text without a scored token scores 0; ties between
    segments keep the earlier one; repeated rows and null ids are answered like others;
    extra columns are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    part = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            scores, found = [], []
            for texts in text_blocks(b.column("text")):
                for t in texts:
                    s, loud = judge(t, m)
                    scores.append(s)
                    found.append([{"first": x, "last": y, "score": z} for x, y, z in loud])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(scores, pa.float64()),
                 pa.array(found, pa.list_(part))], ["doc_id", "th", "score", "passages"])
    return documents(docs).mapInArrow(
        run, "doc_id long, th long, score double, "
             "passages array<struct<first: long, last: long, score: double>>")
