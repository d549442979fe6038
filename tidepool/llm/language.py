"""Language identification by cross-parsing entropy.

Per language a suffix automaton of labelled text is built. A document is parsed against
each automaton into longest matches; the language whose parse needs the fewest phrases,
normalised by log2 of its text length, wins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.window import Window

from tidepool.llm.common import documents, held_out, text_blocks

UNDETERMINED = "und"
BLANK = 1                       # symbol of every run of non-letters
CHARS_PER_LANGUAGE = 20_000     # labelled characters behind one automaton (fit bound)
DOCS_PER_LANGUAGE = 200         # labelled documents they are taken from (fit bound)
CHARS_IN_ALL = 4_000_000        # of all languages together, shared alike (fit bound)
MIN_CHARS = 200                 # that every language gets, however many there are
MIN_PHRASE_CHARS = 1.5
CHUNK = 2048                    # symbols parsed in lock step; phrases go on across chunks
VOID = 0                        # state before a text and after an unknown letter: no moves
_ROWS = 4096                    # chunks in one numpy block


@dataclass
class Model:
    """All automata in one sparse table. The move of ``state`` by ``symbol`` stands at slot
    ``base[state] + symbol`` if that slot's ``owner`` is the state; ``target`` is the next
    state. ``restart[language, symbol]`` is the state after a phrase's first symbol.
    ``classes`` maps a code point to its symbol; symbol 0 stands for all others."""
    languages: list[str]
    weight: np.ndarray
    base: np.ndarray
    owner: np.ndarray
    target: np.ndarray
    restart: np.ndarray
    classes: np.ndarray

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.weight, self.base, self.owner, self.target,
                                      self.restart, self.classes))


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Moves of the suffix automaton of ``symbols`` by state; state 0 is the root. There are
    fewer than two states and three moves a symbol."""
    nxt, link, length, last = [{}], [-1], [0], 0
    for c in symbols:
        cur = len(nxt)
        nxt.append({}), link.append(0), length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q])), link.append(link[q]), length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


def displace(moves: list[dict[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row displacement: every state gets a base at which its moves fall on free slots, states
    with most moves first; (base, owner, target), owner -1 where a slot is free."""
    base = np.zeros(len(moves), np.int64)
    taken, start = bytearray(1 << 12), {}
    for state in sorted(range(len(moves)), key=lambda x: (-len(moves[x]), x)):
        row = sorted(moves[state])
        if not row:
            continue
        gaps = [c - row[0] for c in row]
        at = taken.find(0, start.get(len(row), 0))
        while True:
            if at < 0 or at + gaps[-1] >= len(taken):
                taken.extend(bytes(max(len(taken), gaps[-1] + 1)))
                at = taken.find(0, start.get(len(row), 0)) if at < 0 else at
                continue
            if not any(taken[at + g] for g in gaps):
                break
            at = taken.find(0, at + 1)
        for g in gaps:
            taken[at + g] = 1
        start[len(row)] = at + 1
        base[state] = at - row[0]
    used = taken.rfind(1) + 1
    owner, target = np.full(used, -1, np.int32), np.full(used, -1, np.int32)
    for state, row in enumerate(moves):
        for c, to in row.items():
            owner[base[state] + c], target[base[state] + c] = state, to
    return base, owner, target


def letter_classes(alphabet: list[str]) -> np.ndarray:
    """Code point to symbol: blank for every non-letter, 0 for letters outside the sample."""
    classes = np.array([0 if chr(i).isalpha() else BLANK for i in range(0x110000)], np.uint32)
    for i, c in enumerate(alphabet, BLANK + 1):
        classes[ord(c)] = i
    return classes


def symbols_of(texts: list[str], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts in one array (lower case, blank runs as one) and the length of
    each text's part."""
    low = [t.lower() for t in texts]
    owner = np.repeat(np.arange(len(low)), [len(t) for t in low])
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4")
    s = classes[codes]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != BLANK) | (s[:-1] != BLANK) | (owner[1:] != owner[:-1])
    return s[keep], np.bincount(owner[keep], minlength=len(low))


def fit(samples: dict[str, str]) -> Model:
    """One automaton per language with sample text; languages in alphabetical order."""
    languages = sorted(x for x in samples if samples[x])
    alphabet = sorted({c for x in languages for c in samples[x].lower() if c.isalpha()})
    classes, width = letter_classes(alphabet), len(alphabet) + BLANK + 1
    free = np.full(width, -1, np.int32)         # bases may lie up to a width outside
    bases, owners, targets = [np.zeros(1, np.int64)], [free], [free]
    restart, weight = np.zeros((len(languages), width), np.int32), []
    states, slots = VOID + 1, width
    for k, x in enumerate(languages):
        syms, _ = symbols_of([samples[x]], classes)
        moves = suffix_automaton(syms.tolist())
        base, owner, target = displace(moves)
        for c, to in moves[0].items():
            restart[k, c] = to + states
        bases.append(base + slots)
        owners.append(np.where(owner >= 0, owner + states, -1).astype(np.int32))
        targets.append(np.where(target >= 0, target + states, -1).astype(np.int32))
        weight.append(math.log2(max(2, len(syms))))
        states, slots = states + len(moves), slots + len(owner)
    return Model(languages, np.array(weight), np.concatenate(bases),
                 np.concatenate([*owners, free]), np.concatenate([*targets, free]),
                 restart, classes)


def fit_from_labels(docs: DataFrame) -> Model:
    """Model from rows with a language that are not held out.

    The sample is bounded: of each language the ``DOCS_PER_LANGUAGE`` documents with the
    smallest id hashes, one stretch of each, at most ``CHARS_PER_LANGUAGE`` characters
    together. Every labelled language is learned; more than ``CHARS_IN_ALL /
    CHARS_PER_LANGUAGE`` of them share ``CHARS_IN_ALL`` (``MIN_CHARS`` at least). Everything
    predicted uses whole texts.
    """
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"),
                        F.col("lang").cast("string").alias("lang"))
            .where("lang IS NOT NULL").where(~held_out(F.col("doc_id"), 3, 1)))
    known = rows.agg(F.count_distinct("lang")).first()[0]
    chars = max(MIN_CHARS, min(CHARS_PER_LANGUAGE, CHARS_IN_ALL // max(known, 1)))
    piece = max(1, 2 * chars // DOCS_PER_LANGUAGE)
    key = F.xxhash64("doc_id", F.lit("language fit"))
    picked = (rows.where(F.col("text").rlike(r"\p{L}"))
              .select("lang", key.alias("key"),
                      F.expr(f"substring(text, CAST(1 + pmod(xxhash64(doc_id), greatest("
                             f"char_length(text) - {piece}, 0) + 1) AS INT), {piece})").alias("t"))
              .withColumn("n", F.row_number().over(
                  Window.partitionBy("lang").orderBy("key", "t")))
              .where(F.col("n") <= DOCS_PER_LANGUAGE))
    samples: dict[str, str] = {}
    for r in sorted(picked.collect(), key=lambda r: (r["lang"], r["n"])):
        have = samples.get(r["lang"], "")
        if len(have) < chars:
            samples[r["lang"]] = (have + " " + r["t"])[:chars]
    return fit(samples)


def count_phrases(model: Model, syms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Phrases per document (rows) and language (columns) of the greedy parse from left to
    right; a letter the language lacks is a phrase of its own.

    Chunks of ``CHUNK`` symbols are parsed side by side, at first as if a phrase began at
    each; then every chunk is parsed again whose predecessor was left in another state, until
    all agree. Parses fall into step soon, so that this mostly takes two rounds.
    """
    n_lang = len(model.languages)
    per_doc = -(-sizes // CHUNK)
    doc = np.repeat(np.arange(len(sizes)), per_doc)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    start = np.repeat(np.cumsum(sizes) - sizes, per_doc) + nth * CHUNK
    length = np.minimum(CHUNK, np.repeat(sizes, per_doc) - nth * CHUNK)
    enter = np.full((n_lang, len(doc)), VOID, np.int32)
    leave, count = enter.copy(), np.zeros((n_lang, len(doc)), np.int64)
    row = np.arange(n_lang)[:, None]
    todo = np.arange(len(doc))
    while len(todo):
        todo = todo[np.argsort(-length[todo], kind="stable")]
        for i in range(0, len(todo), _ROWS):
            block = todo[i:i + _ROWS]
            at, left = start[block], length[block]
            active = np.searchsorted(-left, -np.arange(1, CHUNK + 1), side="right")
            state, seen = enter[:, block], np.zeros((n_lang, len(block)), np.int64)
            for t in range(int(left[0])):
                k = active[t]
                s, now = syms[at[:k] + t], state[:, :k]
                slot = model.base.take(now) + s
                miss = model.owner.take(slot) != now
                seen[:, :k] += miss
                state[:, :k] = np.where(miss, model.restart[row, s], model.target.take(slot))
            leave[:, block], count[:, block] = state, seen
        after = todo[todo + 1 < len(doc)] + 1
        after = after[nth[after] > 0]
        after = after[(enter[:, after] != leave[:, after - 1]).any(axis=0)]
        enter[:, after] = leave[:, after - 1]
        todo = after
    out = np.zeros((len(sizes), n_lang), np.int64)
    np.add.at(out, doc, count.T)
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, th, lang_pred, score, phrase_chars) for every row.

    ``score`` compares the two best languages' entropies (0.5: equal, 1: no rival);
    ``phrase_chars`` is the mean phrase length under the winner. Null text, text without a
    letter, or a model without languages gives ``und``, score 0 and phrase length 0; ties
    go to the alphabetically first language; every repeated row is answered; extra columns
    are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            pred, score, chars = [], [], []
            for texts in text_blocks(b.column("text")):
                syms, sizes = symbols_of(texts, m.classes)
                owner = np.repeat(np.arange(len(texts)), sizes)
                letters = np.bincount(owner[syms != BLANK], minlength=len(texts))
                n = count_phrases(m, syms, sizes)
                for j in range(len(texts)):
                    if not letters[j] or not m.languages:
                        pred.append(UNDETERMINED), score.append(0.0), chars.append(0.0)
                        continue
                    h = n[j] * m.weight
                    best, *rest = np.argsort(h, kind="stable")
                    rival = h[rest[0]] if rest else math.inf
                    pred.append(m.languages[best])
                    score.append(1.0 if rival == math.inf else float(rival / (rival + h[best])))
                    chars.append(float(sizes[j] / n[j][best]))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(pred, pa.string()),
                 pa.array(score, pa.float64()), pa.array(chars, pa.float64())],
                ["doc_id", "th", "lang_pred", "score", "phrase_chars"])
    return documents(docs).mapInArrow(
        run, "doc_id long, th long, lang_pred string, score double, phrase_chars double")


def rejected(verdict: DataFrame) -> DataFrame:
    """Verdict rows of documents in no learned language: undetermined, or so foreign that
    even the best parse needs a phrase for fewer than ``MIN_PHRASE_CHARS`` characters."""
    return verdict.where((F.col("lang_pred") == UNDETERMINED)
                         | (F.col("phrase_chars") < MIN_PHRASE_CHARS))
