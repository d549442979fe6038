"""Phrase collocations from an FM-index per shard of words.

A shard is a few megabytes of text of one language. Its words that are frequent in the whole
language become symbols; everything else, and each piece border, is the separator 0. The
shard gets a bidirectional index: the Burrows-Wheeler transform of its word sequence and of
the reversed sequence, with suffixes sorted to ``LONGEST`` words, which is all that phrases
of that length need. A phrase is a pair of intervals, one in each transform. Extending it
by a word to the right is a backward step in the reversed transform, and the other interval
follows; the words before it stand in its forward interval.

Levels go over all shards together: each shard enumerates the extensions of the phrases
known to be frequent, Spark sums their counts over shards, and the frequent ones return to
the shards that hold them. So shards exchange counts, never texts, and what one shard emits
is bounded by its own words. From three words on a shard keeps its candidates with their
intervals in its own row, and the counts of a group of shards of one language are summed in
one task before they leave it: rows follow the groups, about as many as Spark has cores,
not the shards.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import discard, durable

LONGEST = 5
SHARD_BYTES = 8 << 20
BROADCAST_BYTES = 64 << 20      # measured size up to which keys of frequent phrases are broadcast

_BORDER = re.compile(rb"[.,;:!?\x0A-\x0D]")
_KIND = np.zeros(256, dtype=np.uint8)       # 0 word, 1 blank, 2 piece border
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


# -- words --------------------------------------------------------------------------------

def words_of(data: bytes) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of ``data`` in order, and for each whether a new piece starts there."""
    raw = _LOWER[np.frombuffer(data, dtype=np.uint8)]
    kind = _KIND[raw]
    word = kind == 0
    edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_string(), len(start), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw[word]))])
    piece = np.cumsum(kind == 2)[start]
    return words.dictionary_encode(), np.diff(piece, prepend=-1) != 0


def _parts(text: bytes, limit: int):
    """``text``, cut at piece borders into parts of about ``limit`` bytes."""
    at = 0
    while len(text) - at > limit and (m := _BORDER.search(text, at + limit)):
        yield text[at:m.start()]
        at = m.end()
    yield text[at:]


SHARDS = "shard long, lang string, word string, local int, n long, words binary"


def _shard_batches(limit: int):
    names = [c.split()[0] for c in SHARDS.split(", ")]

    def run(batches):
        number, held, size = TaskContext.get().partitionId() << 32, {}, {}

        def rows(lang):
            nonlocal number
            coded, new = words_of(b"\n".join(held.pop(lang)))
            size.pop(lang)
            if not len(coded):
                return
            local = coded.indices.to_numpy().astype(np.int32) + 1
            seq = np.zeros(len(local) + int(new.sum()) + 1, dtype=np.int32)
            seq[np.arange(len(local)) + np.cumsum(new)] = local
            count = np.bincount(local)[1:]
            number += 1
            for i in range(0, len(count), 100_000):
                k = len(count[i:i + 100_000])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(k, number)), pa.array([lang] * k),
                    coded.dictionary.slice(i, k).cast(pa.string()),
                    pa.array(np.arange(i + 1, i + k + 1, dtype=np.int32)),
                    pa.array(count[i:i + k].astype(np.int64)), pa.nulls(k, pa.binary())],
                    names=names)
            yield pa.RecordBatch.from_arrays([
                pa.array([number]), pa.array([lang]), pa.nulls(1, pa.string()),
                pa.nulls(1, pa.int32()), pa.array([len(local)], pa.int64()),
                pa.array([seq.tobytes()], pa.binary())], names=names)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in _parts(text.as_buffer().to_pybytes(), limit):
                    if size.get(lang, 0) and size[lang] + len(part) > limit:
                        yield from rows(lang)
                    held.setdefault(lang, []).append(part)
                    size[lang] = size.get(lang, 0) + len(part)
                    if sum(size.values()) > 4 * limit:
                        yield from rows(max(size, key=size.get))
        for lang in list(held):
            yield from rows(lang)
    return run


# -- the index of a shard -----------------------------------------------------------------

def _order(t: np.ndarray) -> np.ndarray:
    """Suffixes of ``t`` sorted by their first ``LONGEST`` symbols (0 beyond the end)."""
    rank = t.astype(np.int64)
    deep = 1
    while deep < LONGEST:
        after = np.zeros(len(t), dtype=np.int64)
        step = min(deep, LONGEST - deep)
        after[:len(t) - step] = rank[step:]
        key = rank * (int(rank.max()) + 1) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.zeros(len(t), dtype=np.int64)
        new[order] = np.cumsum(np.diff(key, prepend=key[:1]) != 0)
        rank, deep = new, deep + step
    return np.argsort(rank, kind="stable")


def transform(t: np.ndarray) -> np.ndarray:
    """Burrows-Wheeler transform of ``t`` with suffixes sorted to ``LONGEST`` symbols."""
    return t[_order(t) - 1]


def last_to_first(bwt: np.ndarray) -> np.ndarray:
    out = np.empty(len(bwt), dtype=np.int64)
    out[np.argsort(bwt, kind="stable")] = np.arange(len(bwt))
    return out


def _positions(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    begin = np.cumsum(n) - n
    return np.arange(int(n.sum())) + np.repeat(lo - begin, n)


def extend_right(rev: np.ndarray, first: np.ndarray, lo_f, lo_r, n):
    """All one-word extensions of the phrases with intervals ``lo_f``, ``lo_r`` and count
    ``n``: (phrase number, word, lo_f, lo_r, n) arrays; ``first`` maps last to first."""
    at = _positions(lo_r, n)
    phrase = np.repeat(np.arange(len(n)), n)
    word = rev[at].astype(np.int64)
    key = phrase * (int(word.max(initial=0)) + 1) + word
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.flatnonzero(np.diff(key, prepend=-1) != 0)
    count = np.diff(np.append(head, len(key)))
    phrase, word = phrase[order][head], word[order][head]
    forward = lo_f[phrase] + head - (np.cumsum(n) - n)[phrase]
    backward = first[at[order][head]]
    real = word > 0
    return tuple(x[real] for x in (phrase, word, forward, backward, count))


def neighbours(bwt: np.ndarray, lo: np.ndarray, n: np.ndarray):
    """Smallest and largest symbol beside each phrase (0: a border)."""
    beside, begin = bwt[_positions(lo, n)], np.cumsum(n) - n
    return np.minimum.reduceat(beside, begin), np.maximum.reduceat(beside, begin)


PAIRS = "shard long, parent long, word long, n long"
STATE = ["parent", "word", "tail", "n", "lo_f", "lo_r",         # candidates of a shard
         "own", "left_min", "left_max", "right_min", "right_max"]   # its phrases, neighbours
_SMALL = {"n", "lo_f", "lo_r"}      # bounded by the shard's words; the others are ids
INDEX = ("group long, symbols binary, fwd binary, rev binary, "
         + ", ".join(f"{c} binary" for c in STATE))
LEVEL = ("group long, parent long, word long, n long, "
         "left_min long, left_max long, right_min long, right_max long")
SLICE = 200_000                     # rows of counts in one Arrow batch
HELD = 2_000_000                    # counts of a group that a task holds at most, about


def _batch(schema: str, rows: int, **columns) -> pa.RecordBatch:
    names, types = zip(*(c.split() for c in schema.split(", ")))
    types = [{"long": pa.int64(), "binary": pa.binary()}[t] for t in types]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c]).cast(t) if c in columns else pa.nulls(rows, t)
         for c, t in zip(names, types)], names=list(names))


def _sliced(schema: str, fixed: dict, **columns):
    """Rows of equally long ``columns``, in slices; ``fixed`` has one value for all."""
    total = len(next(iter(columns.values())))
    for i in range(0, total, SLICE):
        part = {c: x[i:i + SLICE] for c, x in columns.items()}
        k = min(SLICE, total - i)
        yield _batch(schema, k, **{c: np.full(k, v) for c, v in fixed.items()}, **part)


def _packed(state: dict) -> dict:
    return {c: [x.astype(np.int32 if c in _SMALL else np.int64).tobytes()]
            for c, x in state.items()}


def _unpacked(c: str, value) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.int32 if c in _SMALL else np.int64
                         ).astype(np.int64)


def _found(key: np.ndarray, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The id of each ``at`` among the sorted ``key``; 0 where it is missing."""
    near = np.minimum(np.searchsorted(key, at), len(key) - 1)
    return np.where(key[near] == at, ids[near], 0)


def _coded(words, known) -> tuple[np.ndarray, np.ndarray]:
    """The shard's sequence with frequent words as 1, 2, ... in order of their ids and 0
    for the rest, and the ids by symbol (0 for 0)."""
    ids, local = known.values.field("id").to_numpy(), known.values.field("local").to_numpy()
    order = np.argsort(ids)
    t = np.frombuffer(words.as_buffer(), dtype=np.int32)
    code = np.zeros(max(int(t.max()), int(local.max())) + 1, dtype=np.int32)
    code[local[order]] = np.arange(1, len(ids) + 1, dtype=np.int32)
    return code[t], np.concatenate([[0], ids[order]]).astype(np.int64)


def _runs(t: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """``t`` cut wherever ``linked`` (of each symbol to the next) is false: its runs of two
    symbols or more, a 0 before, between and after them."""
    before = np.append(False, linked)
    after = np.append(linked, False)
    keep = before | after
    t, begins = t[keep], ~before[keep]
    out = np.zeros(len(t) + int(begins.sum()) + 1, dtype=np.int32)
    out[np.arange(len(t)) + np.cumsum(begins)] = t
    return out


def _single(t: np.ndarray, symbols: int):
    """Symbols that occur, their first rows and their counts."""
    count = np.bincount(t, minlength=symbols)
    lo = np.cumsum(count) - count
    used = np.flatnonzero(count[1:]) + 1
    return used, lo[used], count[used]


def _pair_batches(batches):
    """(shard, words, [(local, id)]) -> counts of the shard's two-word phrases."""
    for batch in batches:
        for shard, words, known in zip(*batch.columns):
            t, symbols = _coded(words, known)
            t = _runs(t, (t[:-1] > 0) & (t[1:] > 0))
            if len(t) > 2:
                used, lo, n = _single(t, len(symbols))
                rev = transform(t[::-1])
                first, word, _, _, n = extend_right(rev, last_to_first(rev), lo, lo, n)
                yield from _sliced(PAIRS, {"shard": shard.as_py()},
                                   parent=symbols[used][first], word=symbols[word], n=n)


def _index_batches(batches):
    """(group, words, [(local, id)], [(parent, word, id)]) -> the shard's index over its
    frequent pairs of words, their neighbours and extensions."""
    for batch in batches:
        for group, words, known, pairs in zip(*batch.columns):
            t, symbols = _coded(words, known)
            ids = pairs.values.field("id").to_numpy()
            key = (np.searchsorted(symbols, pairs.values.field("parent").to_numpy())
                   * len(symbols)
                   + np.searchsorted(symbols, pairs.values.field("word").to_numpy()))
            order = np.argsort(key)
            key, ids = key[order], ids[order]
            at = t[:-1].astype(np.int64) * len(symbols) + t[1:]
            near = np.minimum(np.searchsorted(key, at), len(key) - 1)
            t = _runs(t, key[near] == at)
            fwd, rev = transform(t), transform(t[::-1])
            used, lo, n = _single(t, len(symbols))
            first, word, f, r, n = extend_right(rev, last_to_first(rev), lo, lo, n)
            own = _found(key, ids, used[first] * len(symbols) + word)
            yield _batch(INDEX, 1, group=[group.as_py()], symbols=[symbols.tobytes()],
                         fwd=[fwd.tobytes()], rev=[rev.tobytes()],
                         **_grown(own, symbols, fwd, rev, f, r, n,
                                  lambda p, c: _found(key, ids, word[p] * len(symbols) + c)))


def _grown(ids, symbols, fwd, rev, f, r, n, tails) -> dict:
    """The phrases ``ids`` with their neighbours, and their extensions with intervals.
    ``tails`` (phrase numbers, words -> the id of the extension's phrase without its first
    word, 0: not frequent) drops extensions that cannot be frequent."""
    left, right = neighbours(fwd, f, n), neighbours(rev, r, n)
    phrase, word, lo_f, lo_r, count = extend_right(rev, last_to_first(rev), f, r, n)
    tail = tails(phrase, word)
    ok = tail > 0
    return _packed({
        "parent": ids[phrase[ok]], "word": symbols[word[ok]], "tail": tail[ok],
        "n": count[ok], "lo_f": lo_f[ok], "lo_r": lo_r[ok], "own": ids,
        "left_min": symbols[left[0]], "left_max": symbols[left[1]],
        "right_min": symbols[right[0]], "right_max": symbols[right[1]]})


def _frequent(known, parent, word) -> np.ndarray:
    """The ids of the phrases (``parent``, ``word``) among ``known``; 0 where missing."""
    heads, words = (np.unique(known.values.field(c).to_numpy()) for c in ("parent", "word"))
    key, ids = (np.searchsorted(heads, known.values.field("parent").to_numpy()) * len(words)
                + np.searchsorted(words, known.values.field("word").to_numpy()),
                known.values.field("id").to_numpy())
    order = np.argsort(key)
    head, tail = (_found(x, np.arange(1, len(x) + 1), at)
                  for x, at in ((heads, parent), (words, word)))
    own = _found(key[order], ids[order], (head - 1) * len(words) + tail - 1)
    return np.where((head > 0) & (tail > 0), own, 0)


def _extend_batches(batches):
    """(group, symbols, fwd, rev, candidates, [(parent, word, id)]) -> the index again, with
    the neighbours and extensions of those candidates that are known to be frequent."""
    used = STATE[:6]
    for batch in batches:
        for group, *index, known in zip(*batch.columns):
            index, state = index[:3], index[3:]
            parent, word, tail, n, f, r = map(_unpacked, used, state)
            ids = _frequent(known, parent, word)
            ok = ids > 0
            if not ok.any():
                continue
            parent, word, tail, n, f, r, ids = (x[ok] for x in (parent, word, tail, n, f, r, ids))
            symbols, fwd, rev = (np.frombuffer(x.as_buffer(), dtype=t) for x, t in
                                 zip(index, (np.int64, np.int32, np.int32)))
            # (parent, word) of every known phrase as one number, in order
            heads = np.unique(parent)
            key = np.searchsorted(heads, parent) * len(symbols) + np.searchsorted(symbols, word)
            order = np.argsort(key)
            key, own = key[order], ids[order]
            head = _found(heads, np.arange(1, len(heads) + 1), tail)

            def tails(p, c):
                at = _found(key, own, (head[p] - 1) * len(symbols) + c)
                return np.where(head[p] > 0, at, 0)

            yield _batch(INDEX, 1, group=[group.as_py()], symbols=[symbols.tobytes()],
                         fwd=[fwd.tobytes()], rev=[rev.tobytes()], **_grown(
                             ids, symbols, fwd, rev, f, r, n, tails))


def _summed(parent, word, n):
    order = np.lexsort((word, parent))
    parent, word, n = parent[order], word[order], n[order]
    if not len(n):
        return parent, word, n
    at = np.flatnonzero(np.append(True, (np.diff(parent) != 0) | (np.diff(word) != 0)))
    return parent[at], word[at], np.add.reduceat(n, at)


def _spanned(own, *beside):
    """Per phrase the smallest and largest neighbours of (min, max, min, max) rows."""
    order = np.argsort(own, kind="stable")
    own = own[order]
    if not len(own):
        return own, *beside
    at = np.flatnonzero(np.append(True, np.diff(own) != 0))
    return own[at], *(f.reduceat(x[order], at) for f, x in zip(
        (np.minimum, np.maximum, np.minimum, np.maximum), beside))


def _sum_batches(batches):
    """(group, parent, word, n, own, neighbours) of shards, a group's together -> rows of
    the group: counts of its candidates, neighbours of its phrases. A group of more than
    ``HELD`` counts, or whose shards do not come together, only makes more rows."""
    columns = ["parent", "word", "n", *STATE[6:]]
    at, counts, beside = None, [], []

    def summed():
        counts[:] = [_summed(*map(np.concatenate, zip(*counts)))]
        beside[:] = [_spanned(*map(np.concatenate, zip(*beside)))]

    def rows():
        if len(counts) > 1:
            summed()
        yield from _sliced(LEVEL, {"group": at}, **dict(zip(columns[:3], counts[0])))
        yield from _sliced(LEVEL, {"group": at}, **dict(zip(["parent", *STATE[7:]], beside[0])))

    for batch in batches:
        for group, *state in zip(*batch.columns):
            if counts and group.as_py() != at:
                yield from rows()
                counts, beside = [], []
            at = group.as_py()
            state = [*map(_unpacked, columns, state)]
            counts.append(state[:3])
            beside.append(state[3:])
            if sum(len(x[0]) for x in counts + beside) > HELD:
                summed()
                if sum(len(x[0]) for x in counts + beside) > HELD // 2:
                    yield from rows()
                    counts, beside = [], []
    if counts:
        yield from rows()


# -- levels over all shards ---------------------------------------------------------------

def _numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once with a unique positive ``id`` per row."""
    return durable(df.withColumn("id", F.monotonically_increasing_id() + 1), name)


def _keys(df: DataFrame, *columns: str) -> DataFrame:
    """The key columns of a written table for a join, broadcast if their bytes, measured,
    are within ``BROADCAST_BYTES``; beyond that the join shuffles."""
    keys = df.select(*columns)
    size = F.lit(0)
    for c, kind in keys.dtypes:
        size = size + (F.octet_length(c) + 16 if kind == "string" else F.lit(8))
    held = keys.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(keys) if held <= BROADCAST_BYTES else keys


def _known(rows: DataFrame, keys: DataFrame, on: list[str], columns: list[str],
           by: str = "shard") -> DataFrame:
    """Per shard (or group) the list of ``columns`` of its rows whose key is among ``keys``."""
    hit = F.when(F.col("id").isNotNull(), F.struct(*columns))
    return (rows.join(keys, on, "left").groupBy(by)
            .agg(F.collect_list(hit).alias("known")).where(F.size("known") > 0))


def _grouped(shards: DataFrame, totals: DataFrame) -> DataFrame:
    """(shard, group, words): the shards of each language dealt to groups, as many as its
    share of Spark's cores, rounded up."""
    cores = shards.sparkSession.sparkContext.defaultParallelism
    words = totals.agg(F.sum("n")).first()[0] or 1
    share = F.ceil(F.col("all") * cores / words).cast("long")
    return (shards.where("words IS NOT NULL")
            .join(totals.select("lang", F.col("n").alias("all")), "lang")
            .select("shard", F.xxhash64("lang", F.pmod(F.xxhash64("shard"), share))
                    .alias("group"), "words"))


def _broadcast(lists: DataFrame) -> DataFrame:
    """Written lists of groups for a join, broadcast within ``BROADCAST_BYTES``."""
    held = 24 * (lists.agg(F.sum(F.size("known"))).first()[0] or 0)
    return F.broadcast(lists) if held <= BROADCAST_BYTES else lists


def _level(state: DataFrame, name: str) -> DataFrame:
    """The counts and neighbours of ``state`` summed by group, written."""
    return durable(state.select("group", "parent", "word", "n", *STATE[6:])
                   .repartition("group").sortWithinPartitions("group")
                   .mapInArrow(_sum_batches, LEVEL), name)


def frequent_phrases(docs: DataFrame, least: int, shard_bytes: int = SHARD_BYTES
                     ) -> tuple[DataFrame, DataFrame]:
    """Every phrase of 1 to ``LONGEST`` words that occurs ``least`` times in a language:
    (lang, ids, phrase, f, closed), and (lang, n) with all its words.

    ``ids`` numbers the words. ``closed`` is false if every occurrence has the same word
    before it, or every one the same word after it, so that a longer phrase is as
    frequent (never for the longest; null for single words).
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    shards = durable(texts.mapInArrow(_shard_batches(shard_bytes), SHARDS), "phrase-shards")
    vocabulary = shards.where("word IS NOT NULL")
    counted = durable(vocabulary.groupBy("lang", "word").agg(F.sum("n").alias("f")),
                      "phrase-words")
    totals = durable(counted.groupBy("lang").agg(F.sum("f").alias("n")), "phrase-totals")
    words = _numbered(counted.where(F.col("f") >= least), "phrase-level1")
    discard(counted)
    texts = _grouped(shards, totals)
    coded = durable(_known(vocabulary.select("lang", "word", "shard", "local"),
                           _keys(words, "lang", "word", "id"), ["lang", "word"],
                           ["local", "id"]), "phrase-symbols")
    level = durable(texts.join(coded, "shard").select("shard", "words", "known")
                    .mapInArrow(_pair_batches, PAIRS), "phrase-pairs")
    by_id = words.select(F.col("id").alias("word"), F.col("word").alias("spelled"))
    parents = words.select("lang", "id", F.array("id").alias("ids"),
                           F.col("word").alias("phrase"), "f")
    out = [parents.select("lang", "ids", "phrase", "f", F.lit(None).cast("boolean").alias("closed"))]
    state = None
    for size in range(2, LONGEST + 1):
        rows = level.where("word IS NOT NULL")
        found = rows.groupBy("parent", "word").agg(F.sum("n").alias("f")).where(
            F.col("f") >= least)
        named = (found.join(by_id, "word").join(
            parents.select(F.col("id").alias("parent"), "lang", "ids", "phrase"), "parent")
            .select("lang", "parent", "word", F.concat("ids", F.array("word")).alias("ids"),
                    F.concat_ws(" ", "phrase", "spelled").alias("phrase"), "f"))
        phrases = _numbered(named, f"phrase-level{size}")
        if size == LONGEST:
            out.append(phrases.select("lang", "ids", "phrase", "f", F.lit(True).alias("closed")))
            break
        by = "shard" if size == 2 else "group"
        known = durable(_known(rows.select("parent", "word", by),
                               _keys(phrases, "parent", "word", "id"),
                               ["parent", "word"], ["parent", "word", "id"], by),
                        f"phrase-known{size}")
        discard(level)
        if size == 2:
            step = (texts.join(coded, "shard")
                    .join(known.withColumnRenamed("known", "pairs"), "shard")
                    .select("group", "words", "known", "pairs"))
            state = durable(step.mapInArrow(_index_batches, INDEX), "phrase-index")
            discard(shards, coded)
        else:
            step = state.join(_broadcast(known), "group").select(
                "group", "symbols", "fwd", "rev", *STATE[:6], "known")
            before, state = state, durable(step.mapInArrow(_extend_batches, INDEX),
                                           f"phrase-candidates{size}")
            discard(before)
        discard(known)
        level = _level(state, f"phrase-extensions{size}")
        beside = (level.where("left_min IS NOT NULL").groupBy("parent").agg(
            F.min("left_min").alias("a"), F.max("left_max").alias("b"),
            F.min("right_min").alias("c"), F.max("right_max").alias("d"))
            .select(F.col("parent").alias("id"), (
                ~((F.col("a") == F.col("b")) & (F.col("a") > 0))
                & ~((F.col("c") == F.col("d")) & (F.col("c") > 0))).alias("closed")))
        parents = durable(phrases.join(beside, "id"), f"phrase-judged{size}")
        discard(phrases)
        out.append(parents.select("lang", "ids", "phrase", "f", "closed"))
    discard(state, level)
    result = out[0]
    for o in out[1:]:
        result = result.unionByName(o)
    return result, totals


def collocations(docs: DataFrame, least: int = 100, top: int | None = None,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Collocations per language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase of 2 to ``LONGEST`` words that occurs ``a >= least`` times is cut where
    ``floor(1000 * a * n / (l * r))`` is lowest (ties: the shorter left part); it is left
    out if a longer phrase with all of its occurrences exists. ``top`` keeps the first
    rows of each language (None: all). Null texts are empty, a null language is ``und``;
    repeated rows count each time; an empty table gives no rows. Columns other than
    ``text`` and ``lang`` are not read. Counts up to 10^15 are exact.
    """
    phrases, totals = frequent_phrases(docs, least, shard_bytes)
    parts = phrases.select("ids", "f")
    cuts = (phrases.where(F.size("ids") > 1).where("closed").withColumn(
        "k", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)))
        .withColumn("left", F.slice("ids", F.lit(1), F.col("k")))
        .withColumn("right", F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k"))))
    scored = (cuts.join(parts.select(F.col("ids").alias("left"), F.col("f").alias("l")), "left")
              .join(parts.select(F.col("ids").alias("right"), F.col("f").alias("r")), "right")
              .join(totals, "lang").withColumn("a", F.col("f"))
              .withColumn("score", F.expr(
                  "(CAST(a AS DECIMAL(15,0)) * 1000 * CAST(n AS DECIMAL(15,0)))"
                  " div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))")))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = [F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase")]
    ranked = best.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", F.col("cut.l").alias("l"),
                         F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
