"""Substring dedup with a logarithmic family of suffix-array levels.

A string of ``MATCH`` bytes is repeated if it starts at two places. Not every suffix has
to be sorted to find all such strings: the *anchor* of a window of ``MATCH`` bytes is the
leftmost minimum of a hash over the ``DEPTH``-byte strings inside the window, so it depends
on the window's bytes only, and equal windows have equal anchors at equal offsets. About
one suffix in 170 is an anchor. Neighbouring windows with the same anchor form one *entry*:
their joint bytes (the entry's context) start at most ``MATCH - DEPTH`` bytes before it.

* New texts are a batch. Its suffix array is the table of its entries sorted by the first
  ``DEPTH`` bytes of the anchored suffix, equal contexts counted in one row.
* The array is merge-scanned against the existing levels: rows of both that agree in the
  sort key are long matches. Equal contexts settle at once; different contexts with one
  key are compared window by window.
* Levels hold 1, 2, 4, ... batches. A new array and the levels it fills up are merged in
  one pass into the next level, so a row is rewritten once per doubling.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import discard, durable

MATCH = 400
DEPTH = 128
SPAN = MATCH - DEPTH + 1        # anchors to choose from in one window

_M = (1 << 64) - 1
_BASE = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), dtype=np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Rolling:
    """Hashes of any substring of one byte block, two independent 64-bit ones."""

    _cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, block: np.ndarray):
        self.sums, n = [], len(block) + 1
        for k, base in enumerate(_BASE):
            have = self._cache.get(k)
            if have is None or len(have[0]) < n:
                size = max(n, 1 << 22)
                have = self._cache[k] = (_powers(base, size),
                                         _powers(pow(base, -1, 1 << 64), size))
            values = np.random.default_rng(k + 1).integers(1, _M, 256, dtype=np.uint64)
            s = np.zeros(n, dtype=np.uint64)
            np.cumsum(values[block] * have[0][:n - 1], out=s[1:])
            self.sums.append(s)

    def of(self, k: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        s = self.sums[k]
        return _mix((s[end] - s[start]) * self._cache[k][1][start]
                    + (end - start).astype(np.uint64))

    def all_of(self, k: int, length: int) -> np.ndarray:
        s = self.sums[k]
        n = len(s) - length
        return _mix((s[length:] - s[:n]) * self._cache[k][1][:n])


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of ``v[i:i + w]`` for every full window."""
    n = len(v) - w + 1
    pad = -len(v) % w
    rows = np.concatenate([v, np.full(pad, _M, dtype=np.uint64)]).reshape(-1, w)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1:w - 1 + n])


def entries(block: np.ndarray, bounds: np.ndarray, roll: Rolling):
    """Anchored entries of the texts ``block[bounds[i]:bounds[i + 1]]``: arrays of text
    number, first window, last window and anchor (places in the block)."""
    none = np.empty(0, dtype=np.int64)
    if len(block) < MATCH:
        return none, none, none, none
    grams = roll.all_of(0, DEPTH)
    key = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_sliding_min(key, SPAN) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:len(anchor)]
    window = np.arange(len(anchor))
    inside = window + MATCH <= bounds[text + 1]
    window, anchor, text = window[inside], anchor[inside], text[inside]
    if not len(window):
        return none, none, none, none
    new = np.ones(len(window), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    return text[first], window[first], window[last], anchor[first]


# -- entries of texts ---------------------------------------------------------------------

ENTRY = "t1 long, t2 long, head binary, deep long, c1 long, c2 long, at long, lead int, tail int"
TEXT = ["t1", "t2"]             # 128-bit identity of a text
RUN = ["head", "deep"]          # sort key of a suffix: its first bytes, then its DEPTH bytes
PLACE = [*RUN, "c1", "c2"]      # a context: 128-bit hash of its bytes
REP = [*TEXT, "at", "lead", "tail"]
HEAD = 16                       # bytes of the sort key that are stored as they are
BLOCK = 16                      # windows that are compared together first


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and the text's identity of every row."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"))


def _blocks(batches, chars: int = 1 << 21):
    """(identities, byte block, bounds) of some texts together; a longer text alone."""
    keys, texts, size = [], [], 0

    def packed():
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        return keys, np.frombuffer(b"".join(texts), dtype=np.uint8), bounds

    for batch in batches:
        for k, text in enumerate(batch.column(2)):
            t = text.as_buffer().to_pybytes()
            if size and size + len(t) > chars:
                yield packed()
                keys, texts, size = [], [], 0
            keys.append((batch.column(0)[k].as_py(), batch.column(1)[k].as_py()))
            texts.append(t)
            size += len(t)
    if keys:
        yield packed()


def _fixed(block: np.ndarray, start: np.ndarray, length: int) -> pa.Array:
    rows = np.lib.stride_tricks.sliding_window_view(block, length)[start]
    offsets = np.arange(len(start) + 1, dtype=np.int32) * length
    return pa.Array.from_buffers(pa.binary(), len(start), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _context(roll: Rolling, k: int, first, last, anchor) -> np.ndarray:
    return _mix(roll.of(k, first, last + MATCH) + (anchor - first).astype(np.uint64)
                * np.uint64(0x9E3779B97F4A7C15))


def _entry_batches(batches):
    for keys, block, bounds in _blocks(batches):
        roll = Rolling(block)
        text, first, last, anchor = entries(block, bounds, roll)
        if len(text):
            yield pa.RecordBatch.from_arrays([
                *[pa.array(c, pa.int64()).take(pa.array(text)) for c in zip(*keys)],
                _fixed(block, anchor, HEAD),
                _signed(roll.of(0, anchor, anchor + DEPTH)),
                _signed(_context(roll, 0, first, last, anchor)),
                _signed(_context(roll, 1, first, last, anchor)),
                pa.array(anchor - bounds[text]),
                pa.array((anchor - first).astype(np.int32)),
                pa.array((anchor - last).astype(np.int32)),
            ], names=[c.split()[0] for c in ENTRY.split(", ")])


def entry_rows(texts: DataFrame) -> DataFrame:
    """One row per entry of each row of ``texts`` (identity, text)."""
    return texts.select(*TEXT, F.col("text").cast("binary")).mapInArrow(_entry_batches, ENTRY)


# -- the family of levels -----------------------------------------------------------------

def suffix_array(rows: DataFrame) -> DataFrame:
    """Suffix array of a batch of entries: one row per context with its number of places
    (``n``) and one of them, sorted by the anchored suffix within each partition."""
    return (rows.groupBy(*PLACE).agg(F.count("*").alias("n"),
                                     *[F.first(c).alias(c) for c in REP])
            .withColumn("fresh", F.lit(True)))


def _merged(parts: list[DataFrame]) -> DataFrame:
    """Merge of suffix arrays over disjoint places; ``fresh`` if any part's row is."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return (rows.repartition(*RUN).groupBy(*PLACE)
            .agg(F.sum("n").alias("n"), *[F.first(c).alias(c) for c in REP],
                 F.max("fresh").alias("fresh"))
            .sortWithinPartitions(*PLACE))


def _long_matches(array: DataFrame) -> DataFrame:
    """Rows of runs (equal sort key) that hold a fresh row and more than one place."""
    runs = (array.groupBy(*RUN).agg(F.sum("n").alias("places"), F.max("fresh").alias("new"))
            .where("places > 1 AND new").select(*RUN))
    return array.join(runs, RUN, "left_semi")


class SuffixFamily:
    """Suffix-array levels of everything added so far and the long matches found on the way.

    ``add`` costs one shuffle of the batch, one merge of the levels it fills up and one
    scan of each larger level. Levels live under the shared checkpoint folder; a level
    that has been merged is deleted.
    """

    def __init__(self):
        self.levels: dict[int, DataFrame] = {}
        self.found: list[DataFrame] = []

    def add(self, rows: DataFrame) -> None:
        new = durable(_merged([suffix_array(rows)]), "suffix-batch")
        rank, parts = 0, []
        while rank in self.levels:
            parts.append(self.levels.pop(rank))
            rank += 1
        old = [p.withColumn("fresh", F.lit(False)) for p in parts]
        top = durable(_merged([new, *old]), f"suffix-level{rank}") if parts else new
        self.found.append(durable(_long_matches(top), "suffix-found"))
        for level in self.levels.values():
            both = _merged([new, level.withColumn("fresh", F.lit(False))])
            self.found.append(durable(_long_matches(both), "suffix-found"))
        discard(*parts, *([new] if parts else []))
        self.levels[rank] = top

    def matches(self) -> DataFrame:
        """One row per context found in a long match, with the most places one scan saw."""
        rows = self.found[0]
        for f in self.found[1:]:
            rows = rows.unionByName(f)
        return rows.groupBy(*PLACE).agg(F.max("n").alias("n"),
                                         *[F.first(c).alias(c) for c in REP])


# -- from long matches to repeated windows ------------------------------------------------

CONTEXT = "deep long, c1 long, c2 long, lead int, tail int, bytes binary"


def _cut_contexts(batches):
    names, seen = [c.split()[0] for c in CONTEXT.split(", ")], set()
    for batch in batches:
        out = []
        for t1, t2, text, reps in zip(*batch.columns):
            if (key := (t1.as_py(), t2.as_py())) in seen:     # a copy in the same task
                continue
            seen.add(key)
            t = text.as_buffer().to_pybytes()
            out += [(r["deep"], r["c1"], r["c2"], r["lead"], r["tail"],
                     t[r["at"] - r["lead"]:r["at"] - r["tail"] + MATCH]) for r in reps.as_py()]
        for i in range(0, len(out), 20_000):
            part = list(zip(*out[i:i + 20_000]))
            yield pa.RecordBatch.from_arrays([
                *[pa.array(c, pa.int64()) for c in part[:3]],
                *[pa.array(c, pa.int32()) for c in part[3:5]],
                pa.array(part[5], pa.binary())], names=names)


def _hash_blocks(batches):
    """Per context and block of ``BLOCK`` offsets: hashes of the bytes that all windows of
    the block share (core) and of all their bytes (hull)."""
    for batch in batches:
        for ids, roll, lead, tail, start in _rolled(batch):
            lo, hi = tail // BLOCK, lead // BLOCK
            n = hi - lo + 1
            row = np.repeat(np.arange(len(n)), n)
            j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[row]
            at = start[row] + lead[row]
            first = at - np.minimum(lead[row], j * BLOCK + BLOCK - 1)
            last = at - np.maximum(tail[row], j * BLOCK)
            core = roll.of(0, at - j * BLOCK, at - j * BLOCK - BLOCK + 1 + MATCH)
            hull = _mix(roll.of(0, first, last + MATCH)
                        + ((at - first) * 512 + at - last).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([
                *[c.take(pa.array(row)) for c in ids], pa.array(j.astype(np.int32)),
                _signed(core), _signed(hull)],
                names=["deep", "c1", "c2", "j", "core", "hull"])


def _rolled(batch, size: int = 4000):
    for i in range(0, batch.num_rows, size):
        part = batch.slice(i, size)
        col = {n: part.column(k) for k, n in enumerate(part.schema.names)}
        lead = col["lead"].to_numpy().astype(np.int64)
        tail = col["tail"].to_numpy().astype(np.int64)
        data = b"".join(col["bytes"].to_pylist())
        length = lead - tail + MATCH
        yield ([col["deep"], col["c1"], col["c2"]], Rolling(np.frombuffer(data, np.uint8)),
               lead, tail, np.cumsum(length) - length)


def _hash_windows(batches):
    for batch in batches:
        blocks = batch.column(batch.schema.names.index("blocks"))
        seen = 0
        for ids, roll, lead, tail, start in _rolled(batch):
            own = blocks.slice(seen, len(lead)).to_pylist()
            seen += len(lead)
            row = np.repeat(np.arange(len(own)), [len(b) * BLOCK for b in own])
            offset = (np.array([j for b in own for j in b], dtype=np.int64)[:, None] * BLOCK
                      + np.arange(BLOCK)).ravel()
            ok = (offset >= tail[row]) & (offset <= lead[row])
            row, offset = row[ok], offset[ok]
            p = start[row] + lead[row] - offset
            yield pa.RecordBatch.from_arrays([
                *[c.take(pa.array(row)) for c in ids], pa.array(offset.astype(np.int32)),
                _signed(roll.of(0, p, p + MATCH))], names=["deep", "c1", "c2", "o", "w"])


def repeated_offsets(found: DataFrame, texts: DataFrame) -> DataFrame:
    """(c1, c2, lo, hi): offsets from the anchor back to the windows of a context that
    start at two places or more.

    Contexts with two places are repeated as a whole. The others are compared with the
    contexts of their run, first in blocks of windows (equal hulls settle a block, different
    cores rule it out), then window by window; counts are grouped sums, so a run of any
    size spreads over tasks.
    """
    found = durable(found, "suffix-matches")
    whole = found.where("n > 1").select("c1", "c2", F.col("tail").alias("lo"),
                                        F.col("lead").alias("hi"))
    runs = (found.groupBy(*RUN).agg(F.count("*").alias("contexts"), F.min("n").alias("least"))
            .where("contexts > 1 AND least = 1").select(*RUN))
    wanted = (found.join(runs, RUN, "left_semi").groupBy(*TEXT)
              .agg(F.collect_list(F.struct("deep", "c1", "c2", "at", "lead", "tail"))
                   .alias("reps")))
    contexts = durable(texts.join(wanted, TEXT)
                       .select(*TEXT, F.col("text").cast("binary"), "reps")
                       .mapInArrow(_cut_contexts, CONTEXT).dropDuplicates(["c1", "c2"]),
                       "suffix-contexts")
    blocks = durable(contexts.mapInArrow(
        _hash_blocks, "deep long, c1 long, c2 long, j int, core long, hull long"),
        "suffix-blocks")
    core, hull = ["deep", "j", "core"], ["deep", "j", "hull"]
    cores = blocks.groupBy(*core).count().where("count > 1").select(*core)
    hulls = (blocks.groupBy(*hull).count().where("count > 1")
             .select(*hull, F.lit(True).alias("settled")))
    state = durable(blocks.join(cores, core, "left_semi").join(hulls, hull, "left"),
                    "suffix-block-state")
    # the partners of an open block's windows may lie in settled blocks of the same core
    opened = state.where("settled IS NULL").select(*core).distinct()
    near = (state.join(opened, core, "left_semi").groupBy("c1", "c2")
            .agg(F.collect_list("j").alias("blocks")))
    windows = durable(contexts.join(near, ["c1", "c2"]).mapInArrow(
        _hash_windows, "deep long, c1 long, c2 long, o int, w long"), "suffix-windows")
    twice = windows.groupBy("deep", "o", "w").count().where("count > 1").drop("count")
    single = windows.join(twice, ["deep", "o", "w"], "left_semi").select(
        "c1", "c2", F.col("o").alias("lo"), F.col("o").alias("hi"))
    settled = (state.where("settled").join(contexts.select("c1", "c2", "lead", "tail"),
                                           ["c1", "c2"])
               .select("c1", "c2", F.greatest("tail", F.col("j") * BLOCK).alias("lo"),
                       F.least("lead", F.col("j") * BLOCK + BLOCK - 1).alias("hi")))
    out = durable(whole.unionByName(settled).unionByName(single), "suffix-offsets")
    discard(found, contexts, blocks, state, windows)
    return out


def repeated_spans(texts: DataFrame, batches: int = 4) -> DataFrame:
    """(t1, t2, spans): per distinct text the byte ranges (a, b) that strings of ``MATCH``
    bytes starting at two places cover; ranges may overlap. ``texts`` (t1, t2, text) holds
    a row per document, copies repeatedly: each is a place."""
    rows = durable(entry_rows(texts).withColumn(
        "batch", F.pmod("t1", F.lit(batches)).cast("int")), "suffix-entries",
        partition_by="batch")
    family = SuffixFamily()
    for b in range(batches):
        family.add(rows.where(F.col("batch") == b).drop("batch"))
    offsets = repeated_offsets(family.matches(), texts)
    discard(*family.levels.values(), *family.found)
    spans = durable(rows.select(*TEXT, "c1", "c2", "at").join(offsets, ["c1", "c2"])
                    .select(*TEXT, (F.col("at") - F.col("hi")).alias("a"),
                            (F.col("at") - F.col("lo") + MATCH).alias("b"))
                    .groupBy(*TEXT).agg(F.collect_set(F.struct("a", "b")).alias("spans")),
                    "suffix-spans")
    discard(rows, offsets)
    return spans


def _joined(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges ``a`` to ``b`` as disjoint, maximal ones in order."""
    order = np.argsort(a, kind="stable")
    a, reach = a[order], np.maximum.accumulate(b[order])
    new = np.flatnonzero(np.append(True, a[1:] > reach[:-1]))
    return a[new], reach[np.append(new[1:], len(a)) - 1]


def _cut_batches(batches):
    for batch in batches:
        kept, length, starts, stops = [], [], [], []
        for text, spans in zip(batch.column(1), batch.column(2)):
            t = text.as_buffer().to_pybytes()
            a = b = np.empty(0, dtype=np.int64)
            if spans.is_valid and len(spans.values):
                a, b = _joined(spans.values.field("a").to_numpy(),
                               spans.values.field("b").to_numpy())
            out, end = [], 0
            for i, j in zip(a.tolist(), b.tolist()):
                out.append(t[end:i])
                end = j
            out.append(t[end:])
            kept.append(b"".join(out))
            length.append(len(t))
            starts.append(a)
            stops.append(b)
        removed = [int((b - a).sum()) for a, b in zip(starts, stops)]
        offsets = np.concatenate([[0], np.cumsum([len(a) for a in starts])]).astype(np.int32)
        ranges = pa.StructArray.from_arrays(
            [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (starts, stops)],
            names=["start", "stop"])
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(length, pa.int64()), pa.array(removed, pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), ranges), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "removed", "kept"])


def without_repeats(docs: DataFrame, batches: int = 4) -> DataFrame:
    """Every row of ``docs`` with the bytes that no repeated string of ``MATCH`` bytes covers.

    ``doc_id, n_bytes, n_removed, removed`` (maximal removed ranges, bytes from 0) and
    ``kept`` (the other bytes joined; a cut may fall inside a character). Texts are UTF-8
    bytes, null is empty, shorter ones stay whole. Each row is a document, so repeated rows
    and copies of ``MATCH`` bytes or more lose everything. ``doc_id`` may be null or
    repeated; other columns are not read. An empty table gives no rows.
    """
    texts = keyed(docs)
    spans = repeated_spans(texts.select(*TEXT, "text"), batches)
    return (texts.join(spans, TEXT, "left")
            .select("doc_id", F.col("text").cast("binary"), "spans")
            .mapInArrow(_cut_batches, "doc_id long, n_bytes long, n_removed long, removed "
                        "array<struct<start:long,stop:long>>, kept binary"))
