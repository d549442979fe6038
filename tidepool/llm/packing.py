"""Packing token pieces into sequences by a configuration linear program.

Only the histogram of piece lengths (at most ``capacity`` numbers) reaches the driver. A
configuration is a multiset of lengths that fits one sequence. The covering program
(fewest configurations that use every piece) is solved by multiplicative weights: every
length has a price, a knapsack dynamic program finds the dearest configuration, the chosen
configurations are used a little, and prices of lengths that are served well fall. The
fractional solution is rounded down and what is left is placed by best fit on the
histogram. Pieces get their place from their rank among pieces of the same length.
"""

from __future__ import annotations

import base64
import bisect
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tidepool.llm.common import documents, durable

CAPACITY = 2048
VOCABULARY = "byte_bpe_50k"     # name of a public tokenizer; its files stay where they are
SPECIAL = "<|endoftext|>"
BATCH = 400                     # least served lengths tried per pricing round
LEVELS = (1.0, 0.95, 0.9, 0.75, 0.5)
RANK_GROUP = 500                # pieces of one length ranked in one task, about


@lru_cache(1)
def _encoders(name: str) -> tuple[Tokenizer, tiktoken.Encoding]:
    """The tokenizer file and the same vocabulary as ranks, which encodes several times
    faster to the same ids (tests compare them)."""
    ranks = {base64.b64decode(a): int(b) for a, b in
             map(bytes.split, open(public_tokenizers.path(name + ".tiktoken"), "rb"))}
    return (Tokenizer.from_file(public_tokenizers.path(name + ".json")),
            tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                              special_tokens={}))


def token_ids(text: str | None, name: str = VOCABULARY) -> np.ndarray:
    """Ids of a whole text followed by id 0 (null text: empty)."""
    exact, fast = _encoders(name)
    t = text or ""
    ids = (exact.encode(t, add_special_tokens=False).ids if SPECIAL in t
           else fast.encode_ordinary(t))
    return np.array([*ids, 0], dtype="<u4")


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: all of full length but the first."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def tokenize(docs: DataFrame, capacity: int = CAPACITY, name: str = VOCABULARY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) per piece of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids = token_ids(text.as_py(), name)
                out += [(doc, k, s, n, zlib.crc32(ids[s:s + n].tobytes()))
                        for k, (s, n) in enumerate(pieces_of(len(ids), capacity))]
            cols = list(zip(*out)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds)],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return documents(docs).select("doc_id", "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _knapsack(prices: np.ndarray, lengths: np.ndarray, capacity: int):
    """Best total price for every room up to ``capacity`` (unbounded copies), and the index
    of the length to take there (-1: none)."""
    best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fit = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(int(lengths[0]), capacity + 1):
        k = fit[room]
        value = best[room - lengths[:k]] + prices[:k]
        i = int(value.argmax())
        if value[i] > best[room - 1]:
            best[room], take[room] = value[i], i
        else:
            best[room], take[room] = best[room - 1], -1
    return best, take


def _trace(room: int, take: np.ndarray, lengths: np.ndarray) -> list[int]:
    out = []
    while room > 0:
        i = take[room]
        if i < 0:
            room -= 1
        else:
            out.append(int(i))
            room -= int(lengths[i])
    return out


def solve(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = 300,
          epsilon: float = 0.05, step: float = 0.2, eta: float = 1.0) -> tuple[dict[tuple[int, ...], float], float]:
    """Fractional configurations {lengths, descending: sequences} that hold as many tokens
    as there are, and a lower bound on the sequences of any packing (from the best prices).

    In each round the knapsack table is priced once. Then, from the least served length on,
    the dearest configuration with that length is used for a ``step`` of its scarcest
    piece, unless it shares a length with one already used in this round or its price is
    more than ``epsilon`` below the best. Prices fall with what has been served.
    """
    lengths = np.array(sorted(histogram), np.int64)
    need = np.array([histogram[x] for x in lengths.tolist()], float)
    volume = lengths / capacity
    served, prices = np.zeros(len(lengths)), volume
    used: dict[tuple[int, ...], float] = {}
    bound = 0.0
    for _ in range(rounds):
        best, take = _knapsack(prices, lengths, capacity)
        bound = max(bound, float(need @ prices) / best[capacity])
        with_each = prices + best[capacity - lengths]
        touched = np.zeros(len(lengths), bool)
        for i in np.argsort(served, kind="stable")[:BATCH]:
            if touched[i] or with_each[i] < (1 - epsilon) * best[capacity]:
                continue
            config = [int(i), *_trace(int(capacity - lengths[i]), take, lengths)]
            idx, copies = np.unique(config, return_counts=True)
            if touched[idx].any():
                continue
            touched[idx] = True
            x = step * float((need[idx] / copies).min())
            served[idx] += x * copies / need[idx]
            key = tuple(sorted((int(lengths[c]) for c in config), reverse=True))
            used[key] = used.get(key, 0.0) + x
        prices = volume * np.exp(np.clip(eta * (served.mean() - served), -5, 5))
        if float(need @ (served * volume)) >= 3.0 * float(need @ volume):
            break
    share = float(need @ (served * volume)) / float(need @ volume)
    return {k: v / share for k, v in used.items()}, bound


class _Bins:
    """Sequences in groups of equal content: [count, room, [(length, copies), ...]]."""

    def __init__(self, capacity: int):
        self.capacity, self.groups = capacity, []
        self.by_room: dict[int, list[int]] = {}
        self.rooms: list[int] = []

    def add(self, count: int, content: list[tuple[int, int]]) -> None:
        room = self.capacity - sum(n * c for n, c in content)
        self.groups.append((count, room, content))
        if room:
            if room not in self.by_room:
                self.by_room[room] = []
                bisect.insort(self.rooms, room)
            self.by_room[room].append(len(self.groups) - 1)

    def best_fit(self, length: int, items: int) -> None:
        """Place ``items`` pieces of one length, each into the fullest sequence it fits."""
        while items:
            i = bisect.bisect_left(self.rooms, length)
            if i == len(self.rooms):
                per = self.capacity // length
                self.add(items // per, [(length, per)]) if items >= per else None
                if items % per:
                    self.add(1, [(length, items % per)])
                return
            room = self.rooms[i]
            g = self.by_room[room].pop()
            if not self.by_room[room]:
                del self.by_room[room], self.rooms[i]
            count, _, content = self.groups[g]
            self.groups[g] = (0, 0, [])
            per = room // length
            full, part = min(count, items // per), 0
            if full:
                self.add(full, [*content, (length, per)])
            if full < count:
                part = items - full * per
                if part:
                    self.add(1, [*content, (length, part)])
                if rest := count - full - bool(part):
                    self.add(rest, content)
            items -= full * per + part


def round_down(histogram: dict[int, int], plan: dict[tuple[int, ...], float], level: float,
               capacity: int) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Whole sequences from ``level`` times the fractional plan (each configuration at most
    as often as its pieces last), the remaining pieces by best fit, longest first."""
    left, bins, owed = dict(histogram), _Bins(capacity), 0.0
    for config, x in sorted(plan.items(), key=lambda kv: (-kv[1], kv[0])):
        owed += level * x
        content = sorted(Counter(config).items(), reverse=True)
        k = min(math.floor(owed), *(left[n] // c for n, c in content))
        if k > 0:
            bins.add(k, content)
            owed -= k
            for n, c in content:
                left[n] -= k * c
    for n in sorted(left, reverse=True):
        if left[n]:
            bins.best_fit(n, left[n])
    return [g for g in bins.groups if g[0]]


def pack(histogram: dict[int, int], capacity: int = CAPACITY):
    """Groups (count, room, content) that hold every piece of the histogram, and the lower
    bound; the rounding level with the fewest sequences wins."""
    if not histogram:
        return [], 0.0
    plan, bound = solve(histogram, capacity)
    tries = [round_down(histogram, plan, level, capacity) for level in LEVELS]
    return min(tries, key=lambda groups: sum(g[0] for g in groups)), bound


def slots(groups) -> pd.DataFrame:
    """Ranges of equal places: the pieces of ``length`` with rank ``first``.. go ``copies``
    to a sequence from ``sequence`` on, at ``offset`` there."""
    rows, taken, sequence = [], {}, 0
    for count, _, content in groups:
        offset = 0
        for length, copies in content:
            first = taken.get(length, 0)
            rows.append((length, first, sequence, copies, offset))
            taken[length] = first + count * copies
            offset += length * copies
        sequence += count
    return pd.DataFrame(rows, columns=["length", "first", "sequence", "copies", "offset"],
                        dtype="int64").sort_values(["length", "first"], ignore_index=True)


def ranked(pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """``rank`` of every piece among those of its length (from 0). Pieces of a length are
    first dealt into groups of about ``RANK_GROUP`` by hash and ranked there; group sizes
    are then added up, so no task holds all pieces of a frequent length."""
    groups = max(1, max(histogram.values()) // RANK_GROUP)
    p = pieces.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    sizes = p.groupBy("length", "g").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("g"))
    sizes = sizes.select("length", "g", (before - F.col("count")).alias("base"))
    within = Window.partitionBy("length", "g").orderBy("doc_id", "piece", "ids_crc32")
    return (p.withColumn("k", F.row_number().over(within) - 1).join(sizes, ["length", "g"])
            .withColumn("rank", F.col("base") + F.col("k")).drop("g", "k", "base"))


def packed(docs: DataFrame, capacity: int = CAPACITY, name: str = VOCABULARY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece.

    Every row of ``docs`` is packed (repeated rows and null ids too); a null or empty text
    is the single id 0; only documents over ``capacity`` ids are cut; ties of equal pieces
    are interchangeable; extra columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = durable(tokenize(docs, capacity, name), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    groups, _ = pack(histogram, capacity)
    if not groups:
        return pieces.select("*", F.lit(0).cast("long").alias("sequence_id"),
                             F.lit(0).cast("long").alias("offset"))
    shared = spark.sparkContext.broadcast(slots(groups))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = shared.value
        scale = int(t["first"].max()) + 1
        key = t["length"].to_numpy() * scale + t["first"].to_numpy()
        for b in batches:
            rank = b["rank"].to_numpy()
            at = t.iloc[np.searchsorted(
                key, b["length"].to_numpy() * scale + np.minimum(rank, scale - 1), side="right") - 1]
            nth, copies = rank - at["first"].to_numpy(), at["copies"].to_numpy()
            yield b.drop(columns="rank").assign(
                sequence_id=at["sequence"].to_numpy() + nth // copies,
                offset=at["offset"].to_numpy() + nth % copies * b["length"].to_numpy())
    return ranked(pieces, histogram).select(*pieces.columns, "rank").mapInPandas(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
               "sequence_id long, offset long")
