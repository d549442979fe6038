"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint is mapped to the number of set bits in each of its 16 four-bit
segments. The Manhattan distance of two such vectors never exceeds the Hamming distance
of the fingerprints, so every link lies within ``max_bits`` in the embedding: both ends
are put into all grid cells within half that distance, cells are joined, and the Hamming
distance is then checked exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidepool.llm.common import documents, durable
from tidepool.llm.components import connected_components

SEGMENT_BITS = 4
# Cells with more distinct fingerprints than this are linked through shared bit-flip
# neighbours instead of pairs (same links, linear instead of quadratic work).
CROWDED = 64
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of whole lower-cased text over word shingles, repeats counted."""
    words = (text or "").encode().lower().split()       # bytes: only A-Z, ASCII blanks
    if not words:
        return 0
    k = min(shingle, len(words))
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first, last = starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(first), _BLOCK):
        h = np.fromiter((digest(flat[s:e], 42) for s, e in
                         zip(first[i:i + _BLOCK], last[i:i + _BLOCK])), np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    on = counts * 2 > len(first)
    return int(np.packbits(on, bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, th, fp) per row; null or wordless text has fingerprint 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t, shingle) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(fps, pa.int64())],
                ["doc_id", "th", "fp"])
    return documents(docs).mapInArrow(run, "doc_id long, th long, fp long")


def popcounts(fp: Column) -> Column:
    """The embedding as one long: each hex digit is the popcount of that four-bit segment."""
    ones = F.lit(0x1111111111111111)      # sums stay below 5 per digit: no carry, no sign
    return sum((F.shiftrightunsigned(fp, i).bitwiseAND(ones) for i in range(1, SEGMENT_BITS)),
               fp.bitwiseAND(ones))


def _neighbour_cells(code: Column) -> list[Column]:
    out = []
    for s in range(0, 64, SEGMENT_BITS):
        digit = F.shiftrightunsigned(code, s).bitwiseAND(F.lit(15).cast("long"))
        step = F.lit(1 << s).cast("long")
        out += [F.when(digit < SEGMENT_BITS, code + step), F.when(digit > 0, code - step)]
    return out


def _ball(c: Column, radius: int, moves) -> Column:
    """All codes within ``radius`` moves of ``c``."""
    ball = F.array(c)
    for _ in range(radius):
        ball = F.array_distinct(F.flatten(F.transform(
            ball, lambda x: F.array_compact(F.array(x, *moves(x))))))
    return ball


def _flips(c: Column) -> list[Column]:
    one = [1 << i if i < 63 else -(1 << 63) for i in range(64)]
    return [c.bitwiseXOR(F.lit(x).cast("long")) for x in one]


def fingerprint_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are exactly those of
    all links at ``max_bits`` or fewer differing bits.

    Cells of up to ``CROWDED`` fingerprints yield their verified pairs. The fingerprints
    of larger cells are joined through bit-flip neighbours: two of them are within
    ``max_bits`` exactly when one's ball of radius floor(max_bits/2) meets the other's of
    radius ceil(max_bits/2), so each code links its visitors to one owner.
    """
    if max_bits <= 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    radius = (max_bits + 1) // 2
    cells = fps.select("fp", F.explode(_ball(popcounts(F.col("fp")), radius,
                                             _neighbour_cells)).alias("cell"))
    cells = cells.withColumn("n", F.count("*").over(Window.partitionBy("cell"))).where("n > 1")
    cells = durable(cells, "cells")
    small = cells.where(F.col("n") <= CROWDED)
    x, y = small.alias("x"), small.alias("y")
    pairs = x.join(y, (F.col("x.cell") == F.col("y.cell")) & (F.col("x.fp") < F.col("y.fp"))
                   & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= max_bits))
    pairs = pairs.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    crowd = cells.where(F.col("n") > CROWDED).select("fp").distinct()
    guests = crowd.select("fp", F.explode(_ball(F.col("fp"), radius, _flips)).alias("hub"))
    own = max_bits // 2
    guests = guests.withColumn(
        "owner", F.when(F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= own, F.col("fp")))
    hubs = guests.groupBy("hub").agg(F.min("owner").alias("b"), F.count("*").alias("n"))
    hubs = hubs.where("n > 1 AND b IS NOT NULL")
    stars = guests.join(hubs, "hub").where("fp != b").select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(stars).distinct()


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """(doc_id, th, fp, root, component_id) for every row.

    ``root`` is the smallest fingerprint of the group and ``component_id`` the smallest
    doc_id of it. Equal fingerprints are one node, so a group of copies of any size costs
    one row. Null text counts as empty (fingerprint 0, linked like any other); null ids
    never become the component_id unless a group has no other; repeated rows each get
    their row; extra columns are ignored; an empty table gives no rows.
    """
    rows = durable(with_fingerprints(docs, shingle), "fingerprints")
    nodes = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    comp = connected_components(fingerprint_links(nodes.select("fp"), max_bits))
    rooted = nodes.join(comp, nodes["fp"] == comp["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    lead = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    rooted = rooted.join(lead, "root").select(F.col("fp").alias("k"), "root", "component_id")
    return rows.join(rooted, rows["fp"] == rooted["k"], "left").drop("k")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
