"""Substring dedup: MinHash banding over content-defined paragraphs.

A paragraph ends where the hash of a word pair is the smallest within ``RADIUS`` pairs on
either side, so a passage that repeats anywhere, also in the middle of a line, is cut alike
in every document. Paragraphs get MinHash signatures over five-word shingles; paragraphs
that collide in a band are verified by exact Jaccard similarity, and connected components
of verified pairs are the clusters. The first place of a cluster stays, the others go.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidepool.llm.common import ascii_lower, discard, documents, durable, text_blocks
from tidepool.llm.components import connected_components
from tidepool.llm.quality_rules import BLANKS, let

RADIUS = 6              # paragraphs have RADIUS + 1 words or more, 2 * RADIUS + 1 on average
SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.98           # of pairs at the threshold, by banding
CROWDED = 64            # distinct paragraphs in a band bucket beyond which it is split

_U = np.uint64
_MIX = (_U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB))
_BASE = _U(0x100000001B3)


def tune_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = 64) -> tuple[int, int]:
    """(bands, rows): two rows or more per band, as few bands as reach the recall at the
    threshold."""
    for bands in range(1, most + 1):
        if 1 - (1 - threshold ** 2) ** bands >= recall:
            return bands, 2
    raise ValueError(f"recall {recall} needs more than {most} bands")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _MIX[1]
    x = (x ^ (x >> _U(27))) * _MIX[2]
    return x ^ (x >> _U(31))


def _cuts(pair: np.ndarray, radius: int) -> np.ndarray:
    """Positions whose value is below the ``radius`` before and not above those after."""
    pad = np.full(radius, np.iinfo(np.uint64).max, _U)
    wide = np.concatenate((pad, pair, pad))
    low = np.ones(len(pair), bool)
    for k in range(1, radius + 1):
        low &= pair < wide[radius - k:radius - k + len(pair)]
        low &= pair <= wide[radius + k:radius + k + len(pair)]
    return low


def segment(texts: list[str], bands: int, rows: int, radius: int = RADIUS):
    """Paragraphs of whole texts: (text index, start word, words, content hash, band keys).

    All texts of a block are handled in one array, with neutral gaps between them.
    """
    with np.errstate(over="ignore"):
        gap, chunks, origin, sizes = radius + SHINGLE, [], [], []
        filler = np.zeros(gap, _U)
        for t in texts:
            words = t.encode().lower().split()
            chunks += [np.fromiter(map(xxhash.xxh64_intdigest, words), _U, len(words)), filler]
            sizes.append(len(words))
        w = np.concatenate(chunks) if chunks else np.zeros(0, _U)
        sizes = np.array(sizes, np.int64)
        begin = np.cumsum(sizes + gap) - (sizes + gap)
        real = np.zeros(len(w), bool)
        owner = np.repeat(np.arange(len(texts)), sizes)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        real[begin[owner] + within] = True
        pair = _mixed(w[:-1] * _MIX[0] + w[1:]) if len(w) > 1 else np.zeros(0, _U)
        top = np.iinfo(np.uint64).max
        pair = np.where(real[:-1] & real[1:], pair, top) if len(w) > 1 else pair
        cut = _cuts(pair, radius) & (pair != top)
        starts = np.unique(np.concatenate((begin[sizes > 0], np.flatnonzero(cut) + 1)))
        doc = np.searchsorted(begin, starts, side="right") - 1
        stop = np.minimum(np.append(starts[1:], len(w)), begin[doc] + sizes[doc])
        n = stop - starts
        keep = n > radius
        starts, stop, n, doc = starts[keep], stop[keep], n[keep], doc[keep]
        if not len(starts):
            empty = np.zeros(0, np.int64)
            return empty, empty, empty, empty, np.zeros((bands, 0), np.int64)
        edges = np.stack((starts, stop), axis=1).ravel()
        place = np.arange(len(w)) - np.repeat(
            np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [len(w)]))))
        content = np.add.reduceat(_mixed(w + place.astype(_U) * _MIX[0]), edges)[::2]
        shingle = np.zeros(len(w), _U)
        for k in range(SHINGLE):
            part = np.zeros(len(w), _U)
            part[:len(w) - k] = w[k:]
            shingle = shingle * _BASE + part
        shingle = _mixed(shingle * _MIX[0])
        inside = np.zeros(len(w) + 1, np.int32)
        np.add.at(inside, starts, 1)
        np.add.at(inside, stop - SHINGLE + 1, -1)
        inside = np.cumsum(inside[:-1]) > 0
        keys = np.zeros((bands, len(starts)), _U)
        for band in range(bands):
            key = np.full(len(starts), _U(band + 1), _U)
            for row in range(rows):
                seed = _mixed(np.array([band * rows + row + 1], _U) * _MIX[0])[0]
                v = np.where(inside, _mixed(shingle ^ seed), top)
                key = _mixed(key * _BASE + np.minimum.reduceat(v, edges)[::2])
            keys[band] = key
        return doc, starts - begin[doc], n, content.view(np.int64), keys.view(np.int64)


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, th, start, n, h, keys) of every paragraph; ``start`` counts words from 0."""
    bands, rows = tune_bands()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ths, base = b.column("doc_id"), b.column("th"), 0
            for texts in text_blocks(b.column("text")):
                doc, start, n, h, keys = segment(texts, bands, rows)
                at = pa.array(doc + base)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), ths.take(at), pa.array(start.astype(np.int32)),
                     pa.array(n.astype(np.int32)), pa.array(h), *map(pa.array, keys)],
                    ["doc_id", "th", "start", "n", "h", *[f"k{i}" for i in range(bands)]])
                base += len(texts)

    kinds = ", ".join(f"k{i} long" for i in range(bands))
    return documents(docs).mapInArrow(
        run, "doc_id long, th long, start int, n int, h long, " + kinds)


def shingle_sets(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(h, s): the distinct shingle hashes of one paragraph per ``h``; ``places`` has
    (h, place) with place = (doc_id, th, start, n). Each text is split once."""
    per_doc = places.groupBy(F.col("place.doc_id").alias("d"), F.col("place.th").alias("t")).agg(
        F.collect_list(F.struct("h", "place.start", "place.n")).alias("parts"))
    rows = documents(docs).dropDuplicates(["doc_id", "th"])
    met = rows.join(per_doc, rows["doc_id"].eqNullSafe(F.col("d")) & (rows["th"] == F.col("t")))
    words = F.filter(F.split(ascii_lower(F.col("text")), BLANKS), lambda w: w != "")
    sets = let(words, lambda w: F.transform("parts", lambda p: F.struct(
        p["h"].alias("h"),
        F.array_distinct(F.transform(
            F.sequence(p["start"] + 1, p["start"] + p["n"] - SHINGLE + 1),
            lambda i: F.xxhash64(F.slice(w, i, F.lit(SHINGLE))))).alias("s"))))
    return met.select(F.inline(sets))


def _similar(x: str, y: str):
    """Exact Jaccard similarity of two shingle sets reaches the threshold."""
    both = F.size(F.array_intersect(x, y))
    return both >= THRESHOLD * (F.size(x) + F.size(y) - both)


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The verified ones of pairs (a, b)."""
    x = sets.select(F.col("h").alias("a"), F.col("s").alias("sa"))
    y = sets.select(F.col("h").alias("b"), F.col("s").alias("sb"))
    return pairs.join(x, "a").join(y, "b").where(_similar("sa", "sb")).select("a", "b")


def _crowd_links(crowd: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among the members (key, h) of crowded buckets without pairing whole buckets.

    Every member is verified against its bucket's hub (the smallest hash); members that
    these links connect need no links among themselves. All other pairs go through a prefix
    filter: two sets at the threshold share one of their first few shingles when shingles
    are ordered by frequency, rarest first. Of two connected families only pairs across
    them are made.
    """
    hubs = crowd.groupBy("key").agg(F.min("h").alias("b"))
    star = crowd.join(hubs, "key").where("h != b").select(F.col("h").alias("a"), "b").distinct()
    star = durable(_links(star, sets), "hub-links")
    family = connected_components(star).select(F.col("node").alias("h"), F.col("root").alias("g"))
    own = sets.join(crowd.select("h").distinct(), "h", "left_semi").join(family, "h", "left")
    each = own.select("h", "g", F.size("s").alias("m"), F.explode("s").alias("x"))
    df = each.groupBy("x").agg(F.count("*").alias("df"))
    order = Window.partitionBy("h").orderBy("df", "x")
    prefix = (each.join(df, "x").withColumn("k", F.row_number().over(order))
              .where(F.col("k") <= F.col("m") - F.ceil(THRESHOLD * F.col("m")) + 1))
    prefix = durable(prefix.select("h", "g", "x").join(own.select("h", "s"), "h"), "prefixes")
    p, q = prefix.alias("p"), prefix.alias("q")
    rest = p.join(q, (F.col("p.x") == F.col("q.x")) & (F.col("p.h") != F.col("q.h"))
                  & F.col("p.g").isNull() & (F.col("q.g").isNotNull() | (F.col("p.h") < F.col("q.h")))
                  & _similar("p.s", "q.s"))
    met = prefix.where("g IS NOT NULL").select("x", "g").distinct()
    met = met.join(met.select("x", F.col("g").alias("other")), "x").where("g < other")
    across = prefix.join(met, ["x", "g"]).alias("p").join(
        q, (F.col("p.x") == F.col("q.x")) & (F.col("p.other") == F.col("q.g"))
        & _similar("p.s", "q.s"))
    ends = [F.col("p.h").alias("a"), F.col("q.h").alias("b")]
    return star.unionByName(rest.select(*ends).unionByName(across.select(*ends)).distinct())


def buckets(parts: DataFrame) -> list[DataFrame]:
    """(h, key, size) of every band bucket with two or more different paragraphs, a written
    table per band.

    Most keys occur once. Bands are taken one after the other, so that the disk holds the
    shuffles of a single band, and ``durable`` clears those before the next one starts.
    Equal paragraphs are one row before their key is shuffled.
    """
    found = []
    for band in (c for c in parts.columns if c.startswith("k")):
        once = parts.groupBy("h").agg(F.first(band).alias("key"))
        sized = once.withColumn("size", F.count("*").over(Window.partitionBy("key")))
        found.append(durable(sized.where("size > 1"), "buckets"))
    return found


def paragraph_links(docs: DataFrame, parts: DataFrame) -> DataFrame:
    """Edges (a, b) between content hashes of different paragraphs at the threshold."""
    found = buckets(parts)
    members = reduce(DataFrame.unionByName, found)
    place = F.min(F.struct("doc_id", "th", "start", "n")).alias("place")
    wanted = members.select(F.col("h").alias("w")).distinct()
    places = parts.join(wanted, parts["h"] == wanted["w"], "left_semi").groupBy("h").agg(place)
    sets = durable(shingle_sets(docs, places), "shingle-sets")
    small = members.where(F.col("size") <= CROWDED)
    x, y = small.alias("x"), small.alias("y")
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.h") < F.col("y.h"))).select(
        F.col("x.h").alias("a"), F.col("y.h").alias("b")).distinct()
    links = _links(pairs, sets)
    crowd = members.where(F.col("size") > CROWDED).select("key", "h")
    if not crowd.isEmpty():
        links = links.unionByName(_crowd_links(crowd, sets))
    links = durable(links, "links")
    discard(sets, *found)
    return links


def repeated_paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, th, start, n, cluster_id, first_doc_id, first_start, removed): every place
    of every paragraph whose cluster reaches at least two documents.

    ``start`` and ``n`` count words of the whole lower-cased text. ``removed`` is false for
    the first place (order: doc_id, null first, text hash, start) and true for all others;
    ``cluster_id`` is a hash. Paragraphs shorter than ``RADIUS + 1`` words (only possible at
    a text's ends) are never compared; repeats within one document alone are left. Null and
    empty texts have no paragraphs; repeated rows are one document; extra columns are
    ignored; empty tables give no rows.
    """
    parts = durable(paragraphs(docs), "paragraphs")
    comp = connected_components(paragraph_links(docs, parts))
    doc = F.xxhash64("doc_id", "th")
    spread = parts.groupBy("h").agg(F.min(doc).alias("low"), F.max(doc).alias("high"))
    spread = spread.join(comp, spread["h"] == comp["node"], "left").where(
        "low != high OR root IS NOT NULL").select(
            "h", F.coalesce("root", "h").alias("cluster_id"), "low", "high")
    spread = durable(spread, "clusters")
    wide = spread.groupBy("cluster_id").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    wide = wide.where("low != high").select(F.col("cluster_id").alias("c"))
    spread = spread.join(wide, spread["cluster_id"] == wide["c"], "left_semi").select(
        F.col("h").alias("g"), "cluster_id")
    found = parts.join(spread, parts["h"] == spread["g"]).select(
        "doc_id", "th", "start", "n", "cluster_id").distinct()
    found = durable(found, "repeats")
    first = found.groupBy(F.col("cluster_id").alias("c")).agg(
        F.min(F.struct("doc_id", "th", "start")).alias("first"))
    out = found.join(first, found["cluster_id"] == first["c"])
    return out.select("doc_id", "th", "start", "n", "cluster_id",
                      F.col("first.doc_id").alias("first_doc_id"),
                      F.col("first.start").alias("first_start"),
                      (F.struct("doc_id", "th", "start") != F.col("first")).alias("removed"))
