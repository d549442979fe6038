"""Benchmark decontamination by spaced-seed hashing.

A seed is a window of ``SPAN`` words of which a fixed mask selects some; the others may
differ. Windows of documents and benchmark items with equal hashes under a mask are hits;
the two texts are compared word by word along the whole diagonal of a hit, so a passage
with substituted words is still found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import ascii_lower, documents, durable
from tidepool.llm.quality_rules import let

# Fixed masks (1: the word counts); each selects 8 or 9 of 12 words.
MASKS = ("111011010111", "110110111011", "101111101101")
SHORT_MASKS = ("11111",)    # for items shorter than the masks above
MIN_WORDS = 13              # equal words a leak needs (short items: MIN_OVERLAP of theirs)
MIN_OVERLAP = 0.75          # share of equal words in the stretch that leaks
BLOCK_SEEDS = 1_000_000     # benchmark seeds broadcast at a time, 40 bytes each

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and non-ASCII characters (null: none)."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _SEPARATORS),
                    lambda w: w != "")


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _span(mask: str, n: Column) -> Column:
    return F.when(n >= len(mask), F.sequence(F.lit(0), n - len(mask))).otherwise(
        F.array().cast("array<int>"))


def seeds(rows: DataFrame, w: str, keep: list[str], masks: tuple[str, ...]) -> DataFrame:
    """Columns ``keep`` plus (pos, seed) for every window of word-hash array ``w`` and
    every mask. The window's words are read by position right after the explode, so the
    hashes are computed in generated code."""
    at = rows.select(*keep, w, F.explode(_span(masks[0], F.size(w))).alias("pos"))
    hashes = [F.xxhash64(F.lit(k), *[F.get(w, F.col("pos") + i)
                                     for i, bit in enumerate(mask) if bit == "1"])
              for k, mask in enumerate(masks)]
    return at.select(*keep, "pos", F.explode(F.array(*hashes)).alias("seed"))


def _hits(docs: DataFrame, items: DataFrame, masks: tuple[str, ...]) -> list[DataFrame]:
    """(doc_id, th, item, shift) per diagonal with a hit, one frame for each
    block of at most ``BLOCK_SEEDS`` benchmark seeds. Only such a block is broadcast."""
    index = durable(seeds(items, "w", ["item"], masks).select(
        "item", F.col("pos").alias("at"), F.col("seed").alias("key")), "benchmark-seeds")
    n = index.count()
    blocks = -(-n // BLOCK_SEEDS)
    probe = seeds(docs.select("doc_id", "th", word_hashes(F.col("text")).alias("w")), "w",
                  ["doc_id", "th"], masks)
    out = []
    for k in range(blocks):
        block = index if blocks == 1 else index.where(
            F.pmod(F.xxhash64("key"), F.lit(blocks)) == k)
        met = probe.join(F.broadcast(block), probe["seed"] == block["key"])
        out.append(met.select("doc_id", "th", "item", (F.col("pos") - F.col("at")).alias("shift"))
                   .distinct())
    return out


def _stretch(equal: Column) -> Column:
    """(n_equal, less) of the stretch with the most equal words, ``MIN_OVERLAP`` of its words
    or more, then the shortest; ``equal`` holds the sorted positions of equal words and
    ``less`` is the negative length. Such a stretch starts where ``f``, the words equal so
    far less their due, is lower than anywhere before."""
    def longest(q: Column, f: Column) -> Column:
        last = F.size(q) - 1
        starts = F.filter(F.sequence(F.lit(0), last), lambda a: (a == 0) | (
            F.get(f, a) < F.array_min(F.slice(f, 1, a))))
        return F.array_max(F.transform(starts, lambda a: let(
            F.array_max(F.filter(F.sequence(a, last),
                                 lambda b: F.get(f, b) >= F.get(f, a) + (MIN_OVERLAP - 1))),
            lambda b: F.struct((b - a + 1).cast("long").alias("n_equal"),
                               (F.get(q, a) - F.get(q, b) - 1).cast("long").alias("less")))))
    return F.when(F.size(equal) > 0, let(
        F.transform(equal, lambda x, k: k - x * F.lit(MIN_OVERLAP)), lambda f: longest(equal, f)))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, th, item_id, n_equal, n_compared), one row per document and benchmark item
    it leaks.

    Per diagonal the stretch with the most equal words counts, among those of which
    ``MIN_OVERLAP`` are equal; a leak has at least ``MIN_WORDS`` equal words (``MIN_OVERLAP``
    of a shorter item's); the diagonal with the most equal words is reported, then the
    shorter stretch. Substituted words may leave no seed whole: the README has the recall.
    Items of fewer
    than twelve words must occur whole with every word equal; under five words they are no
    evidence and never match. Null or empty texts match nothing, ids may be null, repeated
    rows of a table count once, extra columns are ignored, empty tables give no rows.
    """
    docs = documents(docs)
    items = (benchmark.select("item_id", word_hashes(F.col("text").cast("string")).alias("w"))
             .distinct().withColumn("item", F.xxhash64("item_id", "w")))
    items = durable(items, "benchmark-words")
    long_n, short_n = len(MASKS[0]), len(SHORT_MASKS[0])
    hits = _hits(docs, items.where(F.size("w") >= long_n), MASKS)
    small = items.where((F.size("w") < long_n) & (F.size("w") >= short_n))
    if not small.isEmpty():
        hits += _hits(docs, small, SHORT_MASKS)
    if not hits:
        hits = [docs.limit(0).select(
            "doc_id", "th", F.lit(0).cast("long").alias("item"), F.lit(0).alias("shift"))]
    found = hits[0]
    for h in hits[1:]:
        found = found.unionByName(h)
    found = durable(found.distinct(), "seed-hits")
    k = found.select(F.col("doc_id").alias("d"), F.col("th").alias("t"), "item", "shift")
    texts = docs.join(k.select("d", "t").distinct(),
                      docs["doc_id"].eqNullSafe(F.col("d")) & (docs["th"] == F.col("t")), "left_semi")
    texts = texts.dropDuplicates(["doc_id", "th"]).select(
        "doc_id", "th", word_hashes(F.col("text")).alias("dw"))
    met = (k.join(texts, F.col("d").eqNullSafe(texts["doc_id"]) & (F.col("t") == texts["th"]))
           .join(items, "item"))
    n = F.size("w")
    equal = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(
        F.get("w", i) == F.when(i + F.col("shift") >= 0, F.get("dw", i + F.col("shift"))),
        F.lit(False)))
    met = met.select("doc_id", "th", "item", "item_id", n.alias("n"),
                     let(equal, lambda q: F.when(n >= long_n, _stretch(q)).otherwise(F.struct(
                         F.size(q).cast("long").alias("n_equal"),
                         (-n).cast("long").alias("less")))).alias("s"))
    met = met.select("doc_id", "th", "item", "item_id", "n", "s.n_equal", (-F.col("s.less")).alias("n_compared"))
    leak = F.when(F.col("n") >= long_n,
                  F.col("n_equal") >= F.least(F.lit(MIN_WORDS), F.ceil(MIN_OVERLAP * F.col("n")))
                  ).otherwise(F.col("n_equal") == F.col("n"))
    best = F.max(F.struct("n_equal", (-F.col("n_compared")).alias("less"))).alias("b")
    return (met.where(leak).groupBy("doc_id", "th", "item_id").agg(best)
            .select("doc_id", "th", "item_id", F.col("b.n_equal").alias("n_equal"),
                    (-F.col("b.less")).alias("n_compared")))
