"""Dictionary phrases of several words in texts: a trie matched by joins on prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.session import DEFAULT_BROADCAST_ROWS, bounded_broadcast


def words(text: Column, separator: str) -> Column:
    """Lower-cased words of a text (null: none)."""
    split = F.filter(F.split(F.lower(text), separator), lambda w: w != "")
    return F.coalesce(split, F.array().cast("array<string>"))


def trie(phrases: DataFrame, phrase: str, longest: int) -> DataFrame:
    """(depth, prefix, ends): every prefix of phrases (word arrays) of 1 to ``longest``
    words, space-joined, and whether a phrase ends there. Longer and null ones are left out."""
    p = phrases.select(F.col(phrase).alias("_p")).where(F.size("_p").between(1, longest))
    nodes = p.select("_p", F.explode(F.sequence(F.lit(1), F.size("_p"))).alias("depth"))
    return nodes.select(
        "depth", F.array_join(F.slice("_p", F.lit(1), F.col("depth")), " ").alias("prefix"),
        (F.col("depth") == F.size("_p")).alias("_e")).groupBy("depth", "prefix").agg(
            F.max("_e").alias("ends"))


def longest_matches(docs: DataFrame, key: str, text_words: Column, phrases: DataFrame,
                    phrase: str, longest: int = 4,
                    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """(key, place, phrase, n_words): at every word of every text the longest phrase that
    starts there; ``place`` counts words from 0, and places may overlap.

    The first level is an inner join that drops every word no phrase starts with; deeper
    levels only extend what is left. While the trie has ``max_broadcast_rows`` prefixes at
    most, no word of a text is shuffled; beyond that the joins shuffle by prefix.
    """
    nodes = bounded_broadcast(trie(phrases, phrase, longest), max_broadcast_rows)
    rows = docs.select(F.col(key), text_words.alias("_w")).where(F.size("_w") > 0)
    windows = F.transform(F.sequence(F.lit(1), F.size("_w")),
                          lambda i: F.slice("_w", i, F.lit(longest)))
    rows = rows.select(key, F.posexplode(windows).alias("place", "_g"))
    best = F.lit(None).cast("int")
    for depth in range(1, longest + 1):
        level = nodes.where(F.col("depth") == depth).select(
            F.col("prefix").alias(f"_p{depth}"), F.col("ends").alias(f"_e{depth}"))
        start = F.when(F.size("_g") >= depth, F.array_join(F.slice("_g", 1, depth), " "))
        rows = rows.join(level, start == level[f"_p{depth}"], "inner" if depth == 1 else "left")
        best = F.when(F.col(f"_e{depth}"), F.lit(depth)).otherwise(best)
    found = rows.withColumn("n_words", best).where("n_words IS NOT NULL")
    return found.select(key, "place", F.array_join(
        F.slice("_g", F.lit(1), F.col("n_words")), " ").alias("phrase"), "n_words")
