"""License scan with a positional rare-token index, in DataFrame functions only.

Every template posts its rarest words (by inverse document frequency over all documents)
with their positions. A file's words among them are looked up, a posting fixes where the
template would have to start, the other template words are intersected at those relative
positions, and the template's mandatory key phrase must stand there whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import durable
from tidepool.llm.decontaminate import words
from tidepool.llm.quality_rules import let

# Base phrases and their labels (fixed values).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Templates (fixed values): label, notice, mandatory key phrase within the notice.
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy",
     "permission is hereby granted free of charge"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification",
     "redistribution and use in source and binary forms"),
    ("gpl", "general public license", "general public license"),
    ("gpl-3.0", "licensed under the gnu general public license version 3",
     "general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2",
     "general public license version 2"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("mpl-2.0", "mozilla public license version 2 0", "mozilla public license"),
    ("cc-by", "cc by", "cc by"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc0", "released into the public domain under cc0", "cc0"),
    ("public-domain", "released into the public domain", "public domain"),
    ("reserved", "all rights reserved", "all rights reserved"),
)
POSTED = 3              # rarest words a template posts
MIN_SCORE = 0.5         # share of the template's IDF weight that must be in place
_LONGEST = max(len(t.split()) for _, t, _ in TEMPLATES)
VOCABULARY = sorted({w for _, t, _ in TEMPLATES for w in t.split()})


def _hits(w: Column) -> Column:
    """(pos, word) of the vocabulary's words, by position."""
    return F.filter(F.transform(w, lambda x, i: F.struct(i.alias("pos"), x.alias("word"))),
                    lambda h: h["word"].isin(VOCABULARY))


def _places(h: Column, phrase: str) -> Column:
    """Starts of a phrase: its words are neighbours in ``h`` at consecutive positions."""
    parts = phrase.split()

    def whole(j: Column) -> Column:
        p = F.get(h, j)["pos"]
        ok = [F.coalesce((F.get(h, j + k)["word"] == w) & (F.get(h, j + k)["pos"] == p + k),
                         F.lit(False)) for k, w in enumerate(parts)]
        out = ok[0]
        for x in ok[1:]:
            out = out & x
        return out

    at = F.filter(F.sequence(F.lit(0), F.size(h) - 1), whole)
    return F.when(F.size(h) == 0, F.array().cast("array<int>")).otherwise(
        F.transform(at, lambda j: F.get(h, j)["pos"]))


def file_words(docs: DataFrame) -> DataFrame:
    """(doc_id, th, n_words, hits, base): ``base`` holds (label, starts) per base phrase."""
    text = F.col("text").cast("string")
    found = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                                _hits(w).alias("hits")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("th"), found.alias("f"))
    base = let(F.col("f.hits"), lambda h: F.array(*[
        F.struct(F.lit(label).alias("label"), _places(h, phrase).alias("starts"))
        for phrase, label in BASE.items()]))
    return rows.select("doc_id", "th", "f.n_words", "f.hits", base.alias("base"))


def word_weights(files: DataFrame) -> dict[str, float]:
    """IDF of each vocabulary word (at most ``len(VOCABULARY)`` rows reach the driver)."""
    n = files.count()
    distinct = F.array_distinct(F.transform("hits", lambda h: h["word"]))
    seen = {r["word"]: r["count"] for r in files.select(
        F.explode(distinct).alias("word")).groupBy("word").count().collect()}
    return {w: math.log((n + 1) / (seen.get(w, 0) + 1)) + 1e-6 for w in VOCABULARY}


def _index(spark: SparkSession, idf: dict[str, float]) -> DataFrame:
    """One row per posting: word, its position, and the template (a fixed, small table)."""
    rows = []
    for label, notice, key in TEMPLATES:
        parts, key_parts = notice.split(), key.split()
        at = next(i for i in range(len(parts)) if parts[i:i + len(key_parts)] == key_parts)
        weights = [idf[w] for w in parts]
        rare = sorted(set(parts), key=lambda w: (-idf[w], w))[:POSTED]
        for i, w in enumerate(parts):
            if w in rare:
                rows.append(F.struct(
                    F.lit(w).alias("posted"), F.lit(i).alias("at"), F.lit(label).alias("label"),
                    F.array(*map(F.lit, parts)).alias("notice"),
                    F.array(*map(F.lit, weights)).alias("weights"),
                    F.lit(at).alias("key_from"), F.lit(at + len(key_parts)).alias("key_to")))
    return spark.range(1).select(F.inline(F.array(*rows)))


def template_matches(files: DataFrame, idf: dict[str, float]) -> DataFrame:
    """(doc_id, th, label, score) of every template found in a file."""
    index = _index(files.sparkSession, idf)
    posted = sorted({w for _, t, _ in TEMPLATES
                     for w in sorted(set(t.split()), key=lambda x: (-idf[x], x))[:POSTED]})
    rare = files.where(F.exists("hits", lambda h: h["word"].isin(posted)))
    own = F.filter(F.transform("hits", lambda h, j: F.struct(
        h["pos"].alias("pos"), h["word"].alias("word"), j.alias("j"))),
        lambda h: h["word"].isin(posted))
    around = F.transform(own, lambda h: F.struct(
        h["pos"].alias("pos"), h["word"].alias("word"),
        F.slice("hits", F.greatest(h["j"] + 1 - _LONGEST, F.lit(1)), F.lit(2 * _LONGEST)).alias("near")))
    hit = rare.select("doc_id", "th", F.explode(around).alias("h"))
    met = hit.join(F.broadcast(index), F.col("h.word") == F.col("posted"))
    met = met.withColumn("from", F.col("h.pos") - F.col("at"))
    placed = F.filter(F.sequence(F.lit(0), F.size("notice") - 1), lambda i: F.exists(
        "h.near", lambda x: (x["pos"] == F.col("from") + i) & (x["word"] == F.get("notice", i))))
    met = met.withColumn("placed", placed)
    score = (F.aggregate("placed", F.lit(0.0), lambda a, i: a + F.get("weights", i))
             / F.aggregate("weights", F.lit(0.0), lambda a, x: a + x))
    key = F.size(F.filter("placed", lambda i: (i >= F.col("key_from")) & (i < F.col("key_to"))))
    return (met.where(key == F.col("key_to") - F.col("key_from"))
            .select("doc_id", "th", "label", F.least(score, F.lit(1.0)).alias("score"))
            .where(F.col("score") >= MIN_SCORE)
            .groupBy("doc_id", "th", "label").agg(F.max("score").alias("score")))


def license_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row.

    ``n_base`` counts all places of base phrases, ``first_word``/``last_word`` are their
    smallest and largest start (null without any). ``score`` is the best template's share
    of IDF weight in place, 0 without a label. Null text counts as empty; null ids and
    repeated rows are answered like others; extra columns are ignored; an empty table gives
    no rows.
    """
    files = durable(file_words(docs), "file-words")
    matches = template_matches(files, word_weights(files)).groupBy("doc_id", "th").agg(
        F.collect_set("label").alias("found"), F.max("score").alias("best"))
    m = matches.withColumnsRenamed({"doc_id": "d", "th": "t"})
    starts = F.flatten(F.transform("base", lambda b: b["starts"]))
    base_labels = F.transform(F.filter("base", lambda b: F.size(b["starts"]) > 0),
                              lambda b: b["label"])
    rows = files.select("doc_id", "th", "n_words", starts.alias("starts"),
                        base_labels.alias("own"))
    out = rows.join(m, rows["doc_id"].eqNullSafe(m["d"]) & (rows["th"] == m["t"]), "left")
    none = F.array().cast("array<string>")
    return out.select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.array_join(F.array_sort("own"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("own", F.coalesce("found", none))), ",").alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"))
