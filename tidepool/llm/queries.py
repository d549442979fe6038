"""The operators' queries over the input tables, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import (decontaminate, hard_negatives, language, licenses, line_dedup,
                          packing, paragraphs, phrases, quality_classifier, quality_rules,
                          simhash, suffix_index, toxicity)
from tidepool.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"),
                                       table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_equal", "n_compared")).alias("b")
        ).select("doc_id", "item_id", "b.n_equal", "b.n_compared")


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit_from_labels(docs)).select(
        "doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score",
        "phrase_chars")


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return groups.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"),
                         "component_id")


_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORDS = ("list_filter(string_split_regex(translate(coalesce(text, ''), "
          "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          f"'{_SEPARATORS}'), lambda x: x <> '')")


def _op5_sql() -> str:
    def seed(mask: str, k: int) -> str:
        at = " || ' ' || ".join(f"w[p + {i + 1}]" for i, bit in enumerate(mask) if bit == "1")
        return f"'{k} ' || {at}"
    span = len(decontaminate.MASKS[0])
    masks = ", ".join(seed(m, k) for k, m in enumerate(decontaminate.MASKS))
    def windows(key: str, source: str) -> str:
        return (f"SELECT {key}, p, unnest([{masks}]) AS s FROM (SELECT {key}, w, "
                f"unnest(range(0, len(w) - {span - 1})) AS p FROM {source})")
    return f"""
WITH d AS (SELECT DISTINCT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark),
dw AS ({windows("doc_id", "d")}), bw AS ({windows("item_id", "b")}),
h AS (SELECT doc_id, item_id, dw.p - bw.p AS shift, min(bw.p) AS lo, max(bw.p) + {span} AS hi
      FROM dw JOIN bw USING (s) GROUP BY ALL),
c AS (SELECT h.doc_id, h.item_id, hi - lo AS n_compared, len(b.w) AS n,
             len(list_filter(range(lo, hi), lambda i: b.w[i + 1] = d.w[i + shift + 1])) AS n_equal
      FROM h JOIN d USING (doc_id) JOIN b USING (item_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id
                                   ORDER BY n_equal DESC, n_compared) AS k
      FROM c WHERE n_equal >= least({decontaminate.MIN_WORDS}, n)
               AND n_equal >= {decontaminate.MIN_OVERLAP} * n_compared)
SELECT doc_id, item_id, CAST(n_equal AS BIGINT) AS n_equal, CAST(n_compared AS BIGINT) AS n_compared
FROM r WHERE k = 1"""


ORACLE["op5_benchmark_decontamination"] = _op5_sql()


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "host_failed")


def _op2_sql() -> str:
    low, high = quality_rules.PRIOR_STRENGTH
    rules = quality_rules.RULES
    fails = ", ".join(f"sum(CAST(({c}) AS INT)) AS {r}" for r, c in rules.items())
    prior = ", ".join(f"sum({r}) / sum(n) AS {r}_m, sum({r} * ({r} / n)) / sum(n) - "
                      f"(sum({r}) / sum(n)) ** 2 AS {r}_v" for r in rules)
    weight = {r: f"CASE WHEN {r}_v > 0 THEN least({high}, greatest({low}, "
                 f"{r}_m * (1 - {r}_m) / {r}_v - 1)) ELSE {high} END" for r in rules}
    rates = ", ".join(f"({r} + {r}_m * {w}) / (n + {w})" for r, w in weight.items())
    base = " OR ".join(f"({c})" for c in quality_rules.BASE_RULES.values())
    return f"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS x,
                  list_filter(string_split_regex(coalesce(text, ''), '{quality_rules.BLANKS}'),
                              lambda w: w <> '') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l
           FROM documents),
p AS (SELECT doc_id, p, array_to_string(w[p:p + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM t)),
r AS (SELECT doc_id, count(DISTINCT q) AS n_repeat_words
      FROM (SELECT doc_id, unnest(range(p, p + 5)) AS q
            FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS k FROM p) WHERE k > 1)
      GROUP BY doc_id),
c AS (SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda y: length(y))), 0) AS BIGINT) AS word_chars,
             CAST(length(x) - length(regexp_replace(x, '{quality_rules.SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines
      FROM t LEFT JOIN r USING (doc_id)),
h AS (SELECT source, count(*) AS n, {fails} FROM c WHERE source IS NOT NULL GROUP BY source),
v AS (SELECT source, greatest({rates}) > {quality_rules.HOST_LIMIT} AS failed
      FROM h, (SELECT {prior} FROM h))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({base}) AS base_failed,
       NOT ({base}) AND NOT coalesce(failed, false) AS kept, n_lines, coalesce(failed, false) AS host_failed
FROM c LEFT JOIN v USING (source)"""


ORACLE["op2_quality_rules"] = _op2_sql()


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def _op8_sql() -> str:
    def words(phrase: str) -> str:
        return "[" + ", ".join(f"'{x}'" for x in phrase.split()) + "]"
    rows = []
    for k, (label, notice, key) in enumerate(licenses.TEMPLATES):
        at = len(notice[:f" {notice} ".index(f" {key} ")].split())
        rows.append(f"({k}, '{label}', {words(notice)}, {at}, {at + len(key.split())})")
    vocabulary = words(" ".join(licenses.VOCABULARY))
    base = ", ".join(f"('{label}', {words(p)})" for p, label in licenses.BASE.items())
    total = "list_reduce({}, lambda x, y: x + y)".format
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
q AS (SELECT rid, w, unnest(range(len(w))) AS p FROM t),
h AS (SELECT rid, p, w[p + 1] AS x FROM q WHERE list_contains({vocabulary}, w[p + 1])),
v AS (SELECT x, ln(CAST((SELECT count(*) FROM t) + 1 AS DOUBLE) / (count(DISTINCT h.rid) + 1))
             + CAST(1e-6 AS DOUBLE) AS idf
      FROM (SELECT unnest({vocabulary}) AS x) LEFT JOIN h USING (x) GROUP BY x),
n(tid, label, parts, kf, kt) AS (VALUES {", ".join(rows)}),
u AS (SELECT tid, k, x, idf FROM (SELECT tid, k, parts[k + 1] AS x FROM (
          SELECT tid, parts, unnest(range(len(parts))) AS k FROM n)) JOIN v USING (x)),
ws AS (SELECT tid, list(idf ORDER BY k) AS weights FROM u GROUP BY tid),
rare AS (SELECT tid, x FROM (SELECT tid, x, row_number() OVER (PARTITION BY tid ORDER BY idf DESC, x) AS r
                             FROM (SELECT DISTINCT tid, x, idf FROM u)) WHERE r <= {licenses.POSTED}),
c AS (SELECT DISTINCT rid, tid, h.p - k AS s FROM h JOIN u USING (x) JOIN rare USING (tid, x)),
m AS (SELECT rid, label, weights, kf, kt, list_filter(range(len(parts)), lambda i:
             s + i >= 0 AND w[s + i + 1] = parts[i + 1]) AS placed
      FROM c JOIN t USING (rid) JOIN n USING (tid) JOIN ws USING (tid)),
f AS (SELECT rid, list(DISTINCT label) AS found, max(score) AS best FROM (
          SELECT rid, label, least({total("list_transform(placed, lambda i: weights[i + 1])")}
                                   / {total("weights")}, 1.0) AS score
          FROM m WHERE len(list_filter(placed, lambda i: i >= kf AND i < kt)) = kt - kf)
      WHERE score >= {licenses.MIN_SCORE} GROUP BY rid),
b AS (SELECT rid, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word,
             list(DISTINCT label) AS own
      FROM q, (VALUES {base}) o(label, phrase) WHERE w[p + 1:p + len(phrase)] = phrase GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(own), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(found, [])))), ',')
           AS labels, coalesce(best, 0.0) AS score
FROM t LEFT JOIN b USING (rid) LEFT JOIN f USING (rid)"""


ORACLE["op8_license_scan"] = _op8_sql()


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", "removed_lines",
        F.xxhash64("text").alias("kept_text_hash"))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_paragraphs(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "n", "cluster_id", "first_doc_id", "first_start", "removed")


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.fit_from_labels(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.predict(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_from_labels(docs, table(spark, sf_dir, "labels"))
    return toxicity.predict(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.participants(table(spark, sf_dir, "embeddings")).withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
        .otherwise(F.col("label")))
    return hard_negatives.hard_negatives(rows, rows.where("vec_id % 50 = 0"))


ORACLE["op11_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
             CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
      FROM v a JOIN v r ON len(a.q) = len(r.q) AND a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id
                                ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s USING (anchor_id)
      WHERE NOT same AND 50 * positive_score <= 100 * s.score
        AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
       negative_score
FROM n WHERE rank <= 3"""


@query
def op12_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_index.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op12_suffix_array_dedup"] = """
WITH d AS (SELECT doc_id, row_number() OVER () AS i, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT i, p, md5(b[p + 1:p + 400]) AS h
      FROM (SELECT i, b, unnest(range(0, octet_length(b) - 399)) AS p FROM d)),
r AS (SELECT i, p FROM w QUALIFY count(*) OVER (PARTITION BY h) > 1),
s AS (SELECT i, p, CASE WHEN p - lag(p) OVER (PARTITION BY i ORDER BY p) <= 400 THEN 0
                        ELSE 1 END AS new FROM r),
g AS (SELECT i, p, sum(new) OVER (PARTITION BY i ORDER BY p) AS run FROM s),
c AS (SELECT i, run, min(p) AS a, max(p) + 400 AS z FROM g GROUP BY i, run),
k AS (SELECT i, a, z, coalesce(lag(z) OVER (PARTITION BY i ORDER BY a), 0) AS before FROM c),
x AS (SELECT i, count(*) AS n_spans, CAST(sum(z - a) AS BIGINT) AS n_removed,
             string_agg(hex(d.b[before + 1:a]), '' ORDER BY a)
               || hex(any_value(d.b)[max(z) + 1:]) AS kept
      FROM k JOIN d USING (i) GROUP BY i)
SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(coalesce(unhex(kept), b)) AS kept_sha256
FROM d LEFT JOIN x USING (i)"""


@query
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=100, top=2000)


_SIZES = range(1, phrases.LONGEST + 1)
_GRAMS = " UNION ALL ".join(
    f"SELECT lang, list_slice(w, i, i + {k - 1}) AS g FROM (SELECT lang, w, "
    f"unnest(range(1, len(w) - {k - 2})) AS i FROM p)" for k in _SIZES)
_INNER = " UNION ALL ".join(
    f"SELECT lang, list_slice(g, {i}, {i + k - 1}) AS g, a FROM c WHERE len(g) = {m}"
    for m in _SIZES for k in range(2, m) for i in range(1, m - k + 2))
ORACLE["op13_phrase_collocations"] = f"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
           FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[ \x09]+'), lambda x: x <> '') AS w
      FROM t),
f AS (SELECT lang, g, count(*) AS f FROM ({_GRAMS}) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
c AS (SELECT lang, g, f AS a FROM f WHERE len(g) > 1 AND f >= 100),
i AS (SELECT DISTINCT lang, g, a FROM ({_INNER})),
k AS (SELECT c.*, unnest(range(1, len(c.g))) AS k FROM c
      WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.lang = c.lang AND i.g = c.g AND i.a >= c.a)),
s AS (SELECT k.lang, k.g, a, k, n, x.f AS l, y.f AS r,
             CAST(1000::HUGEINT * a * n // (x.f::HUGEINT * y.f) AS BIGINT) AS score
      FROM k JOIN n USING (lang)
           JOIN f x ON x.lang = k.lang AND x.g = list_slice(k.g, 1, k.k)
           JOIN f y ON y.lang = k.lang AND y.g = list_slice(k.g, k.k + 1, len(k.g))),
b AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM s
      QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1)
SELECT lang, row_number() OVER w AS rank, phrase, a, l, r, n, score FROM b
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY rank <= 2000"""
