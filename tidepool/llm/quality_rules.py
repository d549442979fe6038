"""Host-level quality rules in DataFrame functions only.

Per document a few counts are taken from the whole text; rule failures are aggregated by
host, failure rates are shrunk with a beta prior estimated from all hosts, and the host
verdict is joined back to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import durable

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
HOST_LIMIT = 0.5                # shrunk failure rate of one rule above which a host fails
PRIOR_STRENGTH = (1.0, 1000.0)  # bounds of the prior's weight in documents

# Rules (fixed values): name -> condition under which a document fails. The first two also
# reject the document itself.
BASE_RULES = {
    "short": "n_words < 10",
    "repetitive": "100 * n_repeat_words > 20 * n_words",
}
RULES = BASE_RULES | {
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
}


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(starts: Column) -> Column:
    """Words covered by windows at these sorted starts."""
    return F.aggregate(
        F.sequence(F.lit(2), F.size(starts)), F.lit(WINDOW),
        lambda n, j: n + F.least(F.lit(WINDOW), F.element_at(starts, j)
                                 - F.element_at(starts, j - 1)))


def _repeated(h: Column) -> Column:
    """Words in windows whose hash occurs twice or more; ``h`` has a hash per window."""
    n = F.size(h)
    order = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

    def starts(s: Column) -> Column:
        def same(j: Column, k: Column) -> Column:
            return F.coalesce(F.get(s, j)["h"] == F.get(s, k)["h"], F.lit(False))
        twin = F.filter(F.sequence(F.lit(0), n - 1), lambda j: same(j, j - 1) | same(j, j + 1))
        return F.array_sort(F.transform(twin, lambda j: F.get(s, j)["p"]))

    covered = let(let(order, starts), lambda q: F.when(F.size(q) == 1, WINDOW).otherwise(_covered(q)))
    return F.when(F.size(F.array_distinct(h)) == n, 0).otherwise(covered)


def _word_counts(w: Column) -> Column:
    n = F.size(w)
    hashes = F.transform(F.sequence(F.lit(1), n - WINDOW + 1),
                         lambda i: F.xxhash64(F.slice(w, i, F.lit(WINDOW))))
    return F.struct(
        n.cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)).alias("word_chars"),
        F.when(n < WINDOW, 0).otherwise(let(hashes, _repeated)).cast("long").alias("n_repeat_words"))


def document_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, th, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines) per row; null text counts as empty. Windows are compared by 64-bit hash."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = let(words, _word_counts)
    line_counts = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    host = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), host.alias("host"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        counts.alias("w"), line_counts.alias("l")).select(
            "doc_id", "host", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines",
            "w.n_repeat_words", "l.n_lines")


def host_verdicts(counts: DataFrame) -> DataFrame:
    """(host, n_docs, <rule>_rate..., failed) per host.

    The prior of a rule is a beta distribution with the pooled rate as mean and, by the
    method of moments, the weight that explains the spread of the hosts' rates.
    """
    fails = [F.sum(F.expr(cond).cast("long")).alias(rule) for rule, cond in RULES.items()]
    hosts = durable(counts.where("host IS NOT NULL").groupBy("host").agg(
        F.count("*").alias("n_docs"), *fails), "hosts")
    moments = [m for rule in RULES for m in (
        (F.sum(rule) / F.sum("n_docs")).alias(rule + "_mean"),
        (F.sum(F.col(rule) * (F.col(rule) / F.col("n_docs"))) / F.sum("n_docs")).alias(rule + "_square"))]
    prior = hosts.agg(*moments).first()
    rates = []
    for rule in RULES:
        mean, square = prior[rule + "_mean"] or 0.0, prior[rule + "_square"] or 0.0
        spread = square - mean * mean
        low, high = PRIOR_STRENGTH
        weight = min(high, max(low, mean * (1 - mean) / spread - 1)) if spread > 0 else high
        rates.append(((F.col(rule) + mean * weight) / (F.col("n_docs") + weight)).alias(rule + "_rate"))
    rated = hosts.select("host", "n_docs", *rates)
    failed = F.greatest(*[F.col(rule + "_rate") for rule in RULES]) > HOST_LIMIT
    return rated.withColumn("failed", failed)


def judged(docs: DataFrame) -> DataFrame:
    """Counts, ``base_failed``, ``host_failed`` and ``kept`` for every row of ``docs``.

    A document is kept unless it fails a base rule or its host fails. A null host gives no
    evidence and never fails; null or empty text has no words and fails ``short``; repeated
    rows count and are answered each; extra columns are ignored; an empty table gives no
    rows.
    """
    counts = durable(document_counts(docs), "document-counts")
    bad = host_verdicts(counts).where("failed").select(F.col("host").alias("bad"))
    base = " OR ".join(f"({c})" for c in BASE_RULES.values())
    out = counts.join(bad, counts["host"] == bad["bad"], "left").withColumn(
        "base_failed", F.expr(base)).withColumn("host_failed", F.col("bad").isNotNull())
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed")).drop("bad")
