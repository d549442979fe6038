"""Roadmap rollups (R1-R4) over the lineitem silver and the documents."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidepool.operators import gold, keywords, retention
from tidepool.plans import q_lineitem as QL
from tidepool.plans.registry import query
from tidepool.sources.tables import read_table

CHAIN = QL.w(*QL.CHAIN)


@query("r1_vacancies_latest", CHAIN + """
SELECT vacancy_id, snapshot_id, search_text, search_area, page_num, l_quantity,
       strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at, l_extendedprice, l_orderkey,
       l_partkey, array_to_string(matched_roles, ',') AS matched_roles,
       array_to_string(matched_areas, ',') AS matched_areas, matched_rows FROM (
  SELECT *, row_number() OVER (PARTITION BY vacancy_id ORDER BY ingested_at DESC,
         snapshot_id DESC) AS rn2 FROM silver) WHERE rn2 = 1""")
def r1_vacancies_latest(spark, sf):
    s = QL.silver_df(spark, sf)
    cols = [c for c in s.columns if c != "vacancy_id"]
    return QL.silver_out(gold.latest_per_key(s, "vacancy_id", ("ingested_at", "snapshot_id"), cols))



def exact_median(df, keys: list[str], value: str, alias: str, width: float = 100.0):
    """Lower median and row count per key, exact at any size.

    Rows are counted per distinct value in each task first. Running totals are taken over
    ranges of ``width`` (one narrow row each) to find the range that holds the median; only
    the distinct values of that range are then ranked, so no task gets a whole group."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c"))
    counts = counts.withColumn("_b", F.floor(F.col(value) / width))
    w = Window.partitionBy(*keys)
    upto = w.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    ranges = (counts.groupBy(*keys, "_b").agg(F.sum("_c").alias("_r"))
              .withColumn("_before", F.sum("_r").over(upto) - F.col("_r"))
              .withColumn("n", F.sum("_r").over(w))
              .withColumn("_half", F.ceil(F.col("n") / 2))
              .where("_before < _half AND _half <= _before + _r"))
    inside = counts.join(ranges.select(*keys, "_b", "_before", "_half", "n"), [*keys, "_b"])
    total = w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (inside.withColumn("_t", F.col("_before") + F.sum("_c").over(total))
            .where("_t >= _half").groupBy(*keys)
            .agg(F.min(value).alias(alias), F.max("n").alias("n")))



@query("r2_salary_by_role", CHAIN + """
SELECT role, area, quantile_disc(l_extendedprice, 0.5) AS median_price, count(*) AS n FROM (
  SELECT unnest(matched_roles) AS role, matched_areas, l_extendedprice FROM silver)
  CROSS JOIN LATERAL (SELECT unnest(matched_areas) AS area)
GROUP BY role, area""")
def r2_salary_by_role(spark, sf):
    s = QL.silver_df(spark, sf)
    fanned = s.select(F.explode("matched_roles").alias("role"), "matched_areas",
                      "l_extendedprice")
    fanned = fanned.select("role", F.explode("matched_areas").alias("area"), "l_extendedprice")
    return exact_median(fanned, ["role", "area"], "l_extendedprice", "median_price")


@query("r3_employer_top", CHAIN + """
, life AS (SELECT s.vacancy_id, p.p_brand AS employer,
                 date_diff('day', min(s.ingested_at), max(s.ingested_at)) AS lifetime_days
          FROM silver s JOIN part p ON p.p_partkey = s.l_partkey GROUP BY ALL)
SELECT employer, count(DISTINCT vacancy_id) AS vacancies,
       CAST(round(avg(lifetime_days), 2) AS DOUBLE) AS avg_lifetime_days
FROM life GROUP BY employer ORDER BY vacancies DESC, employer LIMIT 10""")
def r3_employer_top(spark, sf):
    """Employers (part brands) by distinct vacancies (suppliers), with the mean lifetime
    of a (vacancy, employer) pair across snapshots: a top-10 report."""
    s = QL.silver_df(spark, sf)
    part = read_table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"),
                                                F.col("p_brand").alias("employer"))
    life = s.join(part, "l_partkey").groupBy("vacancy_id", "employer").agg(
        F.date_diff(F.max("ingested_at"), F.min("ingested_at")).alias("lifetime_days"))
    top = life.groupBy("employer").agg(
        F.count_distinct("vacancy_id").alias("vacancies"),
        F.round(F.avg("lifetime_days"), 2).cast("double").alias("avg_lifetime_days"))
    return gold.top_k(top, ["vacancies"], 10, ["employer"])


WORD_SEPARATOR = r"[^\p{L}]+"


@query("r4_keyword_skills", f"""
WITH dict AS (SELECT DISTINCT unnest(string_split_regex(lower(text), '{WORD_SEPARATOR}')) AS skill
              FROM benchmark),
words AS (SELECT DISTINCT doc_id, unnest(string_split_regex(lower(text), '{WORD_SEPARATOR}')) AS skill
          FROM documents)
SELECT w.skill, count(*) AS docs FROM words w JOIN dict d ON d.skill = w.skill
WHERE w.skill <> '' GROUP BY w.skill""")
def r4_keyword_skills(spark, sf):
    """Dictionary keywords (every word of ``benchmark``) found in whole document texts;
    documents per keyword. Words are made distinct within each document before they are
    joined, so only counts are shuffled."""
    def terms(text):
        return F.array_distinct(F.split(F.lower(text), WORD_SEPARATOR))
    vocab = (read_table(spark, sf, "benchmark").select(F.explode(terms("text")).alias("skill"))
             .filter(F.col("skill") != "").distinct())
    words = read_table(spark, sf, "documents").select(F.explode(terms("text")).alias("skill"))
    return words.join(vocab, "skill").groupBy("skill").agg(F.count(F.lit(1)).alias("docs"))


LAGS = (1, 2, 3, 6, 12)


@query("r3_retention", CHAIN + f"""
, m AS (SELECT DISTINCT p.p_brand AS employer, s.vacancy_id,
               year(s.ingested_at) * 12 + month(s.ingested_at) AS mo
        FROM silver s JOIN part p ON p.p_partkey = s.l_partkey),
c AS (SELECT a.employer, l.lag, count(*) AS seen, count(b.mo) AS kept
      FROM m a CROSS JOIN (SELECT unnest({list(LAGS)}) AS lag) l
      LEFT JOIN m b ON b.employer = a.employer AND b.vacancy_id = a.vacancy_id
                   AND b.mo = a.mo + l.lag
      WHERE a.mo + l.lag <= (SELECT max(mo) FROM m) GROUP BY a.employer, l.lag)
SELECT employer, CAST(lag AS INTEGER) AS lag, seen, kept, (kept * 10000) // seen AS kept_bp FROM c""")
def r3_retention(spark, sf):
    """Employers (part brands): share of vacancies (suppliers) of a month that are in the
    snapshots of the month 1 to 12 months later."""
    part = read_table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"),
                                                F.col("p_brand").alias("employer"))
    seen = QL.silver_df(spark, sf).select("vacancy_id", "l_partkey", "ingested_at")
    return retention.retention(seen.join(part, "l_partkey"), ["employer"], "vacancy_id",
                               retention.month_index("ingested_at"), LAGS)


PHRASE_WORDS = 4


@query("r4_phrase_skills", f"""
WITH items AS (
  SELECT list_filter(string_split_regex(lower(text), '{WORD_SEPARATOR}'), lambda x: x <> '') AS w
  FROM benchmark),
cuts AS (SELECT w, unnest(range(0, len(w), {PHRASE_WORDS})) AS i FROM items),
dict AS (SELECT DISTINCT array_to_string(
           w[i + 1 : i + 1 + (i // {PHRASE_WORDS}) % {PHRASE_WORDS}], ' ') AS skill FROM cuts),
docs AS (SELECT row_number() OVER () AS r, doc_id,
           list_filter(string_split_regex(lower(text), '{WORD_SEPARATOR}'), lambda x: x <> '') AS w
         FROM documents),
placed AS (SELECT r, doc_id, unnest(w) AS w1, generate_subscripts(w, 1) AS p FROM docs),
near AS (SELECT r, doc_id, p, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3,
           lead(w1, 3) OVER o AS w4 FROM placed WINDOW o AS (PARTITION BY r ORDER BY p)),
grams AS (SELECT r, doc_id, p, 1 AS k, w1 AS skill FROM near
  UNION ALL SELECT r, doc_id, p, 2, w1 || ' ' || w2 FROM near
  UNION ALL SELECT r, doc_id, p, 3, w1 || ' ' || w2 || ' ' || w3 FROM near
  UNION ALL SELECT r, doc_id, p, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM near),
hits AS (SELECT r, doc_id, p, max(k) AS k, arg_max(g.skill, k) AS skill
         FROM grams g JOIN dict d ON d.skill = g.skill GROUP BY r, doc_id, p)
SELECT skill, CAST(k AS INTEGER) AS n_words, count(*) AS places, count(DISTINCT doc_id) AS docs
FROM hits GROUP BY skill, k""")
def r4_phrase_skills(spark, sf):
    """Skills of one to four words in whole texts, the longest at each place. The
    dictionary are phrases of 1, 2, 3, 4, 1 ... words that start at every fourth word of
    the ``benchmark`` items."""
    w = keywords.words(F.col("text"), WORD_SEPARATOR)
    items = read_table(spark, sf, "benchmark").select(w.alias("w")).where(F.size("w") > 0)
    cuts = items.select("w", F.explode(
        F.sequence(F.lit(0), F.size("w") - 1, F.lit(PHRASE_WORDS))).alias("i"))
    length = F.floor(F.col("i") / PHRASE_WORDS) % PHRASE_WORDS + 1
    skills = cuts.select(F.slice("w", F.col("i") + 1, length.cast("int")).alias("skill"))
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    found = keywords.longest_matches(docs, "doc_id", w, skills, "skill", PHRASE_WORDS)
    return found.groupBy(F.col("phrase").alias("skill"), "n_words").agg(
        F.count(F.lit(1)).alias("places"), F.count_distinct("doc_id").alias("docs"))
