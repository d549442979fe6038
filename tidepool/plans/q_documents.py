"""Payload typing and text functions over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import payload as P
from tidepool.functions import text as X
from tidepool.functions.format import arr_text
from tidepool.operators import quality, silver
from tidepool.plans.registry import query
from tidepool.sources.bronze import staging_view
from tidepool.sources.payloads import document_payloads
from tidepool.sources.tables import read_table


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return P.staging(document_payloads(spark, sf), keep_raw=False)


# ---------------------------------------------------------------- oracle SQL builders


def d_str(path: str) -> str:
    return (f"nullif(CASE WHEN json_type(j, '{path}') = 'VARCHAR' "
            f"THEN json_extract_string(j, '{path}') END, '')")


def d_long(path: str) -> str:
    return (f"CASE WHEN json_type(j, '{path}') IN ('BIGINT', 'UBIGINT') "
            f"THEN CAST(json_extract(j, '{path}') AS BIGINT) END")


def d_arr(path: str) -> str:
    return (f"coalesce(CASE WHEN json_type(j, '{path}') = 'ARRAY' THEN list_transform("
            f"list_filter(CAST(json_extract(j, '{path}') AS JSON[]), "
            f"lambda x: json_type(x) = 'VARCHAR'), lambda x: json_extract_string(x, '$')) END, "
            f"CAST([] AS VARCHAR[]))")


def d_unify(paths) -> str:
    return "coalesce(" + ", ".join(d_str(p) for p in paths) + ")"


D_PAYLOAD = """
CASE d.lang
  WHEN 'en' THEN CAST(json_object(
      'source_mode', 'html_fallback', 'detail_status', st,
      'detail_title', split_part(d.text, '.', 1), 'title', d.source,
      'url', concat('https://example.com/doc/', d.doc_id), 'employer', d.source,
      'description', d.text, 'skills', string_split(d.text, ' '), 'card_text', d.text,
      'experience_card', d.lang, 'work_format_card', '') AS VARCHAR)
  WHEN 'fr' THEN CAST(json_object(
      'source_mode', 'html_fallback', 'detail_status', st, 'title', '',
      'name', split_part(d.text, ' ', 1), 'employer', d.n_chars,
      'skills', split_part(d.text, ' ', 2),
      'salary', concat(CAST(d.n_chars AS VARCHAR), ' EUR'), 'address', d.source, 'description', d.text) AS VARCHAR)
  WHEN 'es' THEN CAST(json_object(
      'name', split_part(d.text, '.', 1), 'employer', json_object('name', d.source),
      'salary', json_object('from', d.n_chars, 'to', d.n_chars * 1.5, 'currency', 'EUR'),
      'alternate_url', concat('https://example.com/api/', d.doc_id),
      'skills', [d.source, d.lang, d.source], 'description', d.text) AS VARCHAR)
  ELSE CASE WHEN d.doc_id % 7 = 0 THEN concat('not json ', d.text)
            ELSE CAST(json_object('source_mode', 'mystery', 'title', d.source,
                                  'description', d.text,
                                  'skills', [d.lang, NULL, '']) AS VARCHAR) END
END"""

QUALITY_ST = ("CASE WHEN l.quality = 1 THEN 'ok' WHEN l.toxic = 1 THEN 'captcha' "
              "WHEN l.quality = 0 THEN 'http_403' END")
STG_FIELDS = ",\n  ".join(f"{d_unify(paths)} AS {out}" for out, paths in P.STAGING_SPEC.items())

STG = f"""p AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, {D_PAYLOAD} AS raw_json
  FROM documents d
  LEFT JOIN (SELECT doc_id, {QUALITY_ST} AS st FROM labels l) l ON l.doc_id = d.doc_id),
pj AS (SELECT *, CASE WHEN json_valid(raw_json) THEN CAST(raw_json AS JSON) END AS j FROM p),
s0 AS (SELECT doc_id, lang, source, n_chars,
  coalesce({d_str('$.source_mode')}, 'api') AS source_mode,
  {STG_FIELDS},
  {d_long('$.salary.from')} AS salary_from, {d_long('$.salary.to')} AS salary_to,
  {d_str('$.salary.currency')} AS salary_currency, {d_arr('$.skills')} AS skills FROM pj),
stg AS (SELECT *, CAST(strlen(coalesce(description, '')) AS INTEGER) AS description_length,
  CAST(len(skills) AS INTEGER) AS skills_count,
  (source_mode = 'html_fallback' AND detail_status = 'ok') AS has_detail,
  CASE WHEN source_mode = 'html_fallback' AND detail_status = 'ok' THEN 4
       WHEN source_mode = 'html_fallback' AND detail_status = 'captcha' THEN 3
       WHEN source_mode = 'html_fallback' THEN 2
       WHEN source_mode = 'api' THEN 1 ELSE 0 END AS quality_score FROM s0)
"""


def w(body: str) -> str:
    return "WITH " + STG + body


@query("t1_json_string", w("""
SELECT doc_id, detail_status, card_text, work_format_card FROM stg"""))
def t1_json_string(spark, sf):
    return staged(spark, sf).select("doc_id", "detail_status", "card_text", "work_format_card")


@query("t2_json_nested_string", "WITH " + STG + f"""
SELECT doc_id, {d_str('$.employer.name')} AS employer_nested,
       {d_str('$.salary.currency')} AS salary_currency FROM pj""")
def t2_json_nested_string(spark, sf):
    v = P.parse(F.col("raw_json"))
    return document_payloads(spark, sf).select(
        "doc_id", P.json_str(v, "$.employer.name").alias("employer_nested"),
        P.json_str(v, "$.salary.currency").alias("salary_currency"))


@query("t3_json_int", """
SELECT event_id, CASE WHEN json_type(CAST(props AS JSON), '$.k') IN ('BIGINT', 'UBIGINT')
       THEN CAST(json_extract(CAST(props AS JSON), '$.k') AS BIGINT) END AS k
FROM events""")
def t3_json_int(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.select("event_id", P.json_long(P.parse(F.col("props")), "$.k").alias("k"))


@query("t3_json_int_nested", w("""
SELECT doc_id, salary_from, salary_to FROM stg"""))
def t3_json_int_nested(spark, sf):
    return staged(spark, sf).select("doc_id", "salary_from", "salary_to")


@query("t4_json_array", w("""
SELECT doc_id, array_to_string(skills, '|') AS skills, skills_count FROM stg"""))
def t4_json_array(spark, sf):
    return staged(spark, sf).select("doc_id", arr_text("skills", sort=False, sep="|")
                                    .alias("skills"), "skills_count")


STAGING_COLS = ("doc_id", "source_mode", *P.STAGING_SPEC.keys(), "salary_from", "salary_to",
                "salary_currency", "description_length", "skills_count", "has_detail",
                "quality_score")


@query("t5_coalesce_chain", w(f"""
SELECT {', '.join(STAGING_COLS)}, array_to_string(skills, '|') AS skills FROM stg"""))
def t5_coalesce_chain(spark, sf):
    return staged(spark, sf).select(*STAGING_COLS, arr_text("skills", sort=False, sep="|")
                                    .alias("skills"))


@query("t6_default_mode", w("SELECT doc_id, source_mode FROM stg"))
def t6_default_mode(spark, sf):
    return staged(spark, sf).select("doc_id", "source_mode")


@query("t7_null_if_empty", w("""
SELECT doc_id, title, employment, schedule_text FROM stg"""))
def t7_null_if_empty(spark, sf):
    return staged(spark, sf).select("doc_id", "title", "employment", "schedule_text")


@query("t8_passthrough", w("""
SELECT doc_id, lang, source, n_chars, CASE WHEN starts_with(raw_json, 'not json ') THEN md5(raw_json) END AS raw_md5,
       md5(CASE WHEN j IS NOT NULL THEN json_extract_string(j, '$.description') END) AS text_md5
FROM pj"""))
def t8_passthrough(spark, sf):
    """Kept columns and the raw payload after staging: unparsable payloads byte for byte,
    the others by the whole text in them (escapes differ between JSON writers)."""
    s = P.staging(document_payloads(spark, sf), keep=["doc_id", "lang", "source", "n_chars"])
    raw = F.col("raw_json")
    return s.select("doc_id", "lang", "source", "n_chars",
                    F.when(raw.startswith("not json "), F.md5(raw.cast("binary"))).alias("raw_md5"),
                    F.md5(F.get_json_object(raw, "$.description").cast("binary")).alias("text_md5"))


@query("t9_byte_length", w("""
SELECT s.doc_id, s.description_length, CAST(strlen(d.text) AS INTEGER) AS text_bytes,
       CAST(length(d.text) AS INTEGER) AS text_chars
FROM stg s JOIN documents d ON d.doc_id = s.doc_id"""))
def t9_byte_length(spark, sf):
    docs = read_table(spark, sf, "documents").select(
        "doc_id", P.byte_length("text").alias("text_bytes"),
        F.char_length("text").alias("text_chars"))
    return staged(spark, sf).select("doc_id", "description_length").join(docs, "doc_id")


@query("t10_array_size", """
SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS n_words FROM documents""")
def t10_array_size(spark, sf):
    d = read_table(spark, sf, "documents")
    words = P.json_str_array(P.parse(F.to_json(F.struct(F.split("text", " ").alias("w")))), "$.w")
    return d.select("doc_id", F.size(words).alias("n_words"))


@query("t11_has_detail", w("SELECT doc_id, has_detail FROM stg"))
def t11_has_detail(spark, sf):
    return staged(spark, sf).select("doc_id", "has_detail")


@query("t12_quality_score", w("SELECT doc_id, quality_score FROM stg"))
def t12_quality_score(spark, sf):
    return staged(spark, sf).select("doc_id", "quality_score")


SILVER_COUNTS_SQL = """
count(*) AS silver_rows, count(DISTINCT doc_id) AS unique_keys,
count(*) FILTER (WHERE detail_status = 'ok') AS detail_ok, count(*) FILTER (WHERE detail_status = 'captcha') AS detail_captcha,
count(*) FILTER (WHERE description_length > 0) AS has_description, count(*) FILTER (WHERE skills_count > 0) AS has_skills,
CAST(round_even(avg(description_length), 0) AS DOUBLE) AS avg_desc_len"""


def doc_stats(df: DataFrame) -> DataFrame:
    return quality.silver_stats(
        df, ["doc_id"],
        {"detail_ok": F.col("detail_status") == "ok",
         "detail_captcha": F.col("detail_status") == "captcha",
         "has_description": F.col("description_length") > 0,
         "has_skills": F.col("skills_count") > 0},
        mean_of="description_length", mean_alias="avg_desc_len")


@query("a10_silver_stats", w(f"SELECT {SILVER_COUNTS_SQL} FROM stg"))
def a10_silver_stats(spark, sf):
    return doc_stats(staged(spark, sf))


@query("t15_pct_label", w(f"""
SELECT CAST(round(detail_ok * 100.0 / silver_rows, 1) AS DOUBLE) AS detail_ok_pct,
       CASE WHEN silver_rows = 0 THEN '0%'
            ELSE printf('%.1f%%', round(detail_ok * 100.0 / silver_rows, 1)) END AS detail_ok_label,
       CAST(round(has_skills * 100.0 / silver_rows, 1) AS DOUBLE) AS skills_pct,
       CASE WHEN silver_rows = 0 THEN '0%'
            ELSE printf('%.1f%%', round(has_skills * 100.0 / silver_rows, 1)) END AS skills_label
FROM (SELECT {SILVER_COUNTS_SQL} FROM stg)"""))
def t15_pct_label(spark, sf):
    st = doc_stats(staged(spark, sf))
    return st.select(X.pct("detail_ok", "silver_rows").alias("detail_ok_pct"),
                     X.pct_label("detail_ok", "silver_rows").alias("detail_ok_label"),
                     X.pct("has_skills", "silver_rows").alias("skills_pct"),
                     X.pct_label("has_skills", "silver_rows").alias("skills_label"))


@query("s6_staging_view", w("""
SELECT source_mode, detail_status, count(*) AS n FROM stg GROUP BY source_mode, detail_status"""))
def s6_staging_view(spark, sf):
    name = staging_view(staged(spark, sf), "stg_documents")
    return spark.sql(f"SELECT source_mode, detail_status, count(*) AS n FROM {name} "
                     "GROUP BY source_mode, detail_status")


@query("w1_best_row_payload", w("""
SELECT source, doc_id, quality_score, description_length FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY quality_score DESC,
         description_length DESC, doc_id DESC) AS rn FROM stg) WHERE rn = 1"""))
def w1_best_row_payload(spark, sf):
    """The reference's ranking (quality, then byte length) picking one row per source."""
    best = silver.best_row(staged(spark, sf), ["source"],
                           ["quality_score", "description_length", "doc_id"])
    return best.select("source", "doc_id", "quality_score", "description_length")
