"""Bronze-shaped payload tables derived from the input tables.

``documents`` (left-joined to ``labels``) is turned into landed JSON payloads of the
three shapes the staging layer unifies: html rows with a detail page, html rows
with only card fields (and wrongly typed fields), API rows with nested objects, plus
unparsable text and an unknown mode. The payload is derived row by row, so its size
grows with the documents table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.sources.tables import read_table

DETAIL_STATUS_SQL = """CASE WHEN l.quality = 1 THEN 'ok' WHEN l.toxic = 1 THEN 'captcha'
                            WHEN l.quality = 0 THEN 'http_403' END"""

PAYLOAD_SQL = """
CASE d.lang
  WHEN 'en' THEN to_json(named_struct(
      'source_mode', 'html_fallback', 'detail_status', st,
      'detail_title', split_part(d.text, '.', 1), 'title', d.source,
      'url', concat('https://example.com/doc/', d.doc_id), 'employer', d.source,
      'description', d.text, 'skills', split(d.text, ' '), 'card_text', d.text,
      'experience_card', d.lang, 'work_format_card', ''))
  WHEN 'fr' THEN to_json(named_struct(
      'source_mode', 'html_fallback', 'detail_status', st, 'title', '',
      'name', split_part(d.text, ' ', 1), 'employer', d.n_chars,
      'skills', split_part(d.text, ' ', 2),
      'salary', concat(CAST(d.n_chars AS STRING), ' EUR'), 'address', d.source, 'description', d.text))
  WHEN 'es' THEN to_json(named_struct(
      'name', split_part(d.text, '.', 1), 'employer', named_struct('name', d.source),
      'salary', named_struct('from', d.n_chars, 'to', d.n_chars * 1.5, 'currency', 'EUR'),
      'alternate_url', concat('https://example.com/api/', d.doc_id),
      'skills', array(d.source, d.lang, d.source), 'description', d.text))
  ELSE CASE WHEN d.doc_id % 7 = 0 THEN concat('not json ', d.text)
            ELSE to_json(named_struct('source_mode', 'mystery', 'title', d.source,
                                      'description', d.text,
                                      'skills', array(d.lang, NULL, ''))) END
END"""


def document_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_chars, raw_json): one landed payload per document."""
    d = read_table(spark, sf_dir, "documents").alias("d")
    l = read_table(spark, sf_dir, "labels").alias("l")
    j = d.join(l, F.col("d.doc_id") == F.col("l.doc_id"), "left")
    j = j.select("d.doc_id", "d.lang", "d.source", "d.n_chars", "d.text", "l.quality", "l.toxic")
    j = j.select("*", F.expr(DETAIL_STATUS_SQL.replace("l.", "")).alias("st"))
    payload = F.expr(PAYLOAD_SQL.replace("d.", "").replace("l.", ""))
    return j.select("doc_id", "lang", "source", "n_chars", payload.alias("raw_json"))
