"""Landing operators over ``conversations``: conversation = slice, turn = page
(L3, L4, L9, L10, L15, L16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators import landing as L
from tidepool.plans.registry import query
from tidepool.sources.tables import read_table


def conv(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "conversations")


def api_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One landed page per turn: a system turn is an empty page; the declared page
    count of a conversation is its number of user turns."""
    c = conv(spark, sf)
    declared = c.groupBy("conv_id").agg(F.count_if(F.col("role") == "user").alias("declared"))
    return c.select("conv_id", "turn", "role",
                    F.when(F.col("role") == "system", 0)
                    .otherwise(F.size(F.split("text", " "))).alias("n_items")) \
        .join(declared, "conv_id")


@query("l3_page_cutoff_api", """
WITH p AS (SELECT c.conv_id, c.turn, c.role,
                  CASE WHEN role = 'system' THEN 0 ELSE len(string_split(text, ' ')) END AS n_items,
                  d.declared
           FROM conversations c JOIN (SELECT conv_id, count(*) FILTER (WHERE role = 'user') AS declared
                                      FROM conversations GROUP BY conv_id) d USING (conv_id)),
c AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS expected
      FROM p),
s AS (SELECT conv_id, min(CASE WHEN n_items = 0 THEN turn WHEN turn <> expected THEN expected END) AS fe
      FROM c GROUP BY conv_id)
SELECT c.conv_id, c.turn, c.role, CAST(c.n_items AS INTEGER) AS n_items FROM c JOIN s USING (conv_id)
WHERE (s.fe IS NULL OR c.turn < s.fe) AND c.turn <= greatest(coalesce(c.declared, 0) - 1, 0)""")
def l3_page_cutoff_api(spark, sf):
    kept = L.page_cutoff(api_pages(spark, sf), ["conv_id"], "turn", "n_items", "declared")
    return kept.select("conv_id", "turn", "role", "n_items")


STATUS_SQL = "CASE WHEN role = 'system' THEN 403 WHEN turn % 5 = 4 THEN 500 ELSE 200 END"


@query("l4_source_fallback", f"""
WITH a AS (SELECT conv_id, turn, role, {STATUS_SQL} AS status FROM conversations),
per AS (SELECT conv_id, min(CASE WHEN status IN (401, 403) THEN turn END) AS b,
               min(CASE WHEN status NOT IN (200, 401, 403) THEN turn END) AS f
        FROM a GROUP BY conv_id),
ok AS (SELECT * FROM per WHERE f IS NULL OR (b IS NOT NULL AND b < f))
SELECT a.conv_id, a.turn, a.role, 'api' AS src FROM a JOIN ok USING (conv_id)
WHERE ok.b IS NULL OR a.turn < ok.b
UNION ALL
SELECT conv_id, turn, role, 'html' AS src FROM conversations
WHERE role = 'user' AND conv_id IN (SELECT conv_id FROM ok WHERE b IS NOT NULL)""")
def l4_source_fallback(spark, sf):
    c = conv(spark, sf)
    api = c.select("conv_id", "turn", "role", F.expr(STATUS_SQL).alias("status"),
                   F.lit("api").alias("src"))
    html = c.filter(F.col("role") == "user").select("conv_id", "turn", "role",
                                                    F.lit("html").alias("src"))
    return L.source_fallback(api, html, ["conv_id"], "turn", "status")


FIRST_BAD = f"""a AS (SELECT conv_id, turn, role, {STATUS_SQL} AS status FROM conversations),
bad AS (SELECT conv_id, min(turn) AS turn, arg_min(status, turn) AS status
        FROM a WHERE status <> 200 GROUP BY conv_id)"""


def api_status(spark: SparkSession, sf: str) -> DataFrame:
    return conv(spark, sf).select("conv_id", "turn", "role", F.expr(STATUS_SQL).alias("status"))


@query("l4_failed_slices", f"""
WITH {FIRST_BAD} SELECT conv_id, turn, status FROM bad WHERE status NOT IN (401, 403)""")
def l4_failed_slices(spark, sf):
    return L.failed_slices(api_status(spark, sf), "conv_id", "turn", "status")


@query("l19_empty_fallback_slices", f"""
WITH {FIRST_BAD} SELECT conv_id FROM bad WHERE status IN (401, 403)
AND conv_id NOT IN (SELECT conv_id FROM conversations WHERE role = 'assistant' AND turn > 2)""")
def l19_empty_fallback_slices(spark, sf):
    api = api_status(spark, sf)
    html = api.filter("role = 'assistant' AND turn > 2")
    return L.empty_fallback_slices(api, html, "conv_id", "turn", "status")


@query("l9_first_seen_dedup", """
SELECT conv_id, role, turn FROM (
  SELECT conv_id, role, turn, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS rn
  FROM conversations) WHERE rn = 1""")
def l9_first_seen_dedup(spark, sf):
    return L.first_seen(conv(spark, sf).select("conv_id", "role", "turn"),
                        ["conv_id"], "role", ["turn"])


def word_cards(spark: SparkSession, sf: str) -> DataFrame:
    """Cards = the blank-separated words of each whole turn, with their position."""
    c = conv(spark, sf)
    return c.select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("pos", "word"))


CARDS_SQL = """cards AS (SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS pos, w[i] AS word FROM (
    SELECT conv_id, turn, string_split(text, ' ') AS w,
           generate_subscripts(string_split(text, ' '), 1) AS i
    FROM conversations))"""
FRESH_SQL = """fresh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, word
           ORDER BY turn, pos) AS rn FROM cards) WHERE rn = 1)"""


@query("l10_page_cutoff_html", f"""
WITH {CARDS_SQL}, {FRESH_SQL},
pp AS (SELECT conv_id, turn, count(*) AS n FROM cards GROUP BY conv_id, turn),
pn AS (SELECT conv_id, turn, count(*) AS n_new FROM fresh GROUP BY conv_id, turn),
g AS (SELECT pp.conv_id, pp.turn, pn.n_new,
             row_number() OVER (PARTITION BY pp.conv_id ORDER BY pp.turn) - 1 AS expected
      FROM pp LEFT JOIN pn ON pp.conv_id = pn.conv_id AND pp.turn = pn.turn),
st AS (SELECT conv_id, min(CASE WHEN n_new IS NULL OR n_new = 0 THEN turn
                                WHEN turn <> expected THEN expected END) AS stop
       FROM g GROUP BY conv_id)
SELECT f.conv_id, f.word, f.turn, f.pos FROM fresh f JOIN st USING (conv_id)
WHERE st.stop IS NULL OR f.turn < st.stop""")
def l10_page_cutoff_html(spark, sf):
    kept = L.cutoff_new(word_cards(spark, sf), ["conv_id"], "word", "turn", "pos")
    return kept.select("conv_id", "word", "turn", "pos")


@query("l15_detail_cap", f"""
WITH {CARDS_SQL}, {FRESH_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, pos) AS r FROM fresh)
SELECT conv_id, word, turn, pos,
       CASE WHEN r <= 3 THEN CASE WHEN length(word) > 3 THEN 'ok' ELSE 'http_404' END
            ELSE 'not_fetched_limit' END AS detail_status
FROM ranked""")
def l15_detail_cap(spark, sf):
    cards = L.first_seen(word_cards(spark, sf), ["conv_id"], "word", ["turn", "pos"])
    details = cards.select("conv_id", "word", F.when(F.length("word") > 3, "ok")
                           .otherwise("http_404").alias("detail_status"))
    out = L.cap_enrich(cards, details, ["conv_id"], "word", ["turn", "pos"], n=3)
    return out.select("conv_id", "word", "turn", "pos", "detail_status")


URL_SQL = ("concat('https://example.com/', CASE WHEN conv_id % 7 = 0 "
           "THEN 'account/captcha' ELSE 'c' END, '/', conv_id)")


@query("l16_detail_status", f"""
SELECT conv_id, turn,
  CASE WHEN role = 'system' THEN 'error'
       WHEN turn % 6 = 5 THEN 'http_404'
       WHEN contains({URL_SQL}, '/account/captcha') OR contains({URL_SQL}, 'captcha')
            OR contains(lower(text), 'не робот') THEN 'captcha'
       ELSE 'ok' END AS detail_status
FROM conversations""")
def l16_detail_status(spark, sf):
    c = conv(spark, sf)
    err = F.when(F.col("role") == "system", F.col("text"))
    status = F.when(F.col("turn") % 6 == 5, 404).otherwise(200)
    title = F.col("text")
    return c.select("conv_id", "turn",
                    L.detail_status(err, status, title, F.expr(URL_SQL)).alias("detail_status"))
