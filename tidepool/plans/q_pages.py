"""Landed pages and text: cards, fields, ids, canonical URLs (L5-L8) and text
functions over whole documents (L11-L14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.functions import html as H
from tidepool.functions import text as X
from tidepool.plans.registry import query
from tidepool.sources.tables import read_table

def d_text(markup: str) -> str:
    """Text of markup: what follows each '>' up to the next '<', references decoded."""
    text = (f"array_to_string(list_transform(string_split({markup}, '<'), lambda x, k: "
            "CASE WHEN k = 1 THEN x ELSE substr(x, strpos(x, '>') + 1) END), ' ')")
    return (f"nullif(array_to_string(list_filter(string_split_regex({d_decoded(text)}, "
            "'\\s+'), lambda x: x <> ''), ' '), '')")


def d_decoded(text: str) -> str:
    for ref, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
                    ("&nbsp;", " "), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&amp;", "&")):
        text = f"replace({text}, '{ref}', '{ch}')"
    return text


def d_after(text: str, mark: str) -> str:
    return f"substr({text}, strpos({text}, '{mark}') + {len(mark)})"


def d_elem(tag: str) -> str:
    """Inner markup of the only element with this tag."""
    return f"split_part({d_after(d_after('html', '<' + tag), '>')}, '</{tag}>', 1)"


RESOLVE_SQL = """CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*://') THEN href
     WHEN starts_with(href, '//') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1) || ':' || href
     WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)', 1) || href
     ELSE '?' END"""


@query("l5_html_cards", f"""
WITH c AS (SELECT page_id, url, unnest(string_split(html, '<a ')[2:]) AS card,
                  unnest(range(len(string_split(html, '<a ')) - 1)) AS i FROM pages),
l AS (SELECT page_id, url, CAST(i AS INTEGER) AS pos,
             {d_decoded("split_part(split_part(card, 'href=\"', 2), '\"', 1)")} AS href,
             {d_text("split_part(" + d_after('card', '>') + ", '</a>', 1)")} AS card_text FROM c)
SELECT page_id, pos, href, card_text, {RESOLVE_SQL} AS abs_url FROM l""")
def l5_html_cards(spark, sf):
    pages = read_table(spark, sf, "pages")
    cards = H.extract_cards(pages, "html", ["page_id", "url"])
    return cards.select("page_id", "pos", "href", "card_text",
                        X.resolve_url("href", F.col("url")).alias("abs_url"))


@query("l6_html_fields", f"""
SELECT page_id, coalesce({d_text(d_elem('h1'))}, {d_text(d_elem('title'))}) AS title,
       {d_text(d_elem('title'))} AS head_title, {d_text(d_elem('article'))} AS description
FROM pages""")
def l6_html_fields(spark, sf):
    p = H.with_tokens(read_table(spark, sf, "pages").select("page_id", "html"), "html")
    p = p.withColumn("_found", H.elements(["h1", "title", "article"]))
    return p.select("page_id",
                    H.first_text("_found", ["h1", "title"]).alias("title"),
                    H.first_text("_found", ["title"]).alias("head_title"),
                    H.first_text("_found", ["article"]).alias("description"))


@query("l7_id_from_url", """
SELECT page_id, coalesce(nullif(regexp_extract(url, '/(\\d+)', 1), ''), url) AS item_id FROM pages""")
def l7_id_from_url(spark, sf):
    p = read_table(spark, sf, "pages")
    return p.select("page_id", X.id_from_url("url", r"/(\d+)").alias("item_id"))


@query("l8_canonical_url", """
SELECT page_id, CASE WHEN regexp_extract(url, '/en/(\\d+)', 1) <> ''
                     THEN 'https://example.com/doc/' || regexp_extract(url, '/en/(\\d+)', 1)
                     ELSE split_part(url, '?', 1) END AS canonical FROM pages""")
def l8_canonical_url(spark, sf):
    p = read_table(spark, sf, "pages")
    return p.select("page_id", X.canonical_url("url", "https://example.com", r"/en/(\d+)",
                                               "/doc/").alias("canonical"))


# Fixed test parameters over the documents' invented prose (tried in this order).
DOC_PATTERNS = ("the [a-z]+", "le [a-zé]+", "der [a-zäöü]+", "ción[a-z]*")
DOC_MARKERS = ("worthless", "Nicht", "para", " le ")


@query("l11_ordered_patterns", "SELECT doc_id, coalesce(" + ", ".join(
    f"nullif(regexp_extract(text, '{p}', 0), '')" for p in DOC_PATTERNS)
    + ") AS first_match FROM documents")
def l11_ordered_patterns(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", X.first_match("text", DOC_PATTERNS).alias("first_match"))


@query("l12_marker_join", "SELECT doc_id, nullif(concat_ws(', ', " + ", ".join(
    f"CASE WHEN contains(text, '{m}') THEN '{m}' END" for m in DOC_MARKERS)
    + "), '') AS markers FROM documents")
def l12_marker_join(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", X.markers("text", DOC_MARKERS).alias("markers"))


@query("l13_ordered_distinct", """
WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word,
                  unnest(generate_series(1, len(string_split(text, ' ')))) AS i FROM documents),
f AS (SELECT doc_id, word, min(i) AS first_i FROM w WHERE word <> '' GROUP BY doc_id, word)
SELECT d.doc_id, coalesce(string_agg(f.word, '|' ORDER BY f.first_i), '') AS words,
       CAST(count(f.word) AS INTEGER) AS n_distinct
FROM documents d LEFT JOIN f ON f.doc_id = d.doc_id GROUP BY d.doc_id""")
def l13_ordered_distinct(spark, sf):
    d = read_table(spark, sf, "documents")
    arr = X.ordered_distinct(F.split("text", " "))
    return d.select("doc_id", F.array_join(arr, "|").alias("words"),
                    F.size(arr).alias("n_distinct"))


@query("l14_truncate", """
SELECT doc_id, substring(text, 1, 500) AS head, CAST(length(substring(text, 1, 500)) AS INTEGER) AS n
FROM documents""")
def l14_truncate(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", X.truncate("text", 500).alias("head"),
                    F.char_length(X.truncate("text", 500)).alias("n"))
