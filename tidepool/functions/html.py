"""Field extraction from landed HTML with JVM functions.

A page is cut into its tags and the text pieces between them; one fold over the tags with
a stack of open elements finds where wanted elements begin and end, so an element nested
in one of its own kind, unclosed tags, and attributes in any order and quoting are read
alike. Text is taken from the whole element: comments, script and style left out,
character references decoded, blanks squeezed, empty text treated as missing.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# '=' decides where a quote opens an attribute value, so a stray one hides nothing.
TAG = r"""</?[a-zA-Z](?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+>"""
# Markup that is no element and holds no text.
DROPPED = (r"(?is)<!--.*?(?:-->|\z)|<(script|style|template)\b[^>]*+>.*?(?:</\1\s*+>|\z)"
           r"|<[!?][^>]*+>")
REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);"
# Elements without an end tag.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
        "param", "source", "track", "wbr")
# Named references besides the five most frequent ones; nbsp reads as a blank.
NAMED = {n: chr(c) for n, c in sorted(name2codepoint.items())} | {"apos": "'"}
FREQUENT = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "nbsp": " "}
_SEP = "\u0001"

TAGS, PIECES = "_tags", "_pieces"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _code_point(cp: Column) -> Column:
    """The character of a code point; U+FFFD where there is none."""
    ok = cp.between(1, 0x10FFFF) & ~cp.between(0xD800, 0xDFFF)
    word = F.unhex(F.lpad(F.hex(F.when(ok, cp).otherwise(0xFFFD)), 8, "0"))
    return F.when(cp == 160, " ").otherwise(F.decode(word, "UTF-32"))


def _reference(name: Column) -> Column:
    """Text of one character reference (without & and ;); unknown names stay as they are."""
    out = F.when(name.startswith("#x") | name.startswith("#X"),
                 _code_point(F.conv(F.substring(name, 3, 6), 16, 10).cast("int")))
    out = out.when(name.startswith("#"), _code_point(F.substring(name, 2, 7).cast("int")))
    for n, ch in FREQUENT.items():
        out = out.when(name == n, ch)
    rest = F.create_map(*[F.lit(x) for n, ch in NAMED.items() if n not in FREQUENT
                          for x in (n, ch)])
    return out.otherwise(F.coalesce(rest[name], F.concat(F.lit("&"), name, F.lit(";"))))


def decode(c) -> Column:
    """Character references decoded once, from left to right ('&amp;lt;' becomes '&lt;')."""
    x = _c(c)
    found = F.transform(F.regexp_extract_all(x, F.lit(REFERENCE), F.lit(1)), _reference)
    joined = F.array_join(F.zip_with(F.split(x, REFERENCE, -1), found,
                                     lambda t, r: F.concat(t, F.coalesce(r, F.lit("")))), "")
    return F.when(F.contains(x, F.lit("&")), joined).otherwise(x)


def _clean(c: Column, sep: str) -> Column:
    """Text whose pieces are parted by ``_SEP``: decoded, trimmed, joined by ``sep``."""
    x = F.regexp_replace(decode(c), r"\s+", " ")
    x = F.regexp_replace(x, rf" ?{_SEP}[ {_SEP}]*", sep)
    return F.nullif(F.trim(F.regexp_replace(x, rf"^\s+|\s+$| +(?= )", "")), F.lit(""))


def clean_text(c, sep: str = " ") -> Column:
    """Text of a fragment: tags removed, references decoded, blanks squeezed; '' is NULL."""
    return _clean(F.regexp_replace(F.regexp_replace(_c(c), DROPPED, ""), TAG, _SEP), sep)


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of an opening tag in any quoting; '' if absent."""
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))"""
    return decode(F.concat(*[F.regexp_extract(tag, pattern, g) for g in (1, 2, 3)]))


def is_match(tag: Column, selector: str) -> Column:
    """Whether an opening tag matches ``name``, ``[attr=value]`` or ``name[attr=value]``."""
    name, attr, value = re.fullmatch(r"([\w-]*)(?:\[([\w-]+)=([^\]]*)\])?", selector).groups()
    out = tag.rlike(rf"(?i)^<{name or '[a-z]'}" + (r"(?=[\s/>])" if name else ""))
    if attr:
        v = re.escape(value)
        out = out & tag.rlike(rf"""(?s)\s{attr}\s*=\s*(?:"{v}"|'{v}'|{v}(?=[\s>]))""")
    return out


def with_tokens(df: DataFrame, html: str) -> DataFrame:
    """Adds the page's tags and the pieces around them (one more than tags)."""
    src = df.withColumn("_src", F.regexp_replace(F.coalesce(F.col(html), F.lit("")), DROPPED, ""))
    return (src.withColumn(TAGS, F.regexp_extract_all("_src", F.lit(TAG), F.lit(0)))
            .withColumn(PIECES, F.split("_src", TAG, -1)).drop("_src"))


def elements(selectors: Sequence[str], enclosing: bool = False) -> Column:
    """(open, close) tag numbers of every element that matches a selector, by ``open``;
    with ``enclosing`` also of all elements around those.

    An end tag closes the innermost open element of its name and what is open inside it;
    one that matches nothing is ignored; what is never closed reaches to the page's end.
    """
    def described(t: Column) -> Column:
        name = F.lower(F.regexp_extract(t, r"^</?([a-zA-Z][^\s/>]*)", 1))
        mark = is_match(t, selectors[0])
        for s in selectors[1:]:
            mark = mark | is_match(t, s)
        return F.struct(name.alias("name"), t.startswith("</").alias("end"), mark.alias("mark"),
                        (t.endswith("/>") | name.isin(*VOID)).alias("alone"))

    def step(s: Column, t: Column) -> Column:
        stack, out, depth = s["stack"], s["out"], F.size(s["stack"])
        k = F.array_position(F.reverse(F.transform(stack, lambda e: e["name"])),
                             t["name"]).cast("int")
        closed = F.transform(
            F.filter(F.slice(stack, depth - k + 1, k), lambda e: e["want"]),
            lambda e: F.struct(e["open"].alias("open"), s["i"].alias("close")))
        around = F.when(t["mark"], F.transform(stack, lambda e: F.struct(
            e["name"].alias("name"), e["open"].alias("open"), F.lit(True).alias("want")))
            ).otherwise(stack) if enclosing else stack
        here = F.array(F.struct(t["name"].alias("name"), s["i"].alias("open"),
                                t["mark"].alias("want")))
        single = F.array(F.struct(s["i"].alias("open"), s["i"].alias("close")))
        return F.struct(
            (s["i"] + 1).alias("i"),
            F.when(t["end"], F.slice(stack, F.lit(1), depth - k)).when(t["alone"], around)
            .otherwise(F.concat(around, here)).alias("stack"),
            F.when(t["end"], F.concat(out, closed))
            .when(t["alone"] & t["mark"], F.concat(out, single)).otherwise(out).alias("out"))

    start = F.struct(
        F.lit(0).alias("i"),
        F.array().cast("array<struct<name:string,open:int,want:boolean>>").alias("stack"),
        F.array().cast("array<struct<open:int,close:int>>").alias("out"))
    return F.aggregate(
        F.transform(TAGS, described), start, step,
        lambda s: F.array_sort(F.concat(s["out"], F.transform(
            F.filter(s["stack"], lambda e: e["want"]),
            lambda e: F.struct(e["open"].alias("open"), s["i"].alias("close"))))))


def element_tag(e: Column) -> Column:
    """Opening tag of an element (open, close)."""
    return F.get(TAGS, e["open"])


def element_text(e: Column, sep: str = " ") -> Column:
    """Cleaned text of an element; its pieces are joined by ``sep``."""
    return _clean(F.array_join(F.slice(PIECES, e["open"] + 2, e["close"] - e["open"]), _SEP), sep)


def element_markup(e: Column) -> Column:
    """Markup of an element, from its opening to its closing tag."""
    return F.array_join(F.zip_with(
        F.slice(TAGS, e["open"] + 1, e["close"] - e["open"] + 1),
        F.slice(PIECES, e["open"] + 2, e["close"] - e["open"]),
        lambda t, p: F.concat(F.coalesce(t, F.lit("")), F.coalesce(p, F.lit("")))), "")


def _matching(found, selector: str) -> Column:
    return F.filter(_c(found), lambda e: is_match(element_tag(e), selector))


def first_text(found, selectors: Sequence[str], sep: str = " ") -> Column:
    """Text of the first element of the first selector that yields any (fallback
    selectors in order), among the elements ``found``."""
    return F.coalesce(*[element_text(F.get(_matching(found, s), 0), sep) for s in selectors])


def all_texts(found, selectors: Sequence[str]) -> Column:
    """Texts of all elements of each selector, selectors in order ('' where empty)."""
    return F.concat(*[F.transform(_matching(found, s), lambda e: F.coalesce(
        element_text(e), F.lit(""))) for s in selectors])


def extract_cards(pages: DataFrame, html: str, keep: Sequence[str]) -> DataFrame:
    """One row per card (link with a target) of a page, with its position on the page
    (kept for first-seen ordering), target and cleaned anchor text."""
    links = with_tokens(pages, html).withColumn("_links", elements(["a"]))
    cards = F.filter(F.transform("_links", lambda e: F.struct(
        attribute(element_tag(e), "href").alias("href"), element_text(e).alias("text"))),
        lambda c: c["href"] != "")
    rows = links.select(*keep, F.posexplode(cards).alias("pos", "_card"))
    return rows.select(*keep, "pos", F.col("_card.href").alias("href"),
                       F.col("_card.text").alias("card_text"))
