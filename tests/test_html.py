"""Whole-element extraction: nesting, sloppy markup, attribute order and quoting,
character references, and cards scoped to their enclosing element."""

import pytest
from hypothesis import given, settings, strategies as st

from tidepool.functions import html as H
from tidepool.plans import ingest as I


def texts(spark, pages, selectors, sep=" "):
    df = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    df = H.with_tokens(df, "html").withColumn("f", H.elements(selectors))
    return [r[0] for r in df.select(H.first_text("f", selectors, sep).alias("t"), "id")
            .orderBy("id").collect()]


def test_element_text(spark):
    page = ('<body><div data-qa="d"><div>First part</div><p>Second <b>part</b></p>'
            '<script>var x = "</div>";</script><!-- </div> --></div><div>tail</div></body>')
    pages = [page, "<p data-qa='d'>unclosed<br>text", "<div data-qa=d >a<p>b</div>c", "", None,
             '<div title="a > b" data-qa="d">x</div>', '<img data-qa="d">y', "<div>no</div>",
             '<div data-qa="d"> </div><div data-qa="d">late</div>', "a < b <div data-qa='d'>1 < 2</div>"]
    assert texts(spark, pages, ["[data-qa=d]"]) == [
        "First part Second part", "unclosed text", "a b", None, None, "x", None, None, None, "1 < 2"]
    assert texts(spark, [page], ["[data-qa=d]"], "\n") == ["First part\nSecond\npart"]
    assert texts(spark, [page], ["h1", "p"]) == ["Second part"]


@pytest.mark.parametrize("raw, want", [
    ("&amp;lt; &lt;b&gt;", "&lt; <b>"), ("&#39;&#x416;&#128512;&eacute;&apos;", "'Ж😀é'"),
    ("100&nbsp;000&#160;1", "100 000 1"), ("&bogus; & &#0;", "&bogus; & �"), ("&ndash;&hellip;", "–…")])
def test_references(spark, raw, want):
    row = spark.createDataFrame([(raw,)], "x string").select(H.clean_text("x"))
    assert row.first()[0] == want


def test_links_in_any_form(spark):
    page = ("<a href='/1'><b>one</b> more</a><a class=\"c\" href=\"/2\">two</a><A HREF=/3>three</A>"
            '<a name="x">none</a><!-- <a href="/4">no</a> --><a href="/5?a=1&amp;b=2"></a>')
    df = spark.createDataFrame([(page,)], "html string")
    rows = H.extract_cards(df, "html", []).orderBy("pos").collect()
    assert [tuple(r) for r in rows] == [(0, "/1", "one more"), (1, "/2", "two"), (2, "/3", "three"),
                                        (3, "/5?a=1&b=2", None)]


def test_cards_are_their_enclosing_element(spark):
    def card(n, salary):
        return (f"<div class='c'><span data-qa='{I.CARD_SALARY}'>{salary}</span><h3><a class=t "
                f'data-qa="{I.CARD_TITLE}" href="/vacancy/{n}"><b>Job</b> {n}</a></h3>'
                f'<div><a href="/e" data-qa="{I.CARD_EMPLOYER}">E{n}</a></div></div>')
    page = ("<html><body><main>" + card(1, "10") + card(2, "20") +
            "</main><footer>Без опыта</footer></body></html>")
    search = spark.createDataFrame([("dev", "msk", 0, "u", page)],
                                   "search_text string, search_area string, page_num int, "
                                   "url string, html string")
    got = [(r["vacancy_id"], r["title"], r["employer"], r["salary"], r["card_text"], r["experience_card"])
           for r in I.cards(search).orderBy("pos").collect()]
    assert got == [("1", "Job 1", "E1", "10", "10 Job 1 E1", None),
                   ("2", "Job 2", "E2", "20", "20 Job 2 E2", None)]


def brute(tokens):
    """Text of the first <div> of a token list, with a stack."""
    stack, inside, out, done = [], None, [], False
    for t in tokens:
        if t.startswith("</"):
            if t[2:-1] in stack:
                while stack.pop() != t[2:-1]:
                    pass
                if inside is not None and len(stack) <= inside:
                    done, inside = True, None
        elif t.startswith("<"):
            if t == "<div>" and inside is None and not done:
                inside = len(stack)
            if t != "<br>":
                stack.append(t[1:-1])
        elif inside is not None:
            out.append(t)
    return " ".join(out) or None


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<div>", "</div>", "<p>", "</p>", "<br>", "x", "y"]),
                         max_size=14), min_size=40, max_size=60))
def test_nesting_matches_brute_force(spark, pages):
    assert texts(spark, ["".join(f"{t} " if t in "xy" else t for t in p) for p in pages], ["div"]) \
        == [brute(p) for p in pages]
