"""The ingest job on hand-made landed responses: API pages with cutoffs, a blocked
slice falling back to HTML cards, capped detail lookups, a failing slice, an empty
slice; retried landing adds nothing."""

import json
import tempfile

import pytest

from tidepool.functions.payload import staging
from tidepool.plans import ingest as I
from tidepool.operators import landing as L
from tidepool.sources import bronze as B

ROLES, AREAS = ["dev", "ops"], ["msk", "spb", "remote"]


def api_body(ids, pages):
    return json.dumps({"items": [{"id": i, "name": f"job {i}", "employer": {"name": "ACME"}}
                                 for i in ids], "pages": pages, "found": 99})


API = [  # (role, area, page, status, body)
    ("dev", "msk", 0, 200, api_body([1, 2], 2)), ("dev", "msk", 1, 200, api_body([3], 2)),
    ("dev", "msk", 2, 200, api_body([4], 2)),                      # beyond declared pages
    ("dev", "spb", 0, 200, api_body([5], 5)), ("dev", "spb", 1, 200, api_body([], 5)),
    ("dev", "spb", 2, 403, ""),                                    # never reached
    ("dev", "remote", 0, 200, api_body([6], 5)), ("dev", "remote", 1, 403, ""),
    ("ops", "msk", 0, 500, ""),                                    # slice fails
    ("ops", "spb", 0, 403, ""),
    ("ops", "remote", 0, 200, api_body([], 0)),                    # empty slice
]


def card(vid, title, employer="Corp", text="Опыт 1–3 года Гибрид"):
    return (f'<div class="c"><a data-qa="serp-item__title" href="/vacancy/{vid}?q=1">{title}</a>'
            f'<a data-qa="vacancy-serp__vacancy-employer" href="/e">{employer}</a>'
            f'<span data-qa="vacancy-serp__vacancy-compensation">100&nbsp;000 ₽</span>'
            f"<p>{text}</p></div>")


def page(*cards_):
    return "<html><body><main>" + "".join(cards_) + "</main></body></html>"


SEARCH = [
    ("dev", "remote", 0, page(card(10, "A &amp; B"), card(11, "C"), card(10, "A again"))),
    ("dev", "remote", 1, page(card(12, "D"))),
    ("dev", "remote", 2, page(card(11, "C"))),                     # nothing new: stop
    ("dev", "remote", 3, page(card(13, "never"))),
    ("ops", "spb", 0, page(card(20, "E"), card(21, "F"))),
]


def detail_html(title, skills):
    tags = "".join(f'<span data-qa="skills-element">{s}</span>' for s in skills)
    return (f'<h1 data-qa="vacancy-title">{title}</h1><div data-qa="vacancy-company-name">ACME</div>'
            f'<div data-qa="vacancy-description"><p>Line one</p><p>Line two</p></div>{tags}')


DETAIL = [
    ("dev", "remote", "https://jobs.example.com/vacancy/10", 200, "https://jobs.example.com/vacancy/10",
     detail_html("Detail A", ["k8s", "go", "k8s", ""]), None),
    ("dev", "remote", "https://jobs.example.com/vacancy/11", 200, "https://jobs.example.com/account/captcha?x",
     "<h1>Я не робот</h1>", None),
    ("dev", "remote", "https://jobs.example.com/vacancy/12", 404, "https://jobs.example.com/vacancy/12", "gone", None),
    ("ops", "spb", "https://jobs.example.com/vacancy/20", 200, "https://jobs.example.com/vacancy/20",
     detail_html("Detail E", ["python"]), None),
]


def frames(spark):
    api = spark.createDataFrame(API, "search_text string, search_area string, page_num int, "
                                     "status int, body string")
    search = spark.createDataFrame(
        [(r, a, p, f"https://jobs.example.com/search?p={p}", h) for r, a, p, h in SEARCH],
        "search_text string, search_area string, page_num int, url string, html string")
    detail = spark.createDataFrame(DETAIL, "search_text string, search_area string, "
                                           "requested_url string, status int, final_url string, "
                                           "html string, error string")
    grid = L.slice_grid(spark.createDataFrame([(r,) for r in ROLES], "search_text string"),
                        "search_text", AREAS)
    return api, search, detail, grid


def test_ingest_end_to_end(spark):
    path = tempfile.mkdtemp(prefix="tp-ingest-") + "/bronze"
    api, search, detail, grid = frames(spark)
    report = {(r[0], r[1]): r[2] for r in
              I.run_ingest(spark, api, search, detail, path, grid, "snap-1").collect()}
    assert report[("dev", "msk")] == 3            # pages 0 and 1 (declared 2)
    assert report[("dev", "spb")] == 1            # stops at the empty page, 403 never seen
    assert report[("dev", "remote")] == 1 + 3     # API page 0 kept + 3 new HTML cards
    assert report[("ops", "msk")] == 0            # 500: the slice fails
    assert report[("ops", "spb")] == 2
    assert report[("ops", "remote")] == 0
    assert report[(None, None)] == 10

    stg = {(r["search_area"], r["vacancy_id"]): r for r in
           staging(B.read_bronze(spark, path)).collect()}
    ok = stg[("remote", "10")]
    assert ok["quality_score"] == 4 and ok["title"] == "Detail A"
    assert ok["skills"] == ["k8s", "go"] and ok["employer_name"] == "ACME"
    assert ok["experience"] == "Опыт 1–3 года" and ok["schedule_text"] == "Гибрид"
    assert ok["salary_text"] == "100 000 ₽"
    assert stg[("remote", "11")]["detail_status"] == "captcha"
    assert stg[("remote", "12")]["detail_status"] == "http_404"
    assert stg[("msk", "1")]["source_mode"] == "api" and stg[("msk", "1")]["employer_name"] == "ACME"

    # the same batch landing again adds nothing
    again = I.run_ingest(spark, api, search, detail, path, grid, "snap-1", bronze_exists=True)
    assert {(r[0], r[1]): r[2] for r in again.collect()}[(None, None)] == 0
    assert B.read_bronze(spark, path).count() == 10


def test_detail_cap_limits_lookups(spark):
    api, search, detail, grid = frames(spark)
    rows = I.html_rows(search.filter("search_area = 'remote'"), detail, detail_cap=1)
    status = {r["vacancy_id"]: json.loads(r["raw_json"])["detail_status"] for r in rows.collect()}
    assert status == {"10": "ok", "11": "not_fetched_limit", "12": "not_fetched_limit"}


def test_repeated_details_do_not_multiply_cards(spark):
    api, search, detail, grid = frames(spark)
    path = tempfile.mkdtemp(prefix="tp-ingest-") + "/bronze"
    twice = detail.unionByName(detail).unionByName(detail)
    I.run_ingest(spark, api, search, twice, path, grid, "snap-1").count()
    rows = B.read_bronze(spark, path)
    keys = ["snapshot_id", *I.SLICE, "vacancy_id"]
    assert rows.count() == rows.select(*keys).distinct().count() == 10


def test_blocked_slice_without_cards_fails(spark):
    api, search, detail, grid = frames(spark)
    path = tempfile.mkdtemp(prefix="tp-ingest-") + "/bronze"
    with pytest.raises(RuntimeError, match="ops.*spb"):
        I.run_ingest(spark, api, search.filter("search_area = 'remote'"), detail, path, grid, "s")
    failed = L.failed_slices(I.api_rows(api), I.SLICE, "page_num", "status").collect()
    assert [tuple(r) for r in failed] == [("ops", "msk", 0, 500)]


SLICE_OF = ("dev", "remote", "https://jobs.example.com/vacancy/10")


@pytest.mark.parametrize("bad", [(None, None, None, "timeout"), (404, SLICE_OF[2], "gone", None),
                                 (200, "https://jobs.example.com/captcha", "<h1>x</h1>", None),
                                 (200, SLICE_OF[2], "<h1>half</h1>", "reset")])
def test_a_good_detail_beats_a_failed_one(spark, bad):
    api, search, detail, grid = frames(spark)
    for first in (True, False):
        other = spark.createDataFrame([(*SLICE_OF, *bad)], detail.schema)
        both = other.unionByName(detail) if first else detail.unionByName(other)
        kept = I.one_detail(both).filter("requested_url LIKE '%/10'").collect()
        assert [(r["status"], r["error"], "Detail A" in r["html"]) for r in kept] == [(200, None, True)]


def test_payloads_carry_every_key(spark):
    api, search, detail, grid = frames(spark)
    rows = I.html_rows(search.filter("search_area = 'remote'"), detail, fetch_details=False)
    for r in rows.collect():
        assert list(json.loads(r["raw_json"])) == [*I.CARD_FIELDS, *I.DETAIL_OUT]
    off = json.loads(rows.filter("vacancy_id = '10'").first()["raw_json"])
    assert off["detail_status"] == "disabled" and off["detail_title"] is None
    assert off["title"] == "A & B" and off["page_num"] == 0


def test_failed_slices_are_reported_and_raised(spark):
    api, search, detail, grid = frames(spark)
    path = tempfile.mkdtemp(prefix="tp-ingest-") + "/bronze"
    status = search.selectExpr("*", "CASE WHEN search_text = 'dev' AND page_num = 1 THEN 502 "
                               "WHEN search_text = 'dev' AND page_num = 3 THEN 500 "
                               "ELSE 200 END AS status")
    with pytest.raises(I.SlicesFailed, match="dev / remote: html page 1 answered 502; "
                                             "ops / msk: api page 0 answered 500") as e:
        I.run_ingest(spark, api, status, detail, path, grid, "snap-1", raise_failed=True)
    report = {(r[0], r[1]): tuple(r)[2:] for r in e.value.report.collect()}
    assert report[("dev", "remote")] == (0, "html", 1, 502)     # nothing of the slice landed
    assert report[("ops", "msk")] == (0, "api", 0, 500)
    assert report[("ops", "spb")] == (2, None, None, None)      # the others did
    assert report[(None, None)] == (6, None, None, None)
    assert B.read_bronze(spark, path).count() == 6


def test_a_bad_page_that_is_never_reached_fails_nothing(spark):
    api, search, detail, grid = frames(spark)
    path = tempfile.mkdtemp(prefix="tp-ingest-") + "/bronze"
    status = search.selectExpr("*", "CASE WHEN page_num = 3 THEN 500 ELSE 200 END AS status")
    report = {(r[0], r[1]): tuple(r)[2:] for r in I.run_ingest(
        spark, api, status, detail, path, grid, "snap-1").collect()}
    assert report[("dev", "remote")] == (4, None, None, None)   # page 2 had nothing new
    assert report[("ops", "msk")] == (0, "api", 0, 500)


def test_run_passes_its_limits_on(spark):
    api, search, detail, grid = frames(spark)
    path = tempfile.mkdtemp(prefix="tp-ingest-") + "/bronze"
    I.run_ingest(spark, api, search, detail, path, grid, "snap-1", detail_cap=1).count()
    status = {r["vacancy_id"]: r["detail_status"] for r in staging(B.read_bronze(spark, path)).filter(
        "search_area = 'remote' AND source_mode = 'html_fallback'").collect()}
    assert status == {"10": "ok", "11": "not_fetched_limit", "12": "not_fetched_limit"}
