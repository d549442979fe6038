"""The ingest run as one Spark job over landed responses (all slices at once).

Inputs are tables of what the fetcher stored, one row per response:

* ``api``:    (search_text, search_area, page_num, status, body)   -- JSON list pages
* ``search``: (search_text, search_area, page_num, url, html) and, where the fetcher kept
  it, status (absent: 200)                                        -- HTML result pages
* ``detail``: (search_text, search_area, requested_url, status, final_url, html,
  error)                                                          -- detail pages

API slices: L3 page cutoff -> L4 fallback on 401/403 -> L2 items. Blocked slices:
L5 cards cut from the result pages -> L7/L8 ids and canonical URLs -> L9/L10
first-seen cutoff -> L15 capped detail lookups -> L16 status, L6 fields -> L17 merged
payload. Then L20 one id for the batch, S3 retry-safe append, S2 append, L18 report.

A slice fails when a page it reaches answers with anything else (API) or with anything but
200 (result pages): none of its rows land, and the report names the page and the status.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import html as H
from tidepool.functions import text as X
from tidepool.operators import landing as L
from tidepool.operators.silver import arg_extreme
from tidepool.sources import bronze as B

SLICE = ("search_text", "search_area")
SITE = "https://jobs.example.com"

# The markup markers (data-qa attributes) of the search and detail pages.
CARD_TITLE = "serp-item__title"
CARD_EMPLOYER = "vacancy-serp__vacancy-employer"
CARD_SALARY = "vacancy-serp__vacancy-compensation"
CARD_ADDRESS = "vacancy-serp__vacancy-address"
DETAIL_FIELDS = {
    "detail_title": ("vacancy-title", "h1"),
    "detail_employer": ("vacancy-company-name",),
    "experience": ("vacancy-experience",),
    "employment": ("vacancy-view-employment-mode", "vacancy-view-employment"),
    "schedule": ("vacancy-view-schedule",),
    "salary_detail": ("vacancy-salary",),
    "address_detail": ("vacancy-view-raw-address", "vacancy-view-location"),
}
DESCRIPTION = ("vacancy-description", "vacancy-description-text")
SKILLS = ("skills-element", "bloko-tag__text", "vacancy-skill")
# Words that only a whole card (or the list around it) holds, and how many
# elements outwards from its title link a card is looked for.
CARD_WORDS = ("Откликнуться", "Вакансии")
CARD_LEVELS = 8


def qa(marker: str) -> str:
    return marker if marker == "h1" else f"[data-qa={marker}]"


def qa_all(markers: Sequence[str], found: str) -> Column:
    """Texts of every element of each marker, markers in order, first occurrence kept,
    empty texts dropped (L13)."""
    return X.ordered_distinct(H.all_texts(found, [qa(m) for m in markers]))


# ---------------------------------------------------------------- API path

def api_rows(api: DataFrame, max_pages: int | None = None) -> DataFrame:
    v = F.try_parse_json(F.col("body"))
    pages = api.select(*SLICE, "page_num", "status", "body",
                       F.coalesce(F.size(F.try_variant_get(v, "$.items", "array<variant>")),
                                  F.lit(0)).alias("n_items"),
                       F.try_variant_get(v, "$.pages", "int").alias("declared"))
    return L.page_cutoff(pages, SLICE, "page_num", "n_items", "declared", max_pages,
                         status="status").select(*SLICE, "page_num", "status", "body")


# ---------------------------------------------------------------- HTML path

def cards(search: DataFrame) -> DataFrame:
    """One row per title link of a result page. Its card is the nearest element around
    the link that holds an employer link or a card word, else the link's parent; fields are
    read inside the card."""
    title, employer = f"a[data-qa={CARD_TITLE}]", f"a[data-qa={CARD_EMPLOYER}]"
    t = (H.with_tokens(search, "html").withColumn("_around", H.elements([title], enclosing=True))
         .withColumn("_employers", _numbers(H.TAGS, lambda x: H.is_match(x, employer)))
         .withColumn("_words", _numbers(H.PIECES, lambda x: x.rlike("|".join(CARD_WORDS)))))
    links = F.filter("_around", lambda e: H.is_match(H.element_tag(e), title))

    def root(link: Column) -> Column:
        outwards = F.slice(F.reverse(F.filter("_around", lambda e: (
            e["open"] <= link["open"]) & (e["close"] >= link["close"]))), 1, CARD_LEVELS + 1)
        whole = F.filter(F.slice(outwards, 1, CARD_LEVELS), lambda e: (
            F.exists("_employers", lambda i: (i > e["open"]) & (i < e["close"]))
            | F.exists("_words", lambda i: (i > e["open"]) & (i <= e["close"]))))
        return F.coalesce(F.get(whole, 0), F.get(outwards, 1), link)

    found = F.transform(links, lambda x: F.struct(
        H.attribute(H.element_tag(x), "href").alias("href"), H.element_text(x).alias("title"),
        H.element_markup(root(x)).alias("markup")))
    parts = t.select(*SLICE, "page_num", F.col("url").alias("search_url"),
                     F.posexplode(found).alias("pos", "_card"))
    parts = parts.select(*SLICE, "page_num", "search_url", "pos", "_card.*")
    fields = [CARD_EMPLOYER, CARD_SALARY, CARD_ADDRESS]
    parts = H.with_tokens(parts, "markup").withColumn("_found", H.elements([qa(m) for m in fields]))
    url = X.resolve_url(F.col("href"), F.lit(SITE + "/"))
    card_text = H.clean_text("markup")
    return parts.select(
        *SLICE, "page_num", "pos", "search_url",
        X.id_from_url(url).alias("vacancy_id"),
        url.alias("url"), "title",
        *[H.first_text("_found", [qa(m)]).alias(n)
          for n, m in zip(("employer", "salary", "address"), fields)],
        card_text.alias("card_text"),
        X.first_match(card_text).alias("experience_card"),
        X.markers(card_text).alias("work_format_card"))


def _numbers(items: str, cond) -> Column:
    """Numbers (from 0) of the array's items for which ``cond`` holds."""
    return F.array_compact(F.transform(items, lambda x, i: F.when(cond(x), i)))


def details(detail: DataFrame) -> DataFrame:
    """L16 + L6 on landed detail pages, keyed by slice and the canonical URL that was
    requested (each slice fetches its own details). Descriptions keep one line per text
    piece."""
    wanted = dict.fromkeys(("h1", *[m for ms in DETAIL_FIELDS.values() for m in ms],
                            *DESCRIPTION, *SKILLS))
    d = H.with_tokens(detail, "html").withColumn("_found", H.elements([qa(m) for m in wanted]))
    d = d.withColumn("_title", F.coalesce(H.first_text("_found", ["h1"]), F.lit("")))
    title = F.col("_title")
    status = L.detail_status(F.col("error"), F.col("status"), title, F.col("final_url"))
    ok = status == "ok"
    fields = {n: F.when(ok, H.first_text("_found", [qa(m) for m in ms]))
              for n, ms in DETAIL_FIELDS.items()}
    err = (F.when(status == "error", F.col("error"))
           .when(status == "captcha", F.coalesce(F.nullif(title, F.lit("")), F.col("html")))
           .when(status != "ok", F.col("html")))
    return d.select(
        *SLICE, F.col("requested_url").alias("detail_requested_url"),
        status.alias("detail_status"), F.col("final_url").alias("detail_url"),
        err.alias("detail_error"), *[c.alias(n) for n, c in fields.items()],
        F.when(ok, H.first_text("_found", [qa(m) for m in DESCRIPTION], sep="\n")).alias("description"),
        F.when(ok, qa_all(SKILLS, "_found")).alias("skills"))


CARD_FIELDS = ("source_mode", "vacancy_id", "title", "url", "employer", "salary", "address",
               "search_text", "search_area", "page_num", "search_url", "card_text",
               "experience_card", "work_format_card")
DETAIL_OUT = ("detail_status", "detail_url", "detail_requested_url", "detail_error",
              *DETAIL_FIELDS, "description", "skills")


def page_status(search: DataFrame) -> Column:
    """Status of landed result pages; 200 where the fetcher kept none."""
    return (F.coalesce(F.col("status"), F.lit(200)) if "status" in search.columns
            else F.lit(200))


def one_detail(detail: DataFrame) -> DataFrame:
    """One landed answer per (slice, requested URL), so a detail that landed twice cannot
    multiply its card: a successful answer before any other, then an answered lookup before
    one that raised, then the smallest status."""
    rest = [x for x in detail.columns if x not in (*SLICE, "requested_url")]
    good = L.detail_status(F.col("error"), F.coalesce("status", F.lit(0)), F.lit(""),
                           F.col("final_url")) == "ok"
    ranked = detail.withColumn("_rank", F.when(good, 0).when(F.col("status") == 200, 1)
                               .when(F.col("status").isNotNull(), 2).otherwise(3))
    picked = ranked.groupBy(*SLICE, "requested_url").agg(
        arg_extreme(["_rank", "status"], rest, largest=False).alias("_r"))
    return picked.select(*SLICE, "requested_url", *[F.col("_r")[x].alias(x) for x in rest])


def html_rows(search: DataFrame, detail: DataFrame, max_pages: int | None = None,
              detail_cap: int = L.DETAIL_MAX_PER_SLICE, fetch_details: bool = True) -> DataFrame:
    c = cards(search)
    fresh = L.cutoff_new(c, SLICE, "vacancy_id", "page_num", "pos", max_pages)
    fresh = fresh.withColumn("detail_requested_url",
                             X.canonical_url("url", SITE)).withColumn("source_mode",
                                                                      F.lit("html_fallback"))
    d = details(one_detail(detail))
    keyed = fresh.select(*SLICE, "vacancy_id", "detail_requested_url").join(
        d, [*SLICE, "detail_requested_url"], "left") \
        .withColumn("detail_status", F.coalesce("detail_status", F.lit("error")))
    enriched = L.cap_enrich(fresh, keyed.select(*SLICE, "vacancy_id", "detail_status"),
                            SLICE, "vacancy_id", ["page_num", "pos"], detail_cap, fetch_details)
    full = enriched.join(keyed.drop("detail_status", "detail_requested_url"),
                         [*SLICE, "vacancy_id"], "left")
    made = ~F.col("detail_status").isin("not_fetched_limit", "disabled")
    body = L.payload_json({n: F.col(n) for n in CARD_FIELDS} | {
        n: F.col(n) if n == "detail_status" else F.when(made, F.col(n)) for n in DETAIL_OUT})
    return full.select(*SLICE, "page_num", "vacancy_id", body.alias("raw_json"))


# ---------------------------------------------------------------- the run

class SlicesFailed(RuntimeError):
    """Slices of a run that landed nothing because a page failed; ``report`` has them all."""

    def __init__(self, message: str, report: DataFrame):
        super().__init__(message)
        self.report = report


def failed_searches(pages: DataFrame, rows: DataFrame) -> DataFrame:
    """Slices whose walk over the result pages reached a page with a status other than 200:
    every page before it gave new cards. ``pages`` (slice, page_num, status), ``rows`` the
    rows of the pages before it."""
    bad = L.first_bad_pages(pages, SLICE, "page_num", "status")
    walked = rows.groupBy(*SLICE).agg(F.count_distinct("page_num").alias("_walked"))
    return (bad.join(walked, list(SLICE), "left")
            .where(F.coalesce("_walked", F.lit(0)) == F.col("page_num"))
            .select(*SLICE, F.lit("html").alias("failed_source"),
                    F.col("page_num").alias("failed_page"), F.col("status").alias("failed_status")))


def run_ingest(spark: SparkSession, api: DataFrame, search: DataFrame, detail: DataFrame,
               bronze_path: str, grid: DataFrame, snapshot_id: str | None = None,
               bronze_exists: bool | None = None, max_pages: int | None = None,
               detail_cap: int = L.DETAIL_MAX_PER_SLICE, fetch_details: bool = True,
               raise_failed: bool = False) -> DataFrame:
    """Land one snapshot batch; returns the L18 report: rows inserted per slice and their
    total, and for a failed slice the source, page and status that ended it. With
    ``raise_failed`` failed slices raise :class:`SlicesFailed` once the others have landed.
    ``detail_cap`` bounds the detail lookups of a slice (L15), ``max_pages`` its pages."""
    a = api_rows(api, max_pages)
    pages = search.withColumn("status", page_status(search))
    html_src = pages.select(*SLICE, "page_num", "status", F.lit("html").alias("src"))
    api_src = a.select(*SLICE, "page_num", "status", F.lit("api").alias("src"))
    routed = L.source_fallback(api_src, html_src, SLICE, "page_num", "status")
    api_ok = a.join(routed.filter(F.col("src") == "api").select(*SLICE, "page_num"),
                    [*SLICE, "page_num"], "left_semi")
    items = L.flatten_items(api_ok.filter(F.col("status") == 200), "body", [*SLICE, "page_num"])
    api_out = items.select(*SLICE, "page_num", F.col("item_id").alias("vacancy_id"),
                           F.col("item_json").alias("raw_json"))
    blocked = routed.filter(F.col("src") == "html").select(*SLICE).distinct()
    asked = pages.join(blocked, list(SLICE), "left_semi")
    if max_pages is not None:
        asked = asked.where(F.col("page_num") < max_pages)
    good = asked.where("status = 200").select(*[c for c in search.columns if c != "status"])
    html_out = html_rows(good, detail, max_pages, detail_cap, fetch_details)
    html_out = html_out.checkpoint(eager=True)
    failed = L.failed_slices(a, SLICE, "page_num", "status").select(
        *SLICE, F.lit("api").alias("failed_source"), F.col("page_num").alias("failed_page"),
        F.col("status").alias("failed_status")).unionByName(
        failed_searches(asked.select(*SLICE, "page_num", "status"), html_out)).checkpoint(eager=True)
    empty = L.empty_fallback_slices(a, html_out, SLICE, "page_num", "status").join(
        failed, list(SLICE), "left_anti")
    for r in empty.limit(1).collect():
        L.require_rows(html_out.limit(0), f"API blocked and the HTML fallback gave 0 rows: {r}")
    rows = L.stamp(api_out.unionByName(html_out).join(failed, list(SLICE), "left_anti"), snapshot_id)
    keys = ["snapshot_id", *SLICE, "vacancy_id"]
    if bronze_exists is None:
        bronze_exists = B.table_exists(spark, bronze_path)
    if bronze_exists:
        rows = B.retry_safe(rows, bronze_path, keys)
    rows = rows.checkpoint(eager=True)
    B.append_bronze(rows, bronze_path)
    report = L.ingest_report(rows, grid, SLICE, "vacancy_id").join(failed, list(SLICE), "left")
    if raise_failed:
        first = failed.orderBy(*SLICE).limit(20).collect()
        if first:
            raise SlicesFailed("; ".join(
                f"{r['search_text']} / {r['search_area']}: {r['failed_source']} page "
                f"{r['failed_page']} answered {r['failed_status']}" for r in first), report)
    return report
