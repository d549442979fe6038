"""Landing operators re-aimed at already landed responses and pages.

Nothing here fetches: input tables hold landed API responses / HTML pages, one row
per (slice, page), and every step is a DataFrame transformation over all slices at
once (the slice is a column, not a task).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.operators.silver import arg_extreme

# Page caps of the API and HTML paths, detail lookups per slice, and
# the markers that identify a captcha page.
API_MAX_PAGES = 20
HTML_MAX_PAGES = 5
DETAIL_MAX_PER_SLICE = 100
SHARES = 64      # parts a hot slice is reduced in before its last window
BLOCKED = (401, 403)         # API statuses that send a slice to the HTML pages
CAPTCHA_URL_MARKERS = ("/account/captcha", "captcha")
CAPTCHA_TITLE_MARKER = "не робот"


def _cols(cs: Sequence[str] | str) -> list[str]:
    return [cs] if isinstance(cs, str) else list(cs)


def slice_grid(roles: DataFrame, role_col: str, areas: Sequence[str],
               area_col: str = "search_area") -> DataFrame:
    """L1: expected slices = every role row x every area of the parameter list.

    A generator (explode of a literal array) instead of a cross join: output size is
    |roles| x |areas|, bounded by the parameter list."""
    return roles.select(role_col).distinct().select(
        role_col, F.explode(F.array(*[F.lit(a) for a in areas])).alias(area_col))


def flatten_items(responses: DataFrame, payload: str, keep: Sequence[str],
                  items_path: str = "$.items", id_path: str = "$.id") -> DataFrame:
    """L2: one landed response -> one row per item, with its position, its id as text
    (a missing id gives '') and the item itself as JSON text (non-ASCII kept)."""
    v = F.try_parse_json(F.col(payload))
    exploded = responses.select(*keep, F.posexplode_outer(
        F.try_variant_get(v, items_path, "array<variant>")).alias("pos", "_item"))
    return exploded.filter(F.col("_item").isNotNull()).select(
        *keep, "pos",
        F.coalesce(F.try_variant_get("_item", id_path, "string"), F.lit("")).alias("item_id"),
        F.to_json("_item").alias("item_json"))


def page_cutoff(pages: DataFrame, slice_cols: Sequence[str], page: str, n_items: str,
                declared_pages: str, max_pages: int | None = None,
                status: str | None = None) -> DataFrame:
    """L3: the pages a page-by-page fetch visits: up to the first empty page
    (exclusive; a page that never landed counts as empty), the page at which the
    response's declared page count ends (inclusive; declared 0 or missing means page 0
    only) and, if one is given, the page cap. With ``status``, a non-200 page is visited and ends the
    range (what follows it is decided by :func:`source_fallback`). Input: one row per
    (slice, page).

    The end search runs over page numbers only (one narrow row per page); the per-slice
    end is then joined back on the slice."""
    s = _cols(slice_cols)
    capped = pages if max_pages is None else pages.filter(F.col(page) < max_pages)
    w = Window.partitionBy(*s).orderBy(page)
    expected = F.row_number().over(w) - 1
    bad = (F.col(status) != 200) if status else F.lit(False)
    last = F.greatest(F.coalesce(F.col(declared_pages), F.lit(0)) - 1, F.lit(0))
    end = (F.when(F.col(page) != expected, expected)
           .when(bad, F.col(page) + 1)
           .when(F.col(n_items) == 0, F.col(page))
           .when(F.col(page) >= last, F.col(page) + 1))
    ends = capped.select(*s, end.alias("_end")).groupBy(*s).agg(F.min("_end").alias("_end"))
    return (capped.join(ends, s, "left")
            .filter(F.col("_end").isNull() | (F.col(page) < F.col("_end")))
            .drop("_end"))


def source_fallback(api: DataFrame, html: DataFrame, slice_cols: Sequence[str], page: str,
                    status: str, blocked: Sequence[int] = (401, 403)) -> DataFrame:
    """L4: per slice, the API rows before the first blocked page, plus the HTML rows of
    blocked slices. A slice with any other non-200 status before that point fails and
    contributes nothing. Both sides must have the same columns (``status`` excepted)."""
    s = _cols(slice_cols)
    per = api.groupBy(*s).agg(
        F.min(F.when(F.col(status).isin(*blocked), F.col(page))).alias("_blocked"),
        F.min(F.when(~F.col(status).isin(200, *blocked), F.col(page))).alias("_failed"))
    per = per.filter(F.col("_failed").isNull()
                     | (F.col("_blocked").isNotNull() & (F.col("_blocked") < F.col("_failed"))))
    kept = (api.join(per, s, "inner")
            .filter(F.col("_blocked").isNull() | (F.col(page) < F.col("_blocked")))
            .drop("_blocked", "_failed", status))
    fallback = html.join(per.filter(F.col("_blocked").isNotNull()).select(*s), s, "left_semi")
    return kept.unionByName(fallback.select(*kept.columns))


def first_bad_pages(api: DataFrame, slice_cols: Sequence[str] | str, page: str,
                    status: str) -> DataFrame:
    """Per slice the first page with a status other than 200, with that status; a page
    landed twice counts by its smallest status."""
    s = _cols(slice_cols)
    bad = api.filter(F.col(status) != 200).groupBy(*s).agg(
        F.min(F.struct(F.col(page).alias("page"), F.col(status).alias("status"))).alias("_b"))
    return bad.select(*s, F.col("_b.page").alias(page), F.col("_b.status").alias(status))


def failed_slices(api: DataFrame, slice_cols: Sequence[str] | str, page: str,
                  status: str) -> DataFrame:
    """L4: slices that fail, which get neither API nor HTML rows, with the page and status
    that ended them."""
    return first_bad_pages(api, slice_cols, page, status).filter(
        ~F.col(status).isin(*BLOCKED))


def empty_fallback_slices(api: DataFrame, html: DataFrame, slice_cols: Sequence[str] | str,
                          page: str, status: str) -> DataFrame:
    """Blocked slices whose HTML fallback gave no row."""
    s = _cols(slice_cols)
    blocked = first_bad_pages(api, s, page, status).filter(F.col(status).isin(*BLOCKED))
    return blocked.select(*s).join(html.select(*s).distinct(), s, "left_anti")


def first_seen(df: DataFrame, slice_cols: Sequence[str], key: str,
               order: Sequence[str]) -> DataFrame:
    """Within a slice keep the first occurrence of each key under ``order``
    (page, then position). ``min`` of a struct led by the order is a partial aggregate, so repeats
    of a key are combined per task before the shuffle."""
    s = _cols(slice_cols)
    others = [c for c in df.columns if c not in (*s, key)]
    first = arg_extreme(order, others, largest=False).alias("_f")
    return df.groupBy(*s, key).agg(first).select(*s, key, *[F.col("_f")[c].alias(c)
                                                            for c in others])


def cutoff_new(cards: DataFrame, slice_cols: Sequence[str], key: str, page: str,
               pos: str, max_pages: int | None = None) -> DataFrame:
    """First-seen cards (L9) on pages before the first page that has no cards or
    no *new* keys and, if one is given, below the page cap.

    Per-page counts are aggregated first; the stop search then runs over one narrow row
    per page, and the stop page is joined back on the slice."""
    s = _cols(slice_cols)
    capped = cards if max_pages is None else cards.filter(F.col(page) < max_pages)
    fresh = first_seen(capped, s, key, [page, pos])
    per_page = (capped.groupBy(*s, page).agg(F.count(F.lit(1)).alias("_n"))
                .join(fresh.groupBy(*s, page).agg(F.count(F.lit(1)).alias("_new")),
                      [*s, page], "left"))
    w = Window.partitionBy(*s).orderBy(page)
    gaps = per_page.select(*s, page, "_new",
                           (F.row_number().over(w) - 1).alias("_expected"))
    stop = gaps.groupBy(*s).agg(F.min(
        F.when(F.col("_new").isNull() | (F.col("_new") == 0), F.col(page))
        .when(F.col(page) != F.col("_expected"), F.col("_expected"))).alias("_stop"))
    return (fresh.join(stop, s, "left")
            .filter(F.col("_stop").isNull() | (F.col(page) < F.col("_stop")))
            .drop("_stop"))


def cap_enrich(cards: DataFrame, details: DataFrame, slice_cols: Sequence[str],
               key: str, order: Sequence[str], n: int = DETAIL_MAX_PER_SLICE,
               enabled: bool = True, status: str = "detail_status") -> DataFrame:
    """The first ``n`` cards of each slice (under ``order``) take their detail
    row; later cards get 'not_fetched_limit'; with the feature off all get
    'disabled'. A failed lookup still uses one of the ``n`` attempts.

    The first ``n`` are found in two levels: by a partial WindowGroupLimit map tasks ship at
    most n rows per slice, the rows of a share (a group of map tasks) are reduced to n, and
    a slice's last window sees at most n rows of each of the ``SHARES`` shares, however
    many tasks the slice is spread over. The flag is then joined back by key."""
    s = _cols(slice_cols)
    if not enabled:
        return cards.withColumn(status, F.lit("disabled"))

    def first_n(df: DataFrame, by: Sequence[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*[F.col(c) for c in order])
        return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")

    shares = (cards.select(*s, key, *[c for c in order if c not in (*s, key)])
              .withColumn("_share", F.pmod(F.spark_partition_id(), F.lit(SHARES))))
    chosen = first_n(first_n(shares, [*s, "_share"]), s).select(*s, key, F.lit(True).alias("_fetch"))
    d = details.withColumnRenamed(status, "_dstatus")
    out = (cards.join(chosen, [*s, key], "left").join(d, [*s, key], "left"))
    return out.withColumn(status, F.when(F.col("_fetch"), F.coalesce(F.col("_dstatus"),
                                                                     F.lit("error")))
                          .otherwise(F.lit("not_fetched_limit"))).drop("_fetch", "_dstatus")


def detail_status(error: Column, http_status: Column, title: Column, url: Column) -> Column:
    """L16: 'error' when the lookup raised, 'http_N' for a non-200 answer, 'captcha'
    when the final URL or the page title says so, else 'ok'."""
    captcha = F.lit(False)
    for m in CAPTCHA_URL_MARKERS:
        captcha = captcha | F.coalesce(F.contains(url, F.lit(m)), F.lit(False))
    captcha = captcha | F.coalesce(F.contains(F.lower(title), F.lit(CAPTCHA_TITLE_MARKER)),
                                   F.lit(False))
    return (F.when(error.isNotNull(), F.lit("error"))
            .when(http_status != 200, F.concat(F.lit("http_"), http_status.cast("string")))
            .when(captcha, F.lit("captcha"))
            .otherwise(F.lit("ok")))


def merge_payload(cards: DataFrame, details: DataFrame, key: Sequence[str],
                  fields: Sequence[str], out: str = "raw_json") -> DataFrame:
    """Card fields overlaid with detail fields of the same name (a detail value
    wins where it is not NULL; a card without details keeps its own values),
    serialised as one JSON object per row. NULL fields are written as ``null``
    (``ignoreNullFields=false``) so every key is present; text is not ASCII-escaped."""
    k = _cols(key)
    c = cards.select(*k, *[F.col(f).alias(f"_c_{f}") for f in fields if f in cards.columns])
    d = details.select(*k, *[F.col(f).alias(f"_d_{f}") for f in fields if f in details.columns])
    j = c.join(d, k, "left")
    merged = {}
    for f in fields:
        parts = [F.col(f"_{side}_{f}") for side in ("d", "c") if f"_{side}_{f}" in j.columns]
        merged[f] = F.coalesce(*parts) if len(parts) > 1 else parts[0]
    return j.select(*k, payload_json(merged).alias(out))


def payload_json(fields: Mapping[str, Column]) -> Column:
    """L17's serialisation: one JSON object with every field as a key, NULL as ``null``."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]),
                     {"ignoreNullFields": "false"})


def ingest_report(rows: DataFrame, grid: DataFrame, slice_cols: Sequence[str],
                  key: str, alias: str = "inserted") -> DataFrame:
    """Rows per slice and the total, every expected slice shown (0 when empty):
    ``GROUPING SETS ((slice...), ())`` over the grid left-joined to per-slice counts.
    Counts ``key`` values (not rows), so the grid's unmatched row counts 0."""
    s = _cols(slice_cols)
    per = rows.groupBy(*s).agg(F.count(key).alias("_n"))
    joined = grid.join(per, s, "left")
    return joined.groupingSets([s, []], *s).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias(alias))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail when ``df`` is empty (one-row probe, not a full count)."""
    if df.limit(1).count() == 0:
        raise RuntimeError(message)
    return df


def stamp(df: DataFrame, snapshot_id: str | None = None, col: str = "snapshot_id") -> DataFrame:
    """One id for the whole batch, fixed on the driver (SQL ``uuid()`` would give
    one per row, and a different one on a task retry)."""
    return df.withColumn(col, F.lit(snapshot_id or str(uuid.uuid4())))
