"""Randomised checks of the trickiest operators against direct Python versions of the
reference's loops and rules (small random inputs, heavy ties and gaps)."""

import datetime as dt

from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidepool.operators import landing as L
from tidepool.operators import metrics as M
from tidepool.operators import silver

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
T0 = dt.datetime(2024, 1, 1)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3), st.integers(0, 2),
                          st.integers(0, 2), st.sampled_from("ab")), min_size=1, max_size=40))
def test_best_row_variants_agree(spark, rows):
    data = [(k, q, l, i, s, n) for n, (k, q, l, i, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, q int, l int, i int, s string, n int")
    order = ["q", "l", "i", "n"]                    # n makes the order total
    want = {}
    for r in data:
        if r[0] not in want or (r[1], r[2], r[3], r[5]) > want[r[0]][0]:
            want[r[0]] = ((r[1], r[2], r[3], r[5]), r[5])
    w1 = {r["k"]: r["n"] for r in silver.best_row(df, ["k"], order).collect()}
    w2 = {r["k"]: (r["n"], r["m"], r["c"]) for r in silver.best_row_fused(
        df, ["k"], order, ["n"], {"m": "s"}, "c").collect()}
    assert w1 == {k: v[1] for k, v in want.items()}
    for k, (n, m, c) in w2.items():
        assert n == want[k][1]
        assert m == sorted({r[4] for r in data if r[0] == k})
        assert c == sum(1 for r in data if r[0] == k)


def api_loop(pages, declared, max_pages):
    kept = []
    for p in range(max_pages):
        if p not in pages:
            break
        n, status = pages[p]
        if status != 200:
            kept.append(p)           # visited; the fallback rule decides what follows
            break
        if not n:
            break
        kept.append(p)
        if p >= declared - 1:
            break
    return kept


@SETTINGS
@given(st.dictionaries(st.integers(0, 7), st.tuples(st.integers(0, 3),
                                                    st.sampled_from([200, 200, 200, 403, 500])),
                       min_size=1),
       st.integers(0, 9), st.integers(1, 6))
def test_page_cutoff_matches_loop(spark, pages, declared, max_pages):
    df = spark.createDataFrame([("s", p, n, declared, st_) for p, (n, st_) in pages.items()],
                               "s string, page int, n int, declared int, status int")
    got = sorted(r["page"] for r in L.page_cutoff(df, ["s"], "page", "n", "declared",
                                                  max_pages, status="status").collect())
    assert got == api_loop(pages, declared, max_pages)


def html_loop(cards, max_pages):
    seen, out = set(), []
    for p in range(max_pages):
        page = sorted(c for c in cards if c[0] == p)
        if not page:
            break
        new = 0
        for _, pos, key in page:
            if key not in seen:
                seen.add(key)
                out.append((p, pos, key))
                new += 1
        if new == 0:
            break
    return sorted(out)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from("abcdef")), min_size=1,
                max_size=30), st.integers(1, 5))
def test_cutoff_new_matches_loop(spark, raw, max_pages):
    cards = [(p, i, k) for i, (p, k) in enumerate(raw)]
    df = spark.createDataFrame([("s", p, pos, k) for p, pos, k in cards],
                               "s string, page int, pos int, k string")
    got = sorted((r["page"], r["pos"], r["k"]) for r in
                 L.cutoff_new(df, ["s"], "k", "page", "pos", max_pages).collect())
    assert got == html_loop(cards, max_pages)


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 5), st.booleans()), min_size=1, max_size=25),
       st.sampled_from([1, 2, 3, 7, 1000]))
def test_sustained_matches_rule(spark, steps, bucket_hours):
    t, rows = 0, []
    for gap, c in steps:
        t += gap
        rows.append(("x", T0 + dt.timedelta(hours=t), c))
    df = spark.createDataFrame(rows, "s string, ts timestamp, c boolean")
    got = {r["ts"]: r["firing"] for r in M.sustained(df, ["s"], "ts", "c", 3 * 3600, 2 * 3600,
                                                     bucket_s=bucket_hours * 3600).collect()}
    start, prev, want = None, None, {}
    for _, ts, c in rows:
        if c and (start is None or prev is None or (ts - prev).total_seconds() > 7200):
            start = ts
        if not c:
            start = None
        want[ts] = bool(c) and (ts - start).total_seconds() >= 3 * 3600
        prev = ts if c else None
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 90), st.integers(-3, 10)), min_size=1, max_size=25),
       st.sampled_from([60, 300, 3600]))
def test_counter_rate_matches_rule(spark, steps, bucket_s):
    t, v, rows = 0, 0, []
    for gap, d in steps:
        t += gap
        v = v + d if v + d >= 0 else 0                 # negative step = counter reset
        rows.append(("x", T0 + dt.timedelta(seconds=t), v))
    df = spark.createDataFrame(rows, "s string, ts timestamp, v long")
    got = {r["ts"]: r["increase"] for r in
           M.counter_rate(df, ["s"], "ts", "v", 120, bucket_s=bucket_s).collect()}
    for i, (_, ts, _) in enumerate(rows):
        window = [r for r in rows if ts - dt.timedelta(seconds=120) < r[1] <= ts]
        if len(window) < 2:
            assert got[ts] is None
            continue
        inc = 0
        for a, b in zip(window, window[1:]):
            inc += b[2] if b[2] < a[2] else b[2] - a[2]
        assert got[ts] == inc


def fallback_loop(statuses, html_rows):
    out = []
    for p in sorted(statuses):
        st_ = statuses[p]
        if st_ != 200:
            if st_ in (401, 403):
                return out + [("html", h) for h in html_rows]
            return []                                   # the slice fails as a whole
        out.append(("api", p))
    return out


@SETTINGS
@given(st.dictionaries(st.integers(0, 6), st.sampled_from([200, 200, 200, 401, 403, 500]),
                       min_size=1), st.lists(st.integers(0, 3), max_size=3, unique=True))
def test_source_fallback_matches_loop(spark, statuses, html_pages):
    # landed pages are contiguous from 0 in this model
    statuses = {i: statuses[p] for i, p in enumerate(sorted(statuses))}
    api = spark.createDataFrame([("s", p, s, "api") for p, s in statuses.items()],
                                "s string, page int, status int, src string")
    html = spark.createDataFrame([("s", p, "html") for p in html_pages] or [("zz", 0, "html")],
                                 "s string, page int, src string")
    got = sorted((r["src"], r["page"]) for r in
                 L.source_fallback(api, html, ["s"], "page", "status").collect())
    assert got == sorted(fallback_loop(statuses, html_pages))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 50), st.integers(0, 9)),
                min_size=1, max_size=30, unique_by=lambda r: (r[0], r[1])),
       st.sampled_from([3, 10, 1000]))
def test_prefix_max_before_matches_scan(spark, rows, bucket):
    df = spark.createDataFrame(rows, "k string, t long, v long").withColumn("o", F.lit(0))
    got = {(r["k"], r["t"]): r["pm"] for r in
           M.prefix_max_before(df, ["k"], "t", ["o"], "v", bucket, "pm").collect()}
    for k, t, _ in rows:
        before = [v for k2, t2, v in rows if k2 == k and t2 < t]
        assert got[(k, t)] == (max(before) if before else None)
