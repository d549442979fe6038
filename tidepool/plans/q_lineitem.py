"""Snapshot chain on ``lineitem``: completeness, best row, latest version, rollup.

Mapping (see ``tidepool.sources.tables.lineitem_bronze``): snapshot = ship day, slice
= (return flag, line status), key = supplier; the gold array is the words of the
part name of the supplier's latest best row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.format import arr_text, ts_text
from tidepool.operators import gold, quality, silver, snapshots
from tidepool.plans.q_orders import scratch_path
from tidepool.plans.registry import query
from tidepool.sources.bronze import append_bronze, read_bronze
from tidepool.sources.tables import LINEITEM_ORDER, lineitem_bronze, read_table

SLICES = ("search_text", "search_area")
KEYS = ("snapshot_id", "vacancy_id")
SILVER_COLS = ("search_text", "search_area", "page_num", "l_quantity", "ingested_at",
               "l_extendedprice", "l_orderkey", "l_partkey")
SETS = {"matched_roles": "search_text", "matched_areas": "search_area"}
# Fixed pivots of the gold rollup: every return flag and every line status.
PIVOTS = (("role_a_count", "matched_roles", "A"), ("role_n_count", "matched_roles", "N"),
          ("role_r_count", "matched_roles", "R"), ("area_f_count", "matched_areas", "F"),
          ("area_o_count", "matched_areas", "O"))


def bronze(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    return lineitem_bronze(spark, sf_dir, grain)


def complete_rows(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    b = bronze(spark, sf_dir, grain)
    return snapshots.keep_complete(b, snapshots.complete_snapshots(b, slices=SLICES, n=6))


def silver_df(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """F1 -> F2 -> W2: one row per (snapshot, supplier) of complete snapshots."""
    return silver.best_row_fused(complete_rows(spark, sf_dir, grain), KEYS, LINEITEM_ORDER,
                                 SILVER_COLS, SETS)


def approx_verdict(per: DataFrame, approx: str, exact: str, rsd: float) -> DataFrame:
    """One row: groups, whether the mean relative error is within ``rsd``, and whether at
    most 5 % of the groups are off by more than twice ``rsd``."""
    error = F.abs(F.col(approx) - F.col(exact)) / F.col(exact)
    return per.agg(F.count("*").alias("n_groups"), (F.avg(error) <= rsd).alias("mean_within"),
                   (F.avg((error > 2 * rsd).cast("double")) <= 0.05).alias("tail_within"))


def latest_df(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """A3 over silver: the newest silver row per supplier, with its part's name words."""
    latest = gold.latest_per_key(silver_df(spark, sf_dir, grain), "vacancy_id",
                                 ("ingested_at", "snapshot_id"),
                                 ("snapshot_id", "l_partkey", "matched_roles", "matched_areas"))
    part = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.split("p_name", " ").alias("skills"))
    return latest.join(part, "l_partkey", "inner")


def gold_df(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """Skill rollup over the latest version of every supplier."""
    exploded = gold.unnest(latest_df(spark, sf_dir, grain), "skills", "skill")
    return gold.ranked_rollup(exploded, "skill", PIVOTS)


def silver_out(df: DataFrame) -> DataFrame:
    return df.select(*KEYS, "search_text", "search_area", "page_num", "l_quantity",
                     ts_text("ingested_at").alias("ingested_at"), "l_extendedprice",
                     "l_orderkey", "l_partkey",
                     arr_text("matched_roles").alias("matched_roles"),
                     arr_text("matched_areas").alias("matched_areas"), "matched_rows")


# ---------------------------------------------------------------- oracle SQL pieces

B = """b AS (SELECT l_shipdate AS ingested_at,
          strftime(date_trunc('day', l_shipdate), '%Y-%m-%d') AS snapshot_id,
          l_returnflag AS search_text, l_linestatus AS search_area,
          l_linenumber AS page_num, l_suppkey AS vacancy_id,
          l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem)"""
COMPLETE = """complete AS (SELECT snapshot_id FROM b GROUP BY snapshot_id
          HAVING count(DISTINCT search_text || '|' || search_area) = 6)"""
RANKED = """ranked AS (SELECT *, row_number() OVER (PARTITION BY snapshot_id, vacancy_id
          ORDER BY page_num DESC, l_quantity DESC, ingested_at DESC, l_extendedprice DESC,
                   l_orderkey DESC, l_partkey DESC) AS rn
          FROM b WHERE snapshot_id IN (SELECT snapshot_id FROM complete))"""
MATCHED = """matched AS (SELECT snapshot_id, vacancy_id,
          list_sort(list(DISTINCT search_text)) AS matched_roles,
          list_sort(list(DISTINCT search_area)) AS matched_areas,
          count(*) AS matched_rows
          FROM b WHERE snapshot_id IN (SELECT snapshot_id FROM complete)
          GROUP BY snapshot_id, vacancy_id)"""
SILVER = """silver AS (SELECT r.snapshot_id, r.vacancy_id, r.search_text, r.search_area,
          r.page_num, r.l_quantity, r.ingested_at, r.l_extendedprice, r.l_orderkey,
          r.l_partkey, m.matched_roles, m.matched_areas, m.matched_rows
          FROM ranked r LEFT JOIN matched m
            ON r.snapshot_id = m.snapshot_id AND r.vacancy_id = m.vacancy_id
          WHERE r.rn = 1)"""
SILVER_SELECT = """SELECT snapshot_id, vacancy_id, search_text, search_area, page_num,
          l_quantity, strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at,
          l_extendedprice, l_orderkey, l_partkey,
          array_to_string(matched_roles, ',') AS matched_roles,
          array_to_string(matched_areas, ',') AS matched_areas, matched_rows FROM silver"""
LATEST = """latest AS (SELECT s.vacancy_id, s.snapshot_id, s.l_partkey, s.matched_roles,
          s.matched_areas, string_split(p.p_name, ' ') AS skills
          FROM (SELECT *, row_number() OVER (PARTITION BY vacancy_id
                ORDER BY ingested_at DESC, snapshot_id DESC) AS rn2 FROM silver) s
          JOIN part p ON p.p_partkey = s.l_partkey WHERE s.rn2 = 1)"""
EXPLODED = """exploded AS (SELECT * FROM (SELECT vacancy_id, matched_roles, matched_areas,
          unnest(skills) AS skill FROM latest) WHERE skill <> '')"""
GOLD = """gold AS (SELECT skill, count(*) AS vacancies_count,
          count(*) FILTER (WHERE list_contains(matched_roles, 'A')) AS role_a_count,
          count(*) FILTER (WHERE list_contains(matched_roles, 'N')) AS role_n_count,
          count(*) FILTER (WHERE list_contains(matched_roles, 'R')) AS role_r_count,
          count(*) FILTER (WHERE list_contains(matched_areas, 'F')) AS area_f_count,
          count(*) FILTER (WHERE list_contains(matched_areas, 'O')) AS area_o_count
          FROM exploded GROUP BY skill)"""


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CHAIN = (B, COMPLETE, RANKED, MATCHED, SILVER)

# ---------------------------------------------------------------- queries


@query("s1_bronze_scan", w(B) + """
SELECT strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at, snapshot_id, search_text,
       search_area, page_num, vacancy_id, l_orderkey, l_partkey FROM b""")
def s1_bronze_scan(spark, sf):
    """Rows landed in a bronze table and scanned again through its fixed schema."""
    b = bronze(spark, sf)
    payload = "l_orderkey long, l_partkey long"
    path = scratch_path(spark, "bronze_lineitem")
    append_bronze(b.select("ingested_at", "snapshot_id", *SLICES, "page_num",
                           F.col("vacancy_id").cast("string"),
                           F.to_json(F.struct("l_orderkey", "l_partkey")).alias("raw_json")),
                  path, source="lineitem")
    back = read_bronze(spark, path).withColumn("_p", F.from_json("raw_json", payload))
    return back.select(ts_text("ingested_at").alias("ingested_at"), "snapshot_id", *SLICES,
                       "page_num", F.col("vacancy_id").cast(b.schema["vacancy_id"].dataType), "_p.*")


@query("f1_complete_snapshots", w(B) + """
SELECT snapshot_id, count(DISTINCT search_text || '|' || search_area) AS n_slices
FROM b GROUP BY snapshot_id HAVING n_slices = 6""")
def f1_complete_snapshots(spark, sf):
    return snapshots.complete_snapshots(bronze(spark, sf), slices=SLICES, n=6)


@query("f2_semi_complete", w(B, COMPLETE) + """
SELECT snapshot_id, vacancy_id, search_text, search_area, page_num, l_orderkey, l_partkey
FROM b WHERE snapshot_id IN (SELECT snapshot_id FROM complete)""")
def f2_semi_complete(spark, sf):
    return complete_rows(spark, sf).select("snapshot_id", "vacancy_id", *SLICES, "page_num",
                                           "l_orderkey", "l_partkey")


LATEST_COMPLETE = """lc AS (SELECT snapshot_id, n_slices, max_ts FROM (
          SELECT snapshot_id, count(DISTINCT search_text || '|' || search_area) AS n_slices,
                 max(ingested_at) AS max_ts FROM b GROUP BY snapshot_id)
          WHERE n_slices = 6 ORDER BY max_ts DESC, snapshot_id DESC LIMIT 1)"""


@query("f3_latest_complete", w(B, LATEST_COMPLETE) + """
SELECT snapshot_id, n_slices, strftime(max_ts, '%Y-%m-%d %H:%M:%S') AS max_ts FROM lc""")
def f3_latest_complete(spark, sf):
    lc = snapshots.latest_complete(bronze(spark, sf), slices=SLICES, n=6)
    return lc.select("snapshot_id", "n_slices", ts_text("max_ts").alias("max_ts"))


SNAP_ROWS_SQL = """
SELECT snapshot_id, vacancy_id, search_text, search_area, page_num, l_orderkey, l_partkey
FROM b WHERE snapshot_id = (SELECT snapshot_id FROM lc)"""


@query("f4_snapshot_filter", w(B, LATEST_COMPLETE) + SNAP_ROWS_SQL)
def f4_snapshot_filter(spark, sf):
    b = bronze(spark, sf)
    sid = snapshots.latest_complete_id(b, slices=SLICES, n=6)
    return snapshots.for_snapshot(b, sid).select("snapshot_id", "vacancy_id", *SLICES,
                                                 "page_num", "l_orderkey", "l_partkey")


@query("f5_scalar_where", w(B, LATEST_COMPLETE) + SNAP_ROWS_SQL)
def f5_scalar_where(spark, sf):
    b = bronze(spark, sf)
    return snapshots.where_latest(b, b, slices=SLICES, n=6).select(
        "snapshot_id", "vacancy_id", *SLICES, "page_num", "l_orderkey", "l_partkey")


@query("a2_exact_distinct", w(B) + """
SELECT snapshot_id, count(DISTINCT vacancy_id) AS n_distinct FROM b GROUP BY snapshot_id""")
def a2_exact_distinct(spark, sf):
    return snapshots.distinct_per_snapshot(bronze(spark, sf), "vacancy_id")


@query("a4_approx_distinct", w(B) + """
SELECT count(DISTINCT snapshot_id) AS n_groups, true AS mean_within, true AS tail_within FROM b""")
def a4_approx_distinct(spark, sf):
    """Approximate distinct parts per snapshot (HyperLogLog++) held against the exact count:
    the relative standard deviation of 5 % bounds the mean error over all snapshots, and at
    most 5 % of them are off by more than twice that."""
    per = bronze(spark, sf).groupBy("snapshot_id").agg(
        F.approx_count_distinct("l_partkey").alias("approx"),
        F.count_distinct("l_partkey").alias("exact"))
    return approx_verdict(per, "approx", "exact", 0.05)


@query("d1_source_not_null", w(B) + """
SELECT count(*) FILTER (WHERE ingested_at IS NULL) AS not_null__ingested_at,
       count(*) FILTER (WHERE snapshot_id IS NULL) AS not_null__snapshot_id,
       count(*) FILTER (WHERE search_text IS NULL) AS not_null__search_text,
       count(*) FILTER (WHERE search_area IS NULL) AS not_null__search_area,
       count(*) FILTER (WHERE vacancy_id IS NULL) AS not_null__vacancy_id,
       count(*) FILTER (WHERE l_orderkey IS NULL) AS not_null__l_orderkey
FROM b""")
def d1_source_not_null(spark, sf):
    """D1 on every row of the source: one count of failing rows per column."""
    return quality.check_counts(bronze(spark, sf), ["ingested_at", "snapshot_id", "search_text", "search_area", "vacancy_id", "l_orderkey"])


@query("a9_snapshot_stats", w(B, LATEST_COMPLETE) + """
SELECT count(DISTINCT search_text || '|' || search_area) AS combos, count(*) AS rows,
       count(DISTINCT vacancy_id) AS unique_keys,
       strftime(min(ingested_at), '%Y-%m-%d %H:%M:%S') AS first_row,
       strftime(max(ingested_at), '%Y-%m-%d %H:%M:%S') AS last_row
FROM b WHERE snapshot_id = (SELECT snapshot_id FROM lc)""")
def a9_snapshot_stats(spark, sf):
    b = bronze(spark, sf)
    st = snapshots.snapshot_stats(snapshots.where_latest(b, b, slices=SLICES, n=6),
                                  slices=SLICES, key="vacancy_id")
    return st.select("combos", "rows", "unique_keys", ts_text("first_row").alias("first_row"),
                     ts_text("last_row").alias("last_row"))


@query("a11_table_stats", w(B) + """
SELECT count(*) AS rows, count(DISTINCT snapshot_id) AS snapshots,
       strftime(max(ingested_at), '%Y-%m-%d %H:%M:%S') AS max_ts FROM b""")
def a11_table_stats(spark, sf):
    st = snapshots.table_stats(bronze(spark, sf))
    return st.select("rows", "snapshots", ts_text("max_ts").alias("max_ts"))


@query("a12_snapshot_history", w(B) + """
SELECT snapshot_id, n_slices, strftime(max_ts, '%Y-%m-%d %H:%M:%S') AS max_ts FROM (
  SELECT snapshot_id, count(DISTINCT search_text || '|' || search_area) AS n_slices,
         max(ingested_at) AS max_ts FROM b GROUP BY snapshot_id)
ORDER BY max_ts DESC, snapshot_id DESC LIMIT 3""")
def a12_snapshot_history(spark, sf):
    h = snapshots.snapshot_history(bronze(spark, sf), n=3, slices=SLICES)
    return h.select("snapshot_id", "n_slices", ts_text("max_ts").alias("max_ts"))


@query("a15_distinct_keys", w(B) + """
SELECT DISTINCT snapshot_id, search_text, search_area, vacancy_id FROM b""")
def a15_distinct_keys(spark, sf):
    return quality.distinct_keys(bronze(spark, sf),
                                 ["snapshot_id", *SLICES, "vacancy_id"])


@query("w1_best_row", w(*CHAIN) + """
SELECT snapshot_id, vacancy_id, search_text, search_area, page_num, l_quantity,
       strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at, l_extendedprice,
       l_orderkey, l_partkey FROM ranked WHERE rn = 1""")
def w1_best_row(spark, sf):
    best = silver.best_row(complete_rows(spark, sf), KEYS, LINEITEM_ORDER, SILVER_COLS)
    return best.select(*KEYS, *SLICES, "page_num", "l_quantity",
                       ts_text("ingested_at").alias("ingested_at"), "l_extendedprice",
                       "l_orderkey", "l_partkey")


@query("w2_best_row_fused", w(*CHAIN) + SILVER_SELECT)
def w2_best_row_fused(spark, sf):
    return silver_out(silver_df(spark, sf))


@query("j1_best_with_matches", w(*CHAIN) + SILVER_SELECT)
def j1_best_with_matches(spark, sf):
    return silver_out(silver.best_with_matches(complete_rows(spark, sf), KEYS, LINEITEM_ORDER,
                                               SILVER_COLS, SETS))


@query("a1_matched_sets", w(B, COMPLETE, MATCHED) + """
SELECT snapshot_id, vacancy_id, array_to_string(matched_roles, ',') AS matched_roles,
       array_to_string(matched_areas, ',') AS matched_areas, matched_rows FROM matched""")
def a1_matched_sets(spark, sf):
    m = silver.matched(complete_rows(spark, sf), KEYS, SETS)
    return m.select(*KEYS, arr_text("matched_roles").alias("matched_roles"),
                    arr_text("matched_areas").alias("matched_areas"), "matched_rows")


LATEST_SELECT = """
SELECT vacancy_id, snapshot_id, l_partkey, array_to_string(matched_roles, ',') AS matched_roles,
       array_to_string(matched_areas, ',') AS matched_areas FROM latest"""


@query("a3_arg_max", w(*CHAIN, LATEST) + LATEST_SELECT)
def a3_arg_max(spark, sf):
    return latest_df(spark, sf).select(
        "vacancy_id", "snapshot_id", "l_partkey",
        arr_text("matched_roles").alias("matched_roles"),
        arr_text("matched_areas").alias("matched_areas"))


@query("w3_latest_version", w(*CHAIN) + """
SELECT vacancy_id, snapshot_id, page_num, l_orderkey, l_partkey,
       strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at FROM (
  SELECT *, row_number() OVER (PARTITION BY vacancy_id
         ORDER BY ingested_at DESC, snapshot_id DESC) AS rn2 FROM silver) WHERE rn2 = 1""")
def w3_latest_version(spark, sf):
    lat = gold.latest_per_key(silver_df(spark, sf), "vacancy_id",
                              ("ingested_at", "snapshot_id"),
                              ("snapshot_id", "page_num", "l_orderkey", "l_partkey",
                               "ingested_at"))
    return lat.select("vacancy_id", "snapshot_id", "page_num", "l_orderkey", "l_partkey",
                      ts_text("ingested_at").alias("ingested_at"))


@query("a5_array_unnest", w(*CHAIN, LATEST, EXPLODED) + """
SELECT vacancy_id, skill FROM exploded""")
def a5_array_unnest(spark, sf):
    return gold.unnest(latest_df(spark, sf), "skills", "skill").select("vacancy_id", "skill")


@query("a6_conditional_count", w(*CHAIN) + """
SELECT snapshot_id,
       count(*) FILTER (WHERE list_contains(matched_roles, 'A')) AS role_a_count,
       count(*) FILTER (WHERE list_contains(matched_areas, 'O')) AS area_o_count,
       count(*) FILTER (WHERE matched_rows > 1) AS repeated_count
FROM silver GROUP BY snapshot_id""")
def a6_conditional_count(spark, sf):
    return silver_df(spark, sf).groupBy("snapshot_id").agg(
        gold.count_if_contains("matched_roles", "A").alias("role_a_count"),
        gold.count_if_contains("matched_areas", "O").alias("area_o_count"),
        F.count_if(F.col("matched_rows") > 1).alias("repeated_count"))


@query("a7_skills_top", w(*CHAIN, LATEST, EXPLODED, GOLD) + "SELECT * FROM gold")
def a7_skills_top(spark, sf):
    return gold_df(spark, sf)


@query("o1_top_k", w(*CHAIN, LATEST, EXPLODED, GOLD) + """
SELECT * FROM gold ORDER BY vacancies_count DESC, skill ASC LIMIT 20""")
def o1_top_k(spark, sf):
    return gold.top_k(gold_df(spark, sf), ["vacancies_count"], 20, ["skill"])


@query("d3_unique_combination", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def d3_unique_combination(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return quality.unique_violations(li, ["l_orderkey", "l_linenumber"])


@query("d6_bronze_gate", w(B, LATEST_COMPLETE) + """
SELECT snapshot_id, count(DISTINCT search_text || '|' || search_area) AS combos,
       count(*) AS rows, count(DISTINCT vacancy_id) AS unique_keys,
       strftime(min(ingested_at), '%Y-%m-%d %H:%M:%S') AS first_row,
       strftime(max(ingested_at), '%Y-%m-%d %H:%M:%S') AS last_row
FROM b WHERE snapshot_id = (SELECT snapshot_id FROM lc) GROUP BY snapshot_id""")
def d6_bronze_gate(spark, sf):
    """The gate picks the latest complete snapshot, checks it and returns its stats."""
    stats = quality.bronze_gate(bronze(spark, sf), snapshot=None, slices=SLICES, n=6,
                                key="vacancy_id")
    return spark.createDataFrame([stats.as_row()], quality.BRONZE_STATS_SCHEMA)


@query("d7_silver_gate", w(*CHAIN, LATEST_COMPLETE) + """
SELECT count(*) AS silver_rows, count(DISTINCT (snapshot_id, vacancy_id)) AS unique_keys,
       count(*) FILTER (WHERE search_text = 'A') AS flag_a, count(*) FILTER (WHERE search_area = 'O') AS status_o,
       count(*) FILTER (WHERE matched_rows > 1) AS repeated, count(*) FILTER (WHERE len(matched_roles) > 1) AS multi_role,
       CAST(round_even(avg(page_num), 0) AS DOUBLE) AS avg_page
FROM silver WHERE snapshot_id = (SELECT snapshot_id FROM lc)""")
def d7_silver_gate(spark, sf):
    b = bronze(spark, sf)
    sid = snapshots.latest_complete_id(b, slices=SLICES, n=6)
    s = silver_df(spark, sf)
    st = quality.silver_gate(
        s, sid, keys=KEYS,
        counts={"flag_a": F.col("search_text") == "A", "status_o": F.col("search_area") == "O",
                "repeated": F.col("matched_rows") > 1,
                "multi_role": F.size("matched_roles") > 1},
        mean_of="page_num", mean_alias="avg_page")
    return st


@query("d8_grain_check", w(*CHAIN) + """
SELECT count(*) AS rows, count(DISTINCT (snapshot_id, vacancy_id)) AS unique_keys FROM silver""")
def d8_grain_check(spark, sf):
    return quality.grain(silver_df(spark, sf), KEYS)


@query("d9_partial_leak", w(*CHAIN) + """
SELECT count(*) AS partial_rows FROM silver
WHERE snapshot_id NOT IN (SELECT snapshot_id FROM complete)""")
def d9_partial_leak(spark, sf):
    b = bronze(spark, sf)
    return quality.partial_rows(silver_df(spark, sf),
                                snapshots.complete_snapshots(b, slices=SLICES, n=6))
