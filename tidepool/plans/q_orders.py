"""Sinks, joins, checks and reports over ``orders`` / ``customer`` / ``region``
(S2-S4, S7, L1, L2, L17, L18, D1, D2, D4, D5, A8, O3, O4, T13, T14)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import payload as P
from tidepool.functions import text as X
from tidepool.operators import landing as L
from tidepool.operators import quality
from tidepool.plans.registry import query
from tidepool.session import ensure_checkpoint_dir
from tidepool.sources import bronze as B
from tidepool.sources.tables import read_table


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's reliable checkpoint location (shared storage
    on a cluster), for tables a query writes and reads back."""
    base = ensure_checkpoint_dir(spark) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    return f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def order_regions(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    c = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                                 F.col("c_nationkey").alias("n_nationkey"))
    n = read_table(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
    r = read_table(spark, sf, "region")
    return o.join(c, "o_custkey").join(n, "n_nationkey").join(r, "r_regionkey")


# Statuses expected per region; 'X' never occurs, so its slices report 0.
STATUSES = ("F", "O", "P", "X")


@query("l18_ingest_report", """
WITH rows AS (SELECT r.r_name, o.o_orderstatus, o.o_orderkey FROM orders o
              JOIN customer c ON c.c_custkey = o.o_custkey
              JOIN nation n ON n.n_nationkey = c.c_nationkey
              JOIN region r ON r.r_regionkey = n.n_regionkey),
grid AS (SELECT r_name, s.o_orderstatus FROM region,
         (VALUES ('F'), ('O'), ('P'), ('X')) s(o_orderstatus)),
per AS (SELECT r_name, o_orderstatus, count(o_orderkey) AS n FROM rows GROUP BY ALL)
SELECT g.r_name, g.o_orderstatus, CAST(coalesce(sum(per.n), 0) AS BIGINT) AS inserted
FROM grid g LEFT JOIN per USING (r_name, o_orderstatus)
GROUP BY GROUPING SETS ((g.r_name, g.o_orderstatus), ())""")
def l18_ingest_report(spark, sf):
    rows = order_regions(spark, sf).select("r_name", "o_orderstatus", "o_orderkey")
    grid = L.slice_grid(read_table(spark, sf, "region"), "r_name", STATUSES, "o_orderstatus")
    return L.ingest_report(rows, grid, ["r_name", "o_orderstatus"], "o_orderkey")


def order_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Landed API pages: orders in pages of at most 100 consecutive order keys, one
    JSON response per page with its items in key order (pending orders carry no id)."""
    o = read_table(spark, sf, "orders")
    items = F.array_sort(F.collect_list(F.struct(
        F.col("o_orderkey").alias("k"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("id"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))))
    pages = o.groupBy(F.floor(F.col("o_orderkey") / 100).alias("page")).agg(items.alias("it"))
    body = F.to_json(F.struct(
        F.transform("it", lambda x: F.struct(x["id"].alias("id"), x["status"].alias("status"),
                                             x["price"].alias("price"))).alias("items"),
        F.size("it").alias("found")))
    return pages.select("page", body.alias("response"))


@query("l2_api_flatten", """
SELECT o_orderkey // 100 AS page,
       row_number() OVER (PARTITION BY o_orderkey // 100 ORDER BY o_orderkey) - 1 AS pos,
       CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS item_id,
       o_orderstatus AS status, o_totalprice AS price FROM orders""")
def l2_api_flatten(spark, sf):
    flat = L.flatten_items(order_responses(spark, sf), "response", ["page"])
    v = P.parse(F.col("item_json"))
    return flat.select("page", F.col("pos").cast("long").alias("pos"), "item_id",
                       P.json_str(v, "$.status").alias("status"),
                       F.try_variant_get(v, "$.price", "double").alias("price"))


@query("l17_payload_merge", """
WITH d AS (SELECT o_custkey AS c_custkey, round(sum(o_totalprice), 2) AS c_acctbal,
                  count(*) AS n_orders FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
SELECT c.c_custkey, c.c_name AS name, coalesce(d.c_acctbal, round(c.c_acctbal, 2)) AS acctbal,
       c.c_mktsegment AS segment, d.n_orders AS n_orders, d.n_orders IS NULL AS null_kept
FROM customer c LEFT JOIN d USING (c_custkey)""")
def l17_payload_merge(spark, sf):
    cust = read_table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.round("c_acctbal", 2).alias("c_acctbal"), "c_mktsegment",
        F.lit(None).cast("long").alias("n_orders"))
    det = (read_table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
           .groupBy(F.col("o_custkey").alias("c_custkey"))
           .agg(F.round(F.sum("o_totalprice"), 2).alias("c_acctbal"),
                F.count(F.lit(1)).alias("n_orders")))
    merged = L.merge_payload(cust, det, ["c_custkey"],
                             ["c_name", "c_acctbal", "c_mktsegment", "n_orders"])
    v = P.parse(F.col("raw_json"))
    return merged.select("c_custkey", P.json_str(v, "$.c_name").alias("name"),
                         F.try_variant_get(v, "$.c_acctbal", "double").alias("acctbal"),
                         P.json_str(v, "$.c_mktsegment").alias("segment"),
                         P.json_long(v, "$.n_orders").alias("n_orders"),
                         (P.json_type(v, "$.n_orders") == "VOID").alias("null_kept"))


@query("s3_retry_safe_append", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM orders e WHERE e.o_orderstatus = 'F'
                  AND e.o_orderkey = o.o_orderkey)""")
def s3_retry_safe_append(spark, sf):
    """New batch = all orders; already stored = the finished ones."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return B.anti_append(o, o.filter(F.col("o_orderstatus") == "F"), ["o_orderkey"])


@query("s7_insert_ignore", """
WITH t AS (SELECT c_custkey, lower(c_name) AS c_name, c_acctbal FROM customer
           WHERE c_mktsegment = 'BUILDING'),
n AS (SELECT c_custkey, c_name, c_acctbal FROM customer
      UNION ALL SELECT c_custkey, c_name, c_acctbal + 1 FROM customer),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY c_acctbal) AS rn
                     FROM n) WHERE rn = 1)
SELECT * FROM t
UNION ALL
SELECT c_custkey, c_name, c_acctbal FROM f WHERE c_custkey NOT IN (SELECT c_custkey FROM t)""")
def s7_insert_ignore(spark, sf):
    c = read_table(spark, sf, "customer")
    target = c.filter(F.col("c_mktsegment") == "BUILDING").select(
        "c_custkey", F.lower("c_name").alias("c_name"), "c_acctbal")
    base = c.select("c_custkey", "c_name", "c_acctbal")
    new = base.unionByName(base.withColumn("c_acctbal", F.col("c_acctbal") + 1))
    return B.insert_ignore(target, new, ["c_custkey"], ["c_acctbal"])


@query("d1_not_null", """
SELECT count(*) FILTER (WHERE l.quality IS NULL) AS not_null__quality, count(*) FILTER (WHERE l.toxic IS NULL) AS not_null__toxic,
       count(*) FILTER (WHERE d.text IS NULL) AS not_null__text,
       count(*) FILTER (WHERE d.lang NOT IN ('en', 'fr', 'de', 'es')) AS accepted__lang
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def d1_not_null(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "text", "lang")
    j = d.join(read_table(spark, sf, "labels"), "doc_id", "left")
    return quality.check_counts(j, ["quality", "toxic", "text"],
                                {"lang": ["en", "fr", "de", "es"]})


@query("d2_accepted_values", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')""")
def d2_accepted_values(spark, sf):
    o = read_table(spark, sf, "orders")
    return quality.accepted_values(o, "o_orderstatus", ["F", "O"]).select("o_orderkey",
                                                                          "o_orderstatus")


@query("d4_foreign_key", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
WHERE l_orderkey IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F' AND o.o_orderkey = l.l_orderkey)""")
def d4_foreign_key(spark, sf):
    """Orphans of lineitem against a parent load holding only finished orders."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parent = read_table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    return quality.orphans(li, parent, "l_orderkey", "o_orderkey")


@query("d5_unique_key", """
SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY o_custkey HAVING count(*) > 1""")
def d5_unique_key(spark, sf):
    return quality.unique_violations(read_table(spark, sf, "orders"), ["o_custkey"])


@query("a8_group_count", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL""")
def a8_group_count(spark, sf):
    return (read_table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority")
            .agg(F.count(F.lit(1)).alias("n")))


@query("o3_order_by_many", """
SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL ORDER BY 1, 2""")
def o3_order_by_many(spark, sf):
    return (read_table(spark, sf, "orders").groupBy("o_orderpriority", "o_orderstatus")
            .agg(F.count(F.lit(1)).alias("n")).orderBy("o_orderpriority", "o_orderstatus"))


@query("o4_union_sources", """
SELECT o_orderkey, 'api' AS src FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, 'html' AS src FROM orders WHERE o_orderstatus = 'P'""")
def o4_union_sources(spark, sf):
    o = read_table(spark, sf, "orders")
    api = o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", F.lit("api").alias("src"))
    html = o.filter(F.col("o_orderstatus") == "P").select("o_orderkey", F.lit("html").alias("src"))
    return api.unionByName(html)


@query("t13_month_key", """
SELECT CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month_key, count(*) AS n
FROM orders GROUP BY 1""")
def t13_month_key(spark, sf):
    o = read_table(spark, sf, "orders")
    return o.groupBy(X.month_key("o_orderdate").alias("month_key")).agg(
        F.count(F.lit(1)).alias("n"))


@query("t14_concat_key", """
SELECT concat_ws('|', l_returnflag, l_linestatus) AS slice_key, count(*) AS n
FROM lineitem GROUP BY 1""")
def t14_concat_key(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.groupBy(X.concat_key("l_returnflag", "l_linestatus").alias("slice_key")).agg(
        F.count(F.lit(1)).alias("n"))


@query("s2_bronze_append", """
SELECT CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS yyyymm, count(*) AS n,
       count(DISTINCT o_orderkey) AS n_keys FROM orders GROUP BY 1""")
def s2_bronze_append(spark, sf):
    """Orders landed as bronze rows (ingest time = order date) in two appends, read
    back through the explicit bronze schema with month partitions."""
    o = read_table(spark, sf, "orders")
    rows = o.select(F.col("o_orderdate").cast("timestamp").alias("ingested_at"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("snapshot_id"),
                    F.col("o_orderstatus").alias("search_text"),
                    F.col("o_orderpriority").alias("search_area"),
                    F.lit(0).alias("page_num"),
                    F.col("o_orderkey").cast("string").alias("vacancy_id"),
                    F.to_json(F.struct("o_custkey", "o_totalprice")).alias("raw_json"))
    path = scratch_path(spark, "bronze_orders")
    B.append_bronze(rows.filter(F.col("search_text") == "F"), path, source="orders")
    B.append_bronze(rows.filter(F.col("search_text") != "F"), path, source="orders")
    back = B.read_bronze(spark, path, columns=[*B.BRONZE_COLUMNS, B.PARTITION_COL])
    return back.groupBy(B.PARTITION_COL).agg(F.count(F.lit(1)).alias("n"),
                                             F.count_distinct("vacancy_id").alias("n_keys"))


@query("s4_table_overwrite", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL""")
def s4_table_overwrite(spark, sf):
    """A layer table rebuilt twice (the second overwrite replaces the first), with
    partition and sort layout, then read back."""
    agg = (read_table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority")
           .agg(F.count(F.lit(1)).alias("n")))
    path = scratch_path(spark, "gold_orders")
    B.write_layer(agg.withColumn("n", F.col("n") * 0), path, ["o_orderstatus"], ["n"])
    B.write_layer(agg, path, ["o_orderstatus"], ["n"])
    return spark.read.parquet(path).select("o_orderstatus", "o_orderpriority", "n")


# Fixed parameter: the expected regions of the slice grid.
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


@query("l1_slice_grid", """
SELECT s.o_orderstatus, r.r_name FROM (SELECT DISTINCT o_orderstatus FROM orders) s,
  (VALUES ('AFRICA'), ('AMERICA'), ('ASIA'), ('EUROPE'), ('MIDDLE EAST')) r(r_name)""")
def l1_slice_grid(spark, sf):
    """Expected slices: every order status present in the data x every region of the
    parameter list (a generator over the list, not a join)."""
    statuses = read_table(spark, sf, "orders").select("o_orderstatus")
    return L.slice_grid(statuses, "o_orderstatus", REGIONS, "r_name")


@query("s8_employer_landing", """
SELECT CAST(s_suppkey AS VARCHAR) AS employer_id, s_name AS name, s_nationkey AS nation,
       CAST(1 AS BIGINT) AS n_rows FROM supplier""")
def s8_employer_landing(spark, sf):
    """The second raw table (keyed by employer): suppliers landed as employer payloads
    under one batch id, appended twice through the retry-safe path (the second append
    adds nothing), read back and parsed."""
    sup = read_table(spark, sf, "supplier")
    batch = L.stamp(sup.select(
        F.col("s_suppkey").cast("string").alias("employer_id"),
        F.to_json(F.struct("s_name", "s_nationkey", "s_acctbal")).alias("raw_json"),
        F.to_timestamp(F.lit("2024-06-01 00:00:00")).alias("ingested_at")))
    path = scratch_path(spark, "bronze_employers")
    keys = ["snapshot_id", "employer_id"]
    opts = dict(source="employers", sort=keys, columns=B.EMPLOYER_COLUMNS)
    B.append_bronze(batch, path, **opts)
    # the same batch landing again (a retried task) goes through the retry-safe path
    B.append_bronze(B.anti_append(batch, spark.read.parquet(path), keys), path, **opts)
    back = spark.read.parquet(path)
    v = P.parse(F.col("raw_json"))
    return back.groupBy("employer_id").agg(
        F.first(P.json_str(v, "$.s_name")).alias("name"),
        F.first(P.json_long(v, "$.s_nationkey")).cast("int").alias("nation"),
        F.count(F.lit(1)).alias("n_rows"))
