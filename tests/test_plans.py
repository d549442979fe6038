"""Plan-shape regressions: the properties the scale design relies on, read from the
physical plans."""

import re

import pytest

from tests.conftest import SF01
from tidepool.operators import silver
from tidepool.plans import q_lineitem as Q
from tidepool.plans.registry import QUERIES, load_all

load_all()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hash_exchanges(p: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", p))


def test_fused_silver_is_one_hash_exchange(spark):
    cr = Q.complete_rows(spark, SF01)
    p = plan(silver.best_row_fused(cr, Q.KEYS, Q.LINEITEM_ORDER, Q.SILVER_COLS, Q.SETS))
    assert hash_exchanges(p) == 1
    assert "BroadcastHashJoin" in p and "LeftSemi" in p      # completeness gate, no shuffle
    assert "SortAggregate" not in p                           # wide rows are never sorted


def test_window_best_row_limits_before_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["w1_best_row"](spark, SF01))
    assert "WindowGroupLimit" in plan(QUERIES["l15_detail_cap"](spark, SF01))


def test_flagship_scan_is_pruned(spark):
    p = plan(QUERIES["a7_skills_top"](spark, SF01))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    lineitem = [s for s in schemas if "l_suppkey" in s]
    assert lineitem and all("l_discount" not in s and "l_tax" not in s for s in lineitem)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_batch_queries(spark, name):
    p = plan(QUERIES[name](spark, SF01))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", p)


def test_snapshot_filter_reaches_parquet_scan(spark):
    import tempfile
    from pyspark.sql import functions as F
    from tidepool.operators import snapshots
    from tidepool.sources import bronze as B
    path = tempfile.mkdtemp(prefix="tp-push-") + "/bronze"
    rows = spark.range(100).select(
        F.lit("2024-03-05 10:00:00").cast("timestamp").alias("ingested_at"),
        F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("snapshot_id"),
        F.lit("dev").alias("search_text"), F.lit("msk").alias("search_area"),
        F.lit(0).alias("page_num"), F.col("id").cast("string").alias("vacancy_id"),
        F.lit("{}").alias("raw_json"))
    B.append_bronze(rows, path)
    bronze = B.read_bronze(spark, path, columns=[*B.BRONZE_COLUMNS, B.PARTITION_COL])
    q = snapshots.for_snapshot(bronze, "s1").filter(F.col(B.PARTITION_COL) == 202403)
    p = plan(q)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(snapshot_id,s1\)", p)
    assert re.search(r"PartitionFilters: \[[^\]]*yyyymm", p)
    assert q.count() == 33


def test_input_spreading_is_off_unless_asked_for(spark):
    from tidepool.sources.tables import read_table
    key = "spark.tidepool.minInputPartitions"
    asked = spark.conf.get(key)
    assert read_table(spark, SF01, "lineitem").rdd.getNumPartitions() == int(asked) == 8
    spark.conf.unset(key)
    try:
        spark.conf.set(key, "0")
        assert read_table(spark, SF01, "lineitem").rdd.getNumPartitions() == 1
    finally:
        spark.conf.set(key, asked)


def test_one_snapshot_batch_is_written_by_many_tasks(spark):
    import glob
    import tempfile
    from pyspark.sql import functions as F
    from tidepool.sources import bronze as B
    path = tempfile.mkdtemp(prefix="tp-append-") + "/bronze"
    rows = spark.range(4000).select(
        F.lit("2024-03-05 10:00:00").cast("timestamp").alias("ingested_at"),
        F.lit("s1").alias("snapshot_id"), F.lit("dev").alias("search_text"),
        F.lit("msk").alias("search_area"), F.lit(0).alias("page_num"),
        F.col("id").cast("string").alias("vacancy_id"), F.lit("{}").alias("raw_json"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        B.append_bronze(rows, path)
    finally:
        spark.conf.set(key, "true")
    assert len(glob.glob(path + "/*/*.parquet")) == int(spark.conf.get("spark.sql.shuffle.partitions"))
