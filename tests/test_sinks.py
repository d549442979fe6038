"""Sinks and landing behaviour: append + read back, retry safety, overwrite, naming,
insert-ignore, guards and stamps."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidepool.operators import landing as L
from tidepool.sources import bronze as B


def batch(spark, n=6, sid="s1"):
    rows = [(sid, "dev", "msk", 0, f"v{i}", '{"title": "t"}') for i in range(n)]
    df = spark.createDataFrame(rows, "snapshot_id string, search_text string, search_area string, "
                                     "page_num int, vacancy_id string, raw_json string")
    return df.withColumn("ingested_at", F.lit(dt.datetime(2024, 3, 5, 12, 0)).cast("timestamp"))


def test_append_and_retry_safe(spark):
    path = tempfile.mkdtemp(prefix="tp-bronze-") + "/bronze"
    keys = ["snapshot_id", "search_text", "search_area", "vacancy_id"]
    B.append_bronze(batch(spark), path, source="test")
    assert os.path.isdir(os.path.join(path, "yyyymm=202403"))
    for _ in range(2):   # a retried batch adds nothing
        stored = B.read_bronze(spark, path)
        fresh = B.anti_append(batch(spark, 8), stored, keys)
        B.append_bronze(fresh, path, source="test")
    back = B.read_bronze(spark, path)
    assert back.count() == 8 and back.select("vacancy_id").distinct().count() == 8
    assert back.select("source").distinct().collect()[0][0] == "test"


def test_write_layer_dynamic_overwrite(spark):
    path = tempfile.mkdtemp(prefix="tp-layer-") + "/t"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "m int, v string")
    B.write_layer(df, path, ["m"], ["v"])
    B.write_layer(spark.createDataFrame([(2, "c")], "m int, v string"), path, ["m"], ["v"],
                  dynamic=True)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("m", "v").collect()) == \
        [(1, "a"), (2, "c")]


def test_layer_names():
    assert B.layer_name(None, "raw") == "raw"
    assert B.layer_name(" silver ", "raw") == "lake_silver"
    assert B.layer_name("gold", "raw") == "lake_gold"
    assert B.layer_name("scratch", "raw") == "raw_scratch"
    assert B.layer_name("gold", "raw", {"gold": "marts"}) == "marts"


def test_insert_ignore_keeps_target_and_first_new(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (2, "b"), (2, "a")], "k int, v string")
    out = sorted(tuple(r) for r in B.insert_ignore(target, new, ["k"], ["v"]).collect())
    assert out == [(1, "old"), (2, "a")]


def test_require_rows_and_stamp(spark):
    empty = spark.createDataFrame([], "a int")
    with pytest.raises(RuntimeError, match="no rows"):
        L.require_rows(empty, "no rows")
    df = L.stamp(spark.range(100).repartition(4))
    assert df.select("snapshot_id").distinct().count() == 1


def test_slice_grid_and_report(spark):
    roles = spark.createDataFrame([("dev",), ("ops",)], "search_text string")
    grid = L.slice_grid(roles, "search_text", ["msk", "spb", "remote"])
    assert grid.count() == 6
    rows = spark.createDataFrame([("dev", "msk", "v1"), ("dev", "msk", "v2")],
                                 "search_text string, search_area string, vacancy_id string")
    rep = {(r[0], r[1]): r[2] for r in L.ingest_report(rows, grid, ["search_text", "search_area"],
                                                        "vacancy_id").collect()}
    assert rep[("dev", "msk")] == 2 and rep[("ops", "remote")] == 0 and rep[(None, None)] == 2
    assert len(rep) == 7


def test_cap_enrich_disabled(spark):
    cards = spark.createDataFrame([("s", "k1", 0)], "s string, k string, p int")
    out = L.cap_enrich(cards, cards.withColumn("detail_status", F.lit("ok")), ["s"], "k", ["p"],
                       enabled=False)
    assert out.first()["detail_status"] == "disabled"
