"""Streaming variants: incremental bronze -> silver and the stateful sustained rule."""

import datetime as dt
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from tidepool.operators import metrics as M
from tidepool.sources import bronze as B
from tidepool.streaming import bronze_stream, metrics_stream


def landed(spark, sid, slices, hour):
    rows = []
    for i, (r, a) in enumerate(slices):
        for v in ("v1", "v2"):
            payload = {"source_mode": "html_fallback", "detail_status": "ok" if a == "msk" else "captcha",
                       "title": f"{v}-{r}", "description": "x" * (i + 1), "skills": ["k8s", r]}
            rows.append((dt.datetime(2024, 5, 1, hour), sid, "test", r, a, 0, v,
                         json.dumps(payload)))
    return spark.createDataFrame(rows, B.BRONZE_SCHEMA)


def test_incremental_silver(spark):
    root = tempfile.mkdtemp(prefix="tp-stream-")
    grid = [(r, a) for r in ("dev", "ops") for a in ("msk", "spb", "remote")]
    landed(spark, "s1", grid, 1).write.parquet(f"{root}/landing/b1")
    landed(spark, "s2", grid[:5], 2).write.parquet(f"{root}/landing/b2")
    q = bronze_stream.start_incremental(spark, f"{root}/landing", f"{root}/bronze",
                                        f"{root}/silver", f"{root}/ckpt")
    q.awaitTermination()
    # the same files landing again (a replay) add nothing
    landed(spark, "s1", grid, 1).write.parquet(f"{root}/landing/b3")
    q = bronze_stream.start_incremental(spark, f"{root}/landing", f"{root}/bronze",
                                        f"{root}/silver", f"{root}/ckpt")
    q.awaitTermination()
    bronze = B.read_bronze(spark, f"{root}/bronze")
    assert bronze.count() == 12 + 10
    silver = spark.read.parquet(f"{root}/silver")
    got = {r["vacancy_id"]: r for r in silver.collect()}
    assert set(got) == {"v1", "v2"}
    assert all(r["snapshot_id"] == "s1" for r in got.values())
    assert got["v1"]["quality_score"] == 4 and got["v1"]["matched_rows"] == 6
    assert got["v1"]["matched_areas"] == ["msk", "remote", "spb"]


def _silver(spark, root):
    return {(r["snapshot_id"], r["vacancy_id"]): r["matched_rows"]
            for r in spark.read.parquet(f"{root}/silver").collect()}


def _run(spark, root, build=bronze_stream.default_silver):
    q = bronze_stream.start_incremental(spark, f"{root}/landing", f"{root}/bronze",
                                        f"{root}/silver", f"{root}/ckpt", build=build)
    q.awaitTermination()


def _at(df, when):
    return df.withColumn("ingested_at", F.lit(when).cast("timestamp"))


def test_straddling_snapshot_survives_a_later_one(spark):
    root = tempfile.mkdtemp(prefix="tp-straddle-")
    grid = [(r, a) for r in ("dev", "ops") for a in ("msk", "spb", "remote")]
    _at(landed(spark, "s1", grid[:3], 1), "2024-01-31 23:00:00").write.parquet(f"{root}/landing/b1")
    _at(landed(spark, "s1", grid[3:], 1), "2024-02-01 01:00:00").write.parquet(f"{root}/landing/b2")
    _run(spark, root)
    assert _silver(spark, root) == {("s1", "v1"): 6, ("s1", "v2"): 6}
    _at(landed(spark, "s2", grid, 1), "2024-02-10 01:00:00").write.parquet(f"{root}/landing/b3")
    _run(spark, root)
    assert _silver(spark, root) == {(s, v): 6 for s in ("s1", "s2") for v in ("v1", "v2")}
    # a seventh slice makes s1 over-complete: it leaves silver, and its months stay readable
    _at(landed(spark, "s1", [("sre", "msk")], 1), "2024-02-01 02:00:00").write.parquet(f"{root}/landing/b4")
    _run(spark, root)
    assert _silver(spark, root) == {("s2", "v1"): 6, ("s2", "v2"): 6}


def test_failure_between_append_and_silver_is_made_good(spark):
    root = tempfile.mkdtemp(prefix="tp-fail-")
    grid = [(r, a) for r in ("dev", "ops") for a in ("msk", "spb", "remote")]
    landed(spark, "s1", grid, 1).write.parquet(f"{root}/landing/b1")

    def broken(rows):
        raise RuntimeError("stop here")
    with pytest.raises(Exception, match="stop here"):
        _run(spark, root, broken)
    assert B.read_bronze(spark, f"{root}/bronze").count() == 12
    _run(spark, root)
    assert B.read_bronze(spark, f"{root}/bronze").count() == 12
    assert _silver(spark, root) == {("s1", "v1"): 6, ("s1", "v2"): 6}


def _sustained(spark, batches, watermark):
    """Samples landed batch by batch through the stream, and the batch form of all."""
    schema = "series string, ts timestamp, cond boolean"
    root = tempfile.mkdtemp(prefix="tp-ms-")
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/in/b{k}")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in/*")
        out = metrics_stream.sustained_stream(stream, "series", "ts", "cond", 3 * 3600, 3600, watermark)
        q = (out.writeStream.format("parquet").outputMode("append").option("path", f"{root}/out")
             .option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
    every = spark.createDataFrame([r for b in batches for r in b], schema)
    batch = M.sustained(every, ["series"], "ts", "cond", 3 * 3600, 3600)
    got = spark.read.parquet(f"{root}/out")
    return [sorted((r["series"], r["ts"], r["cond"], r["island_start"], r["firing"])
                   for r in df.filter("series != 'end'").collect()) for df in (got, batch)]


def test_sustained_stream_matches_batch(spark):
    t0 = dt.datetime(2024, 1, 1)
    conds = [True, True, True, True, False, True, True, True, True, True]
    rows = [("a", t0 + dt.timedelta(hours=i), c) for i, c in enumerate(conds)]
    rows += [("b", t0 + dt.timedelta(hours=i), True) for i in (0, 1, 3, 4, 5, 6)]   # gap at 2
    rows += [("end", t0 + dt.timedelta(days=2), True)]      # moves the watermark on
    got, want = _sustained(spark, [rows], "2 hours")
    assert got == want and len(got) == 16
    firing = {(r[0], r[1]): r[4] for r in want}
    assert firing[("a", t0 + dt.timedelta(hours=3))] and not firing[("a", t0 + dt.timedelta(hours=7))]
    assert firing[("b", t0 + dt.timedelta(hours=6))] and not firing[("b", t0 + dt.timedelta(hours=5))]


def test_sustained_stream_orders_late_samples(spark):
    t0 = dt.datetime(2024, 1, 1)

    def at(h, c, s="a"):
        return (s, t0 + dt.timedelta(hours=h), c)
    first = [at(0, True), at(1, True), at(3, True), at(0, True, "b")]
    second = [at(2, False), at(5, True), at(4, True), at(6, True), at(1, True, "b"), at(3, True, "b")]
    third = [at(2, True, "b"), at(7, True), at(48, True, "end")]
    got, want = _sustained(spark, [first, second, third], "12 hours")
    assert got == want and len(got) == 12
    assert {r[1].hour: r[3] and r[3].hour for r in want if r[0] == "a"}[4] == 3
    assert any(r[0] == "b" and r[4] for r in want)


def test_windowed_counts(spark):
    root = tempfile.mkdtemp(prefix="tp-wc-")
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").write.parquet(f"{root}/ev")
    ev = spark.read.parquet(f"{root}/ev")
    stream = spark.readStream.schema(ev.schema).parquet(f"{root}/ev").withColumn(
        "ts", F.col("ts").cast("timestamp"))
    out = metrics_stream.windowed_counts(stream, "ts", ["event_type"], "1 day", watermark="1 hour")
    q = (out.writeStream.format("memory").queryName("wc_out").outputMode("complete")
         .option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    total = spark.table("wc_out").agg(F.sum("n")).first()[0]
    assert total == ev.count()


def test_run_transform(spark):
    from tidepool.plans import transform as TR
    root = tempfile.mkdtemp(prefix="tp-tr-")
    grid = [(r, a) for r in TR.ROLES for a in TR.AREAS]
    B.append_bronze(landed(spark, "s1", grid, 1).drop("source"), f"{root}/bronze", source="landing")
    B.append_bronze(landed(spark, "s2", grid[:4], 2).drop("source"), f"{root}/bronze", source="landing")
    res = TR.run_transform(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold")
    assert res.bronze.snapshot_id == "s1" and res.bronze.combos == 6
    assert res.silver_rows == 2 and res.silver_stats["detail_ok"] == 2
    assert res.silver_stats["detail_ok_pct"] == "100.0%"
    gold = {r["skill"]: r for r in spark.read.parquet(f"{root}/gold").collect()}
    assert gold["k8s"]["vacancies_count"] == 2 and gold["k8s"]["msk_count"] == 2
    import pytest
    from tidepool.operators.quality import GateError
    with pytest.raises(GateError, match="partial"):
        TR.run_transform(spark, f"{root}/bronze", f"{root}/silver2", f"{root}/gold2", "s2")


def test_null_in_an_old_snapshot_fails_the_run(spark):
    from tidepool.operators.quality import GateError
    from tidepool.plans import transform as TR
    root = tempfile.mkdtemp(prefix="tp-null-")
    grid = [(r, a) for r in TR.ROLES for a in TR.AREAS]
    old = landed(spark, "s0", grid, 0).drop("source").withColumn(
        "vacancy_id", F.when(F.col("vacancy_id") != "v2", F.col("vacancy_id")))
    B.append_bronze(old, f"{root}/bronze", source="landing")
    B.append_bronze(landed(spark, "s1", grid, 1).drop("source"), f"{root}/bronze", source="landing")
    with pytest.raises(GateError, match="not_null__vacancy_id"):
        TR.run_transform(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold")


def test_incremental_silver_snapshot_across_months(spark):
    root = tempfile.mkdtemp(prefix="tp-stream2-")
    grid = [(r, a) for r in ("dev", "ops") for a in ("msk", "spb", "remote")]
    first = landed(spark, "s9", grid[:3], 1).withColumn(
        "ingested_at", F.lit(dt.datetime(2024, 4, 30, 23, 59)))
    first.write.parquet(f"{root}/landing/b1")
    q = bronze_stream.start_incremental(spark, f"{root}/landing", f"{root}/bronze",
                                        f"{root}/silver", f"{root}/ckpt")
    q.awaitTermination()
    landed(spark, "s9", grid[3:], 1).write.parquet(f"{root}/landing/b2")   # May 1st
    q = bronze_stream.start_incremental(spark, f"{root}/landing", f"{root}/bronze",
                                        f"{root}/silver", f"{root}/ckpt")
    q.awaitTermination()
    silver = spark.read.parquet(f"{root}/silver")
    assert {r["vacancy_id"] for r in silver.filter("snapshot_id = 's9'").collect()} == {"v1", "v2"}
