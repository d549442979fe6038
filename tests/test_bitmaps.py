"""Exact mergeable distinct counts."""

from pyspark.sql import functions as F

from tidepool.operators import events as E


def test_any_split_merges_to_the_exact_count(spark):
    """Users over many buckets, negative and NULL ids, copies in every part, merged twice."""
    e = spark.range(6000).select(
        (F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("part"),
        F.when(F.col("id") % 11 != 0, F.pmod(F.col("id") * 7919, F.lit(2500)) * 100 - 90_000)
        .alias("user_id"))
    e = e.unionByName(e.where("k = 1"))
    e = e.unionByName(spark.createDataFrame([(9, 0, None)], e.schema))
    parts = E.bitmap_rollup(e, ["k", "part"])
    assert parts.select("users_bucket").distinct().count() > 5
    first = E.merge_bitmaps(parts.where("part < 4").unionByName(parts.where("part >= 4")), ["k", "part"])
    got = {r["k"]: r["unique_users"] for r in
           E.bitmap_users(E.merge_bitmaps(first, ["k"]), ["k"]).collect()}
    want = {r["k"]: r["n"] for r in e.groupBy("k").agg(F.count_distinct("user_id").alias("n")).collect()}
    assert got == want and want[9] == 0


def test_no_events(spark):
    e = spark.createDataFrame([], "k long, user_id long")
    assert E.bitmap_users(E.merge_bitmaps(E.bitmap_rollup(e, ["k"]), ["k"]), ["k"]).collect() == []
