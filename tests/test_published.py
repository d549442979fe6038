"""Data tests by observation in the writing pass, and layers published after them."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import landed
from tidepool.operators import quality as Q
from tidepool.operators import snapshots
from tidepool.plans import transform as TR
from tidepool.sources import bronze as B
from tidepool.sources import versions as V

GRID = [(r, a) for r in TR.ROLES for a in TR.AREAS]


def land(spark, root, sid, day, slices=GRID, change=None):
    rows = landed(spark, sid, slices, day).drop("source")
    B.append_bronze(change(rows) if change else rows, f"{root}/bronze", source="landing")


def published(spark, root, snapshot=None):
    return TR.run_published(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold", snapshot)


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_equals_the_run_in_place(spark):
    root = tempfile.mkdtemp(prefix="tp-pub-")
    land(spark, root, "s1", 1)
    land(spark, root, "s2", 2, GRID[:4])
    want = TR.run_transform(spark, f"{root}/bronze", f"{root}/silver0", f"{root}/gold0")
    got = published(spark, root)
    assert got == want
    assert rows(V.read_table(spark, f"{root}/gold")) == rows(spark.read.parquet(f"{root}/gold0"))
    silver = V.read_table(spark, f"{root}/silver")
    assert rows(silver.drop(B.PARTITION_COL)) == rows(
        spark.read.parquet(f"{root}/silver0").drop(B.PARTITION_COL))
    with pytest.raises(Q.GateError, match="partial"):
        published(spark, root, "s2")


def test_failed_tests_leave_the_version_before(spark):
    root = tempfile.mkdtemp(prefix="tp-pub-bad-")
    land(spark, root, "s1", 1)
    published(spark, root)
    before = rows(V.read_table(spark, f"{root}/silver"))
    # an incomplete snapshot never reaches silver; its null keys fail the source test anyway
    land(spark, root, "s2", 2, GRID[:2], lambda d: d.withColumn(
        "vacancy_id", F.when(F.col("vacancy_id") != "v2", F.col("vacancy_id"))))
    with pytest.raises(Q.GateError, match="not_null__vacancy_id"):
        published(spark, root)
    for layer in ("silver", "gold"):
        assert V.versions(spark, f"{root}/{layer}") == [1]
    assert rows(V.read_table(spark, f"{root}/silver")) == before
    assert V.retire(spark, f"{root}/silver") == 1       # the failed run's folder
    assert rows(V.read_table(spark, f"{root}/silver")) == before


def test_one_scan_feeds_tests_and_layer(spark):
    root = tempfile.mkdtemp(prefix="tp-pub-plan-")
    land(spark, root, "s1", 1)
    bronze = B.read_bronze(spark, f"{root}/bronze", columns=[*B.BRONZE_COLUMNS, B.PARTITION_COL])
    complete = snapshots.complete_snapshots(bronze, n=len(GRID))
    silver, tests = TR.observed_silver(bronze, complete, "s1")
    plan = silver._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("CollectMetrics") == 3
    silver.write.format("noop").mode("overwrite").save()
    counts = Q.assert_observed(*tests)
    assert counts["not_null__raw_json"] == counts["accepted__search_text"] == 0


def test_scoped_checks_count_like_the_batched_ones(spark):
    df = spark.createDataFrame([("s1", None, "x"), ("s1", "t", "y"), ("s2", None, "y"),
                                ("s2", "t", None), (None, None, "z")], "sid string, t string, m string")
    seen_df, seen = Q.observe_checks(df, "t", ["sid"], F.col("sid") == "s1", ["t"], {"m": ["x"]})
    assert seen_df.count() == 5
    want = {**Q.check_counts(df, ["sid"]).first().asDict(),
            **Q.check_counts(df, ["t"], {"m": ["x"]}, where="sid = 's1'").first().asDict()}
    assert seen.get == want == {"not_null__sid": 1, "not_null__t": 1, "accepted__m": 1}
    with pytest.raises(Q.GateError, match="accepted__m"):
        Q.assert_observed(seen)
