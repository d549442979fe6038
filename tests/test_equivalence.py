"""Plan-shape variants must agree: W1 = W2 = J1, and bucketed series operators do not
depend on the bucket size (brute force = one bucket)."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from tidepool.operators import metrics as M
from tidepool.operators import silver
from tidepool.plans import q_lineitem as Q
from tidepool.plans import q_metrics as QM


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_w1_w2_j1_agree(spark):
    cr = Q.complete_rows(spark, SF01)
    cols = list(Q.SILVER_COLS)
    w1 = silver.best_row(cr, Q.KEYS, Q.LINEITEM_ORDER, cols).select(*Q.KEYS, *cols)
    w2 = silver.best_row_fused(cr, Q.KEYS, Q.LINEITEM_ORDER, cols, Q.SETS).select(*Q.KEYS, *cols)
    w2d = silver.best_row_fused(cr, Q.KEYS, Q.LINEITEM_ORDER, cols, Q.SETS)
    j1 = silver.best_with_matches(cr, Q.KEYS, Q.LINEITEM_ORDER, cols, Q.SETS)
    assert rows(w1) == rows(w2)
    pick = [*Q.KEYS, *cols, "matched_roles", "matched_areas", "matched_rows"]
    assert rows(w2d.select(*pick)) == rows(j1.select(*pick))


@pytest.mark.parametrize("bucket_s", [3600, 4 * 3600])
def test_counter_rate_bucket_invariant(spark, bucket_s):
    c = QM.counters(spark, SF01)
    a = M.counter_rate(c, ["user_id"], "ts", "counter", 7200, ["event_id"], bucket_s=bucket_s)
    b = M.counter_rate(c, ["user_id"], "ts", "counter", 7200, ["event_id"], bucket_s=10 ** 8)
    assert rows(a.select("event_id", "increase")) == rows(b.select("event_id", "increase"))


@pytest.mark.parametrize("bucket_s", [3600, 2 * 3600, 86400])
def test_sustained_bucket_invariant(spark, bucket_s):
    h = QM.hourly(spark, SF01).withColumn("cond", F.col("n") >= 3)
    a = M.sustained(h, ["event_type"], "hour", "cond", 3 * 3600, 3600, bucket_s=bucket_s)
    b = M.sustained(h, ["event_type"], "hour", "cond", 3 * 3600, 3600, bucket_s=10 ** 8)
    cols = ["event_type", "hour", "island_start", "firing"]
    assert rows(a.select(*cols)) == rows(b.select(*cols))


def test_running_total_bucket_invariant(spark):
    e = spark.read.parquet(f"{SF01}/events.parquet").withColumn(
        "amount", F.col("value").cast("decimal(18,2)"))
    a = M.running_total(e, ["user_id"], "ts", "amount", ["ts", "event_id"], bucket_s=600)
    b = M.running_total(e, ["user_id"], "ts", "amount", ["ts", "event_id"], bucket_s=10 ** 8)
    assert rows(a.select("event_id", "running")) == rows(b.select("event_id", "running"))


@pytest.mark.parametrize("bucket_s", [3600, 6 * 3600])
def test_notifications_bucket_invariant(spark, bucket_s):
    al = QM.alerts(spark, SF01)
    a = M.notifications(al, cadence_s=3600, bucket_s=bucket_s)
    b = M.notifications(al, cadence_s=3600, bucket_s=10 ** 8)
    assert rows(a) == rows(b)
