"""Inhibition as a stream keeps the alerts that the batch form keeps."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from tidepool.operators import metrics as M
from tidepool.plans.q_metrics import alerts
from tidepool.streaming.inhibit_stream import inhibit_stream

SCHEMA = "alertname string, severity string, instance string, ts timestamp"
T0 = dt.datetime(2024, 1, 1)
END = [("end", "info", "x", dt.datetime(2040, 1, 1))]


def run(spark, root, watermark, fail_at=None):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")

    def write(df, batch):
        df.write.mode("overwrite").parquet(f"{root}/out/batch={batch}")
        if batch == fail_at:
            raise RuntimeError("executor lost")

    q = (inhibit_stream(stream, watermark=watermark).writeStream.outputMode("append")
         .option("checkpointLocation", f"{root}/ck").foreachBatch(write)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def kept(df):
    return sorted(map(str, df.where("alertname IS NULL OR alertname != 'end'").select(
        "alertname", "severity", "instance", "ts").collect()))


def test_shuffled_arrivals_equal_the_batch_form(spark):
    r = random.Random(9)
    root = tempfile.mkdtemp(prefix="tp-inh-")
    rows = [(r.choice(["cpu", "disk", None]), r.choice(["critical", "warning", "warning", "info", None]),
             r.choice(["h1", "h2", None]),
             r.choice([T0 + dt.timedelta(minutes=r.randrange(80)), None])
             if r.random() < 0.1 else T0 + dt.timedelta(minutes=r.randrange(80)))
            for _ in range(900)]
    late = sorted(rows, key=lambda x: (x[3] or T0) + dt.timedelta(minutes=r.uniform(0, 29)))
    files = [late[i:i + 200] for i in range(0, len(late), 200)] + [END]
    for k, part in enumerate(files):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{root}/in/b{k:03}")
    with pytest.raises(Exception, match="executor lost"):
        run(spark, root, "30 minutes", fail_at=2)
    q = run(spark, root, "30 minutes")
    want = M.inhibit(spark.createDataFrame(rows, SCHEMA))
    got = spark.read.schema(SCHEMA).parquet(f"{root}/out")
    assert kept(got) == kept(want)
    hidden = sum(x[1] == "warning" for x in rows) - got.where("severity = 'warning'").count()
    assert hidden > 20
    # the end row is neither source nor target, yet it lets the state go
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 0


def test_given_alerts_equal_the_batch_form(spark):
    root = tempfile.mkdtemp(prefix="tp-inh-sf-")
    df = alerts(spark, SF01).select("alertname", "severity", "instance", "ts")
    order = F.col("ts").cast("long") + F.pmod(F.xxhash64("instance", "severity", "ts"), F.lit(3600))
    parts = df.repartitionByRange(4, order).withColumn("_f", F.spark_partition_id())
    parts.write.partitionBy("_f").parquet(f"{root}/all")
    for k in range(4):
        (spark.read.schema(SCHEMA).parquet(f"{root}/all/_f={k}").coalesce(1)
         .write.parquet(f"{root}/in/b{k}"))
    spark.createDataFrame(END, SCHEMA).coalesce(1).write.parquet(f"{root}/in/b9")
    run(spark, root, "1 hour")
    assert kept(spark.read.schema(SCHEMA).parquet(f"{root}/out")) == kept(M.inhibit(df))
