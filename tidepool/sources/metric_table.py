"""A long metric-sample table (ts, metric, labels, series_id, value) derived from
``events``; the shape alert rules and dashboards read.

``events_total{type}``: events per hour and type. ``amount_total{user}``: a counter of
the user's amounts that resets every day (one sample per event). Labels are a MAP for
selection; ``series_id`` (sorted labels as JSON) is the key for windows and joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators import metrics as M
from tidepool.sources.tables import read_table

SCHEMA_COLS = ("ts", "metric", "labels", "series_id", "value")


def event_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    hourly = (e.groupBy("event_type", F.date_trunc("hour", "ts").alias("ts"))
              .agg(F.count(F.lit(1)).cast("double").alias("value"))
              .select("ts", F.lit("events_total").alias("metric"),
                      F.create_map(F.lit("type"), F.col("event_type")).alias("labels"), "value"))
    amounts = e.select("user_id", "event_id", "ts", F.to_date("ts").alias("day"),
                       F.col("value").cast("decimal(18,2)").alias("amount"))
    counter = (M.running_total(amounts, ["user_id", "day"], "ts", "amount", ["ts", "event_id"],
                               bucket_s=3600, out="running")
               .select(F.col("ts").cast("timestamp").alias("ts"),
                       F.lit("amount_total").alias("metric"),
                       F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("labels"),
                       F.col("running").cast("double").alias("value")))
    long = hourly.withColumn("ts", F.col("ts").cast("timestamp")).unionByName(counter)
    return long.withColumn("series_id", M.series_id("labels")).select(*SCHEMA_COLS)
