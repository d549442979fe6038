"""Reading the input tables and mapping the TPC-H-style tables onto snapshot shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Total order that decides the best lineitem row of a (snapshot, supplier) key; the
# tuple (supplier, ship date, line number, quantity, price, order, part) is unique.
LINEITEM_ORDER = ("page_num", "l_quantity", "ingested_at", "l_extendedprice",
                  "l_orderkey", "l_partkey")


def spread(df: DataFrame) -> DataFrame:
    """Optional input parallelism floor (``spark.tidepool.minInputPartitions``, off by
    default): a scan with fewer splits is spread round-robin. Meant for benches and tests
    whose small tables have one row group; on real inputs it is only a shuffle."""
    spark = df.sparkSession
    floor = int(spark.conf.get("spark.tidepool.minInputPartitions", "0"))
    return df.repartition(floor) if floor and df.rdd.getNumPartitions() < floor else df


def read_table(spark: SparkSession, sf_dir: str, name: str, spread_small: bool = True) -> DataFrame:
    """One input table. Parquet carries its schema, so nothing is inferred; selecting
    columns afterwards prunes the scan (ReadSchema) and filters are pushed down."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if spread_small else df


def snapshot_of(ts_col: str, grain: str = "day"):
    """Snapshot id = the timestamp truncated to ``grain``, as 'yyyy-MM-dd' text."""
    return F.date_format(F.date_trunc(grain, F.col(ts_col)), "yyyy-MM-dd")


def lineitem_bronze(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """``lineitem`` in the bronze snapshot shape.

    snapshot = ship date truncated to ``grain``; slice = (return flag, line status),
    which has 3 x 2 = 6 values; business key = supplier; ingest time = ship date;
    page number = line number.
    """
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_shipdate").alias("ingested_at"),
        snapshot_of("l_shipdate", grain).alias("snapshot_id"),
        F.col("l_returnflag").alias("search_text"),
        F.col("l_linestatus").alias("search_area"),
        F.col("l_linenumber").alias("page_num"),
        F.col("l_suppkey").alias("vacancy_id"),
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
    )
