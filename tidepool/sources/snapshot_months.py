"""Which months hold rows of which snapshot (S3): a small table of (snapshot, month) kept
beside bronze, so that a retry-safe append reads the months of its own snapshots only.

The table is published by version. An append first publishes that it is under way, writes
its rows, and then publishes what it observed while writing; where an append was lost in
between, or the bronze table is older than this one, the stored rows are asked instead and
the next append publishes their answer. One writer at a time, as for bronze itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tidepool.session import bounded_broadcast
from tidepool.sources import versions

FOLDER = "_snapshots"           # hidden from readers of the bronze table
SCHEMA = StructType([StructField("snapshot_id", StringType()), StructField("yyyymm", IntegerType())])
MAX_FOLDERS = 32                # appends between two compactions
MAX_LITERALS = 1000             # snapshots of a batch named in the scan's filter


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path).distinct()


def snapshot_months(spark: SparkSession, path: str) -> DataFrame:
    """(snapshot_id, yyyymm) of a bronze table, from its index or, without a finished one,
    from two columns of the stored rows."""
    m = versions.manifest(spark, f"{path}/{FOLDER}")
    if m is None or m["open"]:
        return _stored(spark, path)
    return versions.read_data(spark, f"{path}/{FOLDER}", m["folders"], SCHEMA).distinct()


def open_append(spark: SparkSession, path: str, exists: bool) -> list[str]:
    """Publish that an append is under way; the index's folders so far."""
    index = f"{path}/{FOLDER}"
    m = versions.manifest(spark, index)
    folders = m["folders"] if m else []
    whole = exists if m is None else m["open"]
    if whole or len(folders) > MAX_FOLDERS:
        folders = [versions.write_data(snapshot_months(spark, path).coalesce(1), index)]
    versions.publish(spark, index, {"folders": folders, "open": True})
    if m and (whole or len(m["folders"]) > MAX_FOLDERS):
        versions.retire(spark, index)
    return folders


def close_append(spark: SparkSession, path: str, folders: list[str], pairs: list) -> None:
    """Publish the (snapshot, month) pairs that an append has written."""
    index = f"{path}/{FOLDER}"
    if pairs:
        fresh = spark.createDataFrame([tuple(p) for p in pairs], SCHEMA).coalesce(1)
        folders = [*folders, versions.write_data(fresh, index)]
    versions.publish(spark, index, {"folders": folders, "open": False})


def months_of(spark: SparkSession, path: str, snapshots: DataFrame) -> list[int]:
    """Months that hold a row of one of ``snapshots`` (column ``snapshot_id``), sorted."""
    known = snapshot_months(spark, path)
    found = known.join(snapshots.select("snapshot_id").distinct(), "snapshot_id", "left_semi")
    return sorted(r[0] for r in found.select("yyyymm").distinct().collect())


def rows_of_snapshots(stored: DataFrame, path: str, batch: DataFrame,
                      max_literals: int = MAX_LITERALS) -> DataFrame:
    """Rows of ``stored`` (a read of ``path`` with its month column) in a snapshot of
    ``batch``. Months are literals, which prune folders, and so are up to ``max_literals``
    snapshots, which skip row groups; more of them are joined. Null snapshots match nothing."""
    spark = batch.sparkSession
    ids = batch.select("snapshot_id").where("snapshot_id IS NOT NULL").distinct()
    few = [r[0] for r in ids.limit(max_literals + 1).collect()]
    if len(few) <= max_literals:
        named = F.col("snapshot_id").isin(few)
        months = sorted(r[0] for r in snapshot_months(spark, path).where(named)
                        .select("yyyymm").distinct().collect())
        return stored.where(F.col("yyyymm").isin(months)).where(named)
    ids = bounded_broadcast(ids)
    months = months_of(spark, path, ids)
    return stored.where(F.col("yyyymm").isin(months)).join(ids, "snapshot_id", "left_semi")
