"""Incremental bronze -> silver -> gold as a file stream (the four-hourly batch, made
continuous).

Landed files are read as a stream with the fixed bronze schema. Each micro-batch
(``foreachBatch``) is appended to bronze retry-safely (rows whose key is already
stored are dropped, so a replayed batch after a failure adds nothing), then silver is
rebuilt for the months that hold rows of a snapshot of the batch, partition by partition.
The stream checkpoint records which files were processed; bronze and silver are
plain Parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidepool.functions.payload import staging
from tidepool.functions.text import month_key
from tidepool.operators import silver as S
from tidepool.operators import snapshots
from tidepool.session import bounded_broadcast
from tidepool.sources import bronze as B
from tidepool.sources.snapshot_months import months_of, snapshot_months
from tidepool.streaming.gold_stream import Rollup, refresh_gold

RETRY_KEYS = ("snapshot_id", "search_text", "search_area", "vacancy_id")


def rebuild_silver(spark: SparkSession, bronze_path: str, silver_path: str,
                   months: Sequence, build: Callable[[DataFrame], DataFrame]) -> None:
    """Recompute silver for the given months from bronze and replace exactly those month
    partitions, also those that become empty.

    Every snapshot with a row in one of the months is judged and reduced on all of its
    rows, whichever month they are in; of the result only the given months are written, and
    each of their rows comes from such a snapshot. Which months those snapshots span is
    looked up in the index beside bronze, and month filters are literals, so other partitions
    are not read."""
    b = B.read_bronze(spark, bronze_path, columns=[*B.BRONZE_COLUMNS, B.PARTITION_COL])
    months = list(months)
    ids = bounded_broadcast(snapshot_months(spark, bronze_path)
                            .where(F.col(B.PARTITION_COL).isin(months))
                            .select("snapshot_id").distinct())
    span = months_of(spark, bronze_path, ids)
    rows = b.where(F.col(B.PARTITION_COL).isin(span)).join(ids, "snapshot_id", "left_semi")
    out = build(rows).withColumn(B.PARTITION_COL, month_key("ingested_at"))
    out = out.where(F.col(B.PARTITION_COL).isin(months)).checkpoint(eager=True)
    for month in months:
        B.write_layer(out.where(F.col(B.PARTITION_COL) == month).drop(B.PARTITION_COL),
                      f"{silver_path}/{B.PARTITION_COL}={month}", sort=["snapshot_id", "vacancy_id"])


def default_silver(bronze_rows: DataFrame) -> DataFrame:
    """F1 -> F2 -> staging -> W2, the reference silver rule."""
    complete = snapshots.complete_snapshots(bronze_rows)
    rows = snapshots.keep_complete(bronze_rows, complete)
    stg = staging(rows.drop(B.PARTITION_COL), keep_raw=False)
    cols = [c for c in stg.columns if c not in ("source", "search_text", "search_area", "page_num")]
    return S.best_row_fused(stg, ("snapshot_id", "vacancy_id"),
                            ("quality_score", "description_length", "ingested_at",
                             "search_text", "search_area", "page_num"),
                            cols=[c for c in cols if c not in ("snapshot_id", "vacancy_id")])


def start_incremental(spark: SparkSession, landing_path: str, bronze_path: str,
                      silver_path: str, checkpoint: str, source: str = "landing",
                      build: Callable[[DataFrame], DataFrame] = default_silver,
                      keys: Sequence[str] = RETRY_KEYS,
                      available_now: bool = True, gold_state: str | None = None,
                      rollup: Rollup | None = None) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what has landed and stops. With
    ``gold_state`` and ``rollup`` each batch also brings the gold rollup up to date."""
    landed = (spark.readStream.schema(B.BRONZE_SCHEMA)
              .option("recursiveFileLookup", "true").parquet(landing_path))

    def batch(df: DataFrame, epoch_id: int) -> None:
        fresh = B.retry_safe(df, bronze_path, keys)
        fresh = fresh.checkpoint(eager=True)  # reused below; survives executor loss
        if not fresh.isEmpty():
            B.append_bronze(fresh, bronze_path, source=source)
        # the snapshots of the whole micro-batch, not only its new rows: a batch that is
        # replayed after failing between append and silver still rebuilds silver
        months = months_of(spark, bronze_path, df)
        if months:
            rebuild_silver(spark, bronze_path, silver_path, months, build)
            if gold_state and rollup:
                refresh_gold(spark, silver_path, gold_state, months, rollup)

    writer = landed.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
