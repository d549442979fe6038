"""Session construction and the few session-level helpers every job needs."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows below which a derived side (set of snapshot ids, key list, ...) is broadcast.
# Anything above goes through a shuffle join and AQE decides at runtime.
DEFAULT_BROADCAST_ROWS = 1_000_000
# And the bytes of its values (as JSON text) up to which it is.
DEFAULT_BROADCAST_BYTES = 64 << 20


def build_session(master: str | None = None, app: str = "tidepool",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the library relies on.

    * UTC session time zone: month keys, day snapshots and epoch arithmetic must not
      depend on the driver's locale.
    * AQE on, with partition coalescing and skew-join splitting, so shuffle partition
      counts sized for the cluster do not hurt small inputs and hot keys get split.
    * No web UI (nothing listens on a port beyond what Spark itself needs).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    cpus = os.cpu_count() or 8
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or cpus),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for a Spark Connect session (no driver JVM here)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect raises a feature error
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the reliable checkpoint folder, reading ``spark.checkpoint.dir`` first.

    On a cluster the folder must be shared storage named by the deployment; a local
    temporary folder is only chosen when the session runs in local mode (tests, bench).
    """
    sc = _context(spark)
    if sc is None:          # Spark Connect: the server's spark.checkpoint.dir applies
        return None
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if sc.master.startswith("local"):
        d = tempfile.mkdtemp(prefix="tidepool-ckpt-")
        sc.setCheckpointDir(d)
        return d
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Materialise a *derived, expectedly small* side and broadcast it only if it measures
    at most ``max_rows`` rows and ``max_bytes`` bytes of values, counted in one job.

    The side is written with a reliable ``checkpoint`` (survives executor loss and
    cuts lineage, so the aggregate that produced it is not recomputed by the join);
    beyond the bound it is returned un-hinted and the join shuffles (AQE may still
    convert it from runtime statistics).
    """
    ensure_checkpoint_dir(df.sparkSession)
    materialised = df.checkpoint(eager=True)
    n, size = materialised.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)),
    ).first()
    return F.broadcast(materialised) if n <= max_rows and size <= max_bytes else materialised
