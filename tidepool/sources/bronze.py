"""Bronze and layer sinks (S1-S7): schema-fixed reads, defaulted appends with monthly
partitions, retry-safe appends, layer rebuilds and insert-if-absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.text import month_key
from tidepool.operators.silver import arg_extreme
from tidepool.sources import snapshot_months

BRONZE_SCHEMA = T.StructType([
    T.StructField("ingested_at", T.TimestampType(), False),
    T.StructField("snapshot_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("search_text", T.StringType(), False),
    T.StructField("search_area", T.StringType(), False),
    T.StructField("page_num", T.IntegerType(), False),
    T.StructField("vacancy_id", T.StringType(), False),
    T.StructField("raw_json", T.StringType(), False),
])
BRONZE_COLUMNS = tuple(f.name for f in BRONZE_SCHEMA.fields)
# The second landing table has the same layout keyed by employer.
EMPLOYER_COLUMNS = ("ingested_at", "snapshot_id", "source", "employer_id", "raw_json")
PARTITION_COL = "yyyymm"

# Known layers map to fixed schema names; any other layer gets "<default>_<layer>".
LAYER_SCHEMAS = {"silver": "lake_silver", "gold": "lake_gold"}


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists (through the cluster's file system client)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_bronze(spark: SparkSession, path: str, schema: T.StructType = BRONZE_SCHEMA,
                columns: Sequence[str] = BRONZE_COLUMNS) -> DataFrame:
    """The raw table with an explicit schema (no inference); selecting the
    columns prunes the Parquet scan. Month partitions are discovered from folders."""
    if PARTITION_COL not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField(PARTITION_COL, T.IntegerType())])
    return spark.read.schema(schema).parquet(path).select(*columns)


def with_defaults(df: DataFrame, source: str, ts: Column | None = None) -> DataFrame:
    """S2 defaults: ingest time (one value per batch, second precision, like a
    DEFAULT now() column) and source, plus the month partition key."""
    ts = ts if ts is not None else F.date_trunc("second", F.current_timestamp())
    if "ingested_at" not in df.columns:
        df = df.withColumn("ingested_at", ts)
    if "source" not in df.columns:
        df = df.withColumn("source", F.lit(source))
    return df.withColumn(PARTITION_COL, month_key("ingested_at"))


MAX_RECORDS_PER_FILE = 5_000_000
# Columns that split a batch of one snapshot over tasks (those a table has).
SPLIT_COLUMNS = ("search_text", "search_area", "vacancy_id", "employer_id")


def append_bronze(df: DataFrame, path: str, source: str = "landing",
                  ts: Column | None = None, sort: Sequence[str] = ("snapshot_id",),
                  columns: Sequence[str] = BRONZE_COLUMNS) -> None:
    """Append rows under monthly partitions, sorted by snapshot inside each file
    so snapshot filters skip row groups. Rows are range-partitioned on (month, sort keys,
    slice, key): a batch usually holds one month and one snapshot, and the slice and key
    still split it over many tasks. Files are capped in size. The commit protocol makes a
    failed or retried task leave no partial files; a re-run of the whole batch is
    guarded by :func:`anti_append`. The months of the batch's snapshots are observed by the
    write itself and published for :func:`retry_safe`."""
    out = with_defaults(df, source, ts)
    cols = [c for c in columns if c in out.columns] + [PARTITION_COL]
    keys = [PARTITION_COL, *sort]
    split = [c for c in SPLIT_COLUMNS if c in cols and c not in keys]
    rows = out.select(*cols).repartitionByRange(*keys, *split).sortWithinPartitions(*keys)
    spark, seen = df.sparkSession, Observation()
    folders = snapshot_months.open_append(spark, path, table_exists(spark, path))
    (rows.observe(seen, F.collect_set(F.struct("snapshot_id", PARTITION_COL)).alias("pairs"))
     .write.mode("append").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy(PARTITION_COL).parquet(path))
    snapshot_months.close_append(spark, path, folders, seen.get["pairs"])


def anti_append(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet (left anti join; NULL keys
    never match, so they are kept). The stored side needs no ``distinct``. Rows that
    repeat *within* ``new`` are kept, as the reference does."""
    return new.join(existing.select(*keys), list(keys), "left_anti")


def retry_safe(new: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """S3 against a stored table: rows of ``new`` whose key (which holds ``snapshot_id``) is
    not in it, reading only the months of the batch's snapshots; all of ``new`` where there
    is no table yet."""
    spark = new.sparkSession
    if not table_exists(spark, path):
        return new
    stored = read_bronze(spark, path, columns=[*keys, PARTITION_COL])
    return anti_append(new, snapshot_months.rows_of_snapshots(stored, path, new), keys)


def layer_name(layer: str | None, default_schema: str,
               schemas: dict[str, str] | None = None) -> str:
    """Layer short name -> schema; no layer -> default; unknown -> default_layer."""
    if layer is None:
        return default_schema
    layer = layer.strip()
    return (schemas or LAYER_SCHEMAS).get(layer, f"{default_schema}_{layer}")


def write_layer(df: DataFrame, path: str, partition: Sequence[str] = (),
                sort: Sequence[str] = (), dynamic: bool = False) -> None:
    """Full rebuild of a layer table. Rows are range-partitioned on
    (partition columns, sort columns): a large month is split over many tasks, and the
    files come out globally ordered, so min/max row-group statistics skip well. With
    ``dynamic`` only the partitions present in ``df`` are replaced."""
    w = df
    keys = [*partition, *sort]
    if keys:
        w = w.repartitionByRange(*keys).sortWithinPartitions(*keys)
    writer = w.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition:
        writer = writer.partitionBy(*partition)
    writer.parquet(path)


def staging_view(df: DataFrame, name: str) -> str:
    """Register the typed relation as a temporary view (no data copy)."""
    df.createOrReplaceTempView(name)
    return name


def insert_ignore(target: DataFrame, new: DataFrame, key: Sequence[str],
                  order: Sequence[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING``: keep one row per key of ``new`` (the
    first under ``order``), drop keys already in ``target``, append the rest."""
    # min of a struct led by the order: partial per task, so a repeated key is
    # combined before the shuffle.
    first = (new.groupBy(*key)
             .agg(arg_extreme(list(order), new.columns, largest=False).alias("_r"))
             .select(*[F.col("_r")[c].alias(c) for c in new.columns]))
    fresh = first.join(target.select(*key), list(key), "left_anti")
    return target.unionByName(fresh.select(*target.columns))
