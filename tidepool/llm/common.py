"""Helpers shared by the operators: reading, durable intermediates, document keys."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.session import ensure_checkpoint_dir

# Internal columns carry this prefix, so columns of the input can never clash with them.
P = "__td_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long), ``text`` and ``th`` (hash of the text) of every row; whatever
    else the input holds is left out. (doc_id, th) identifies a document: repeated rows
    are the same document, one id with two texts is two documents."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"),
                       F.xxhash64(F.col("text").cast("string")).alias("th"))


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def durable(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Cut lineage with a table written under the shared checkpoint folder.

    A lost executor costs only its running tasks: readers start again from the files.
    The shuffle files of the writing job go when it ends. ``discard`` removes the table
    once its readers are done; the folder needs an expiry policy for the rest, like any
    checkpoint folder.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._td_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``durable`` wrote and that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._td_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else; texts of ASCII only take the fast built-in path."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def held_out(doc_id: Column, mod: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo ``mod``, equals ``remainder`` (a null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == remainder,
                      F.lit(False))


def matching(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` (all columns) whose (doc_id, text) key is among ``keys``
    (``doc_id``, ``th``): ``how`` is ``left_semi`` or ``left_anti``; ids match null-safely."""
    k = keys.select(F.col("doc_id").alias(P + "id"), F.col("th").alias(P + "th"))
    cond = (docs["doc_id"].cast("long").eqNullSafe(k[P + "id"])
            & (F.xxhash64(docs["text"].cast("string")) == k[P + "th"]))
    return docs.join(k, cond, how)


def text_blocks(column, chars: int = 1 << 22) -> Iterator[list[str]]:
    """An Arrow text column (null: empty) in order, in lists of about ``chars`` characters
    (one longer text alone), which bounds what a task holds beside its batch."""
    block, size = [], 0
    for value in column:
        t = value.as_py() or ""
        if block and size + len(t) > chars:
            yield block
            block, size = [], 0
        block.append(t)
        size += len(t)
    if block:
        yield block
