"""The corpus pipeline: language ID, line dedup, SimHash near-dedup, benchmark
decontamination, best-fit packing, each written as Parquet and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import decontaminate, language, line_dedup, packing, simhash
from tidepool.llm.common import P, matching, table
from tidepool.session import ensure_checkpoint_dir

SHINGLE = 3
MAX_BITS = 2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages, unchanged; null, empty and letterless
    texts have no language and go."""
    verdict = language.predict(docs, language.fit_from_labels(docs))
    return matching(docs, language.rejected(verdict), "left_anti")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one holds; those left without any word
    they had go. ``n_chars`` follows the text. Null and empty texts stay, and so does every
    input column, whatever its name."""
    removed, lines = P + "n_removed", P + "n_lines"
    out = line_dedup.deduplicated(docs, P)
    out = out.where((F.col(removed) == 0) | (F.col(removed) < F.col(lines)))
    return out.select(*[
        F.when(F.col(removed) > 0, F.char_length("text")).otherwise(F.col(c))
        .cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c)
        for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the smallest id (null last), then text hash; of repeated
    rows of that document one stays."""
    groups = simhash.simhash_groups(docs, SHINGLE, MAX_BITS)
    lead = groups.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("k"),
    ).select("k.doc_id", "k.th")
    kept = matching(docs, lead, "left_semi")
    twice = groups.groupBy("doc_id", "th").count().where("count > 1")
    again = matching(kept, twice, "left_semi")
    return matching(kept, twice, "left_anti").unionByName(
        again.dropDuplicates(["doc_id", "text"]))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    leaks = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return matching(docs, leaks.select("doc_id", "th").distinct(), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.packed(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminated),
    ("best_fit_packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
