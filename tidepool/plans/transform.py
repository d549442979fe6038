"""The transform run as one Spark job: bronze gate -> staging checks -> silver ->
silver checks -> gold -> silver gate (the order in which failures stop later steps).

Actions happen only at the gates, the batched checks and the two writes; everything
between is one logical plan per layer that Catalyst and AQE plan as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.payload import staging
from tidepool.functions.text import month_key, pct_label
from tidepool.operators import gold as G
from tidepool.operators import quality as Q
from tidepool.operators import silver as S
from tidepool.operators import snapshots
from tidepool.sources import bronze as B
from tidepool.sources import versions as V

# The slice grid of the reference's searches and its accepted values.
ROLES = ("DevOps Engineer", "Platform Engineer")
AREAS = ("msk", "spb", "remote")
MODES = ("html_fallback", "api")
SOURCE_NOT_NULL = ("ingested_at", "snapshot_id", "search_text", "search_area", "vacancy_id",
                   "raw_json")
STAGING_NOT_NULL = ("snapshot_id", "vacancy_id", "search_text", "search_area", "source_mode")
SILVER_ORDER = ("quality_score", "description_length", "ingested_at",
                "search_text", "search_area", "page_num")
SILVER_DROP = ("source", "raw_json", "search_text", "search_area", "page_num",
               B.PARTITION_COL)


@dataclass
class TransformResult:
    bronze: Q.BronzeStats
    silver_stats: dict
    silver_rows: int
    gold_rows: int


def silver_layer(stg: DataFrame, roles: Sequence[str] = ROLES,
                 areas: Sequence[str] = AREAS, complete: DataFrame | None = None) -> DataFrame:
    """All complete snapshots (not only the gated one) -> best row per (snapshot,
    vacancy) with the matched roles/areas, in one aggregate. ``complete`` names the
    complete snapshots if they are known already."""
    if complete is None:
        complete = snapshots.complete_snapshots(stg, n=len(roles) * len(areas))
    rows = snapshots.keep_complete(stg, complete)
    cols = [c for c in rows.columns if c not in (*SILVER_DROP, "snapshot_id", "vacancy_id")]
    return S.best_row_fused(rows, ("snapshot_id", "vacancy_id"), SILVER_ORDER,
                            cols=[*cols])


def gold_layer(silver: DataFrame, roles: Sequence[str] = ROLES,
               areas: Sequence[str] = AREAS) -> DataFrame:
    """Skill rollup over the latest silver row of every vacancy."""
    pivots = [("devops_count", "matched_roles", roles[0]),
              ("platform_count", "matched_roles", roles[1])]
    pivots += [(f"{a}_count", "matched_areas", a) for a in areas]
    return G.skills_top(silver, "vacancy_id", ("ingested_at", "snapshot_id"), "skills",
                        "skill", pivots)


def _result(gate: Q.BronzeStats, silver: DataFrame, gold_rows: int) -> TransformResult:
    """The silver gate and the report of a run."""
    stats = Q.silver_gate(
        silver, gate.snapshot_id, ["snapshot_id", "vacancy_id"],
        {"detail_ok": F.col("detail_status") == "ok",
         "detail_captcha": F.col("detail_status") == "captcha",
         "has_description": F.col("description_length") > 0,
         "has_skills": F.col("skills_count") > 0},
        mean_of="description_length", mean_alias="avg_desc_len")
    labelled = stats.select("*", *[pct_label(c, "silver_rows").alias(f"{c}_pct")
                                   for c in ("detail_ok", "has_description", "has_skills")])
    row = labelled.first().asDict()
    return TransformResult(gate, row, row["silver_rows"], gold_rows)


def run_transform(spark: SparkSession, bronze_path: str, silver_path: str, gold_path: str,
                  snapshot: str | None = None) -> TransformResult:
    bronze = B.read_bronze(spark, bronze_path, columns=[*B.BRONZE_COLUMNS, B.PARTITION_COL])
    n = len(ROLES) * len(AREAS)
    gate = Q.bronze_gate(bronze, snapshot, n=n)

    # the source's and the unscoped staging tests look at every row of every snapshot, the
    # others at the newest complete one; one aggregate for each table and scope
    Q.assert_no_failures(Q.check_counts(bronze, SOURCE_NOT_NULL))
    stg = staging(bronze, keep_raw=False)
    Q.assert_no_failures(Q.check_counts(stg, STAGING_NOT_NULL))
    latest = snapshots.where_latest(stg, bronze, n=n)
    Q.assert_no_failures(Q.check_counts(
        latest, ["title", "quality_score"],
        {"search_text": ROLES, "search_area": AREAS, "source_mode": MODES,
         "quality_score": [0, 1, 2, 3, 4]}))

    silver = silver_layer(stg)
    B.write_layer(silver.withColumn(B.PARTITION_COL, month_key("ingested_at")), silver_path,
                  [B.PARTITION_COL], ["snapshot_id", "vacancy_id"])
    silver = spark.read.parquet(silver_path)      # downstream reads the written table
    Q.assert_no_failures(Q.check_counts(silver, ["snapshot_id", "vacancy_id", "title",
                                                 "source_mode"]))
    if Q.unique_violations(silver, ["snapshot_id", "vacancy_id"]).limit(1).count():
        raise Q.GateError("silver grain (snapshot_id, vacancy_id) is not unique")

    gold = gold_layer(silver)
    B.write_layer(gold, gold_path, sort=["vacancies_count", "skill"])

    return _result(gate, silver, spark.read.parquet(gold_path).count())


def observed_silver(bronze: DataFrame, complete: DataFrame, latest: str | None
                    ) -> tuple[DataFrame, list]:
    """The silver layer that runs the source, staging and silver tests in its own pass.

    One scan of bronze and one parse of each payload feed the tests and the layer: the
    tests on all rows are counted below the completeness filter, those on the newest
    complete snapshot (``latest``) by a condition inside the count.
    """
    source, on_source = Q.observe_checks(bronze, "source_tests", SOURCE_NOT_NULL)
    stg, on_stg = Q.observe_checks(
        staging(source, keep_raw=False), "staging_tests", STAGING_NOT_NULL,
        F.col("snapshot_id") == F.lit(latest).cast("string"), ["title", "quality_score"],
        {"search_text": ROLES, "search_area": AREAS, "source_mode": MODES,
         "quality_score": [0, 1, 2, 3, 4]})
    silver, on_silver = Q.observe_checks(
        silver_layer(stg, complete=complete), "silver_tests",
        ["snapshot_id", "vacancy_id", "title", "source_mode"])
    return silver, [on_source, on_stg, on_silver]


def run_published(spark: SparkSession, bronze_path: str, silver_path: str, gold_path: str,
                  snapshot: str | None = None) -> TransformResult:
    """:func:`run_transform` with its data tests in the pass that writes and both layers
    published by version after every test and gate has passed.

    Bronze is scanned for the gate (narrow columns) and once for silver with all tests. A
    run that fails leaves its data folders unnamed (``versions.retire`` removes them) and
    readers (``versions.read_table``) on the versions before. Gold is published first, so
    a run that stops between the two leaves gold one version ahead until the next run.
    """
    bronze = B.read_bronze(spark, bronze_path, columns=[*B.BRONZE_COLUMNS, B.PARTITION_COL])
    n = len(ROLES) * len(AREAS)
    gate = Q.bronze_gate(bronze, snapshot, n=n)
    latest = gate.snapshot_id if snapshot is None else snapshots.latest_complete_id(bronze, n=n)
    silver, tests = observed_silver(bronze, snapshots.complete_snapshots(bronze, n=n), latest)
    keys = ["snapshot_id", "vacancy_id"]
    silver = silver.withColumn(B.PARTITION_COL, month_key("ingested_at"))
    order = [B.PARTITION_COL, *keys]
    silver_data = V.write_data(silver.repartitionByRange(*order).sortWithinPartitions(*order),
                               silver_path, B.PARTITION_COL)
    Q.assert_observed(*tests)
    written = V.read_data(spark, silver_path, [silver_data], silver.schema)
    if Q.unique_violations(written, keys).limit(1).count():
        raise Q.GateError("silver grain (snapshot_id, vacancy_id) is not unique")

    order = ["vacancies_count", "skill"]
    gold = gold_layer(written)
    gold_data = V.write_data(gold.repartitionByRange(*order).sortWithinPartitions(*order), gold_path)
    gold_rows = V.read_data(spark, gold_path, [gold_data], gold.schema).count()
    result = _result(gate, written, gold_rows)
    for path, name, df in ((gold_path, gold_data, gold), (silver_path, silver_data, silver)):
        V.publish(spark, path, {"folders": [name], "schema": df.schema.jsonValue()})
    return result
