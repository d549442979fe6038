"""Gold kept incrementally: signed deltas of changed latest versions (A3 -> A7).

State is the latest silver row of every key (A3) and the rollup (A7). When silver months
are rebuilt, only keys with a row in those months, or whose latest row was in them, can
change. Their old version leaves the counts and the new one enters: one signed delta per
array item, merged into the rollup by key. The result always equals the rollup rebuilt from
all of silver, and refreshing again adds nothing, since state is compared with silver and
not with the batch.

The latest rows are a log of changes (one folder per refresh, newest change of a key wins),
compacted every ``COMPACT`` refreshes. Log and rollup switch together by one manifest
(:mod:`tidepool.sources.versions`).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidepool.functions.text import month_key
from tidepool.operators import gold as G
from tidepool.sources import bronze as B
from tidepool.sources import versions as V

COMPACT = 8


@dataclass(frozen=True)
class Rollup:
    """What :func:`tidepool.operators.gold.skills_top` computes, as parameters."""
    key: str = "vacancy_id"
    order: Sequence[str] = ("ingested_at", "snapshot_id")
    arr: str = "skills"
    item: str = "skill"
    carry: Sequence[str] = ("matched_roles", "matched_areas")
    pivots: Sequence[tuple[str, str, object]] = field(default=())
    count_alias: str = "vacancies_count"

    @property
    def fields(self) -> list[str]:
        return [*self.order, self.arr, *self.carry]

    @property
    def counts(self) -> list[str]:
        return [self.count_alias, *[p[0] for p in self.pivots]]

    def rebuilt(self, silver: DataFrame) -> DataFrame:
        """The rollup from all of silver (what the incremental one must equal)."""
        return G.skills_top(silver, self.key, self.order, self.arr, self.item, self.pivots,
                            self.carry, self.count_alias)


def _schemas(silver: DataFrame, r: Rollup) -> tuple[StructType, StructType]:
    row = StructType([StructField(c, silver.schema[c].dataType) for c in r.fields])
    log = StructType([StructField(r.key, silver.schema[r.key].dataType),
                      StructField("seq", LongType()), StructField("old", row),
                      StructField("new", row)])
    gold = StructType([StructField(r.item, silver.schema[r.arr].dataType.elementType),
                       *[StructField(c, LongType()) for c in r.counts]])
    return log, gold


def _rank(row: str, r: Rollup) -> Column:
    return F.struct(*[F.col(f"{row}.{c}") for c in r.order])


def _latest(rows: DataFrame, r: Rollup, name: str) -> DataFrame:
    return (G.latest_per_key(rows, r.key, r.order, r.fields)
            .select(r.key, F.struct(*r.fields).alias(name)))


def _changes(silver: DataFrame, old: DataFrame, months: Sequence, r: Rollup) -> DataFrame:
    """(key, old, new) of keys whose latest row differs; ``new`` NULL: the key is gone."""
    here = silver.where(F.col(B.PARTITION_COL).isin(list(months)))
    was_here = month_key(F.col("old")[r.order[0]]).isin(list(months))
    j = (_latest(here, r, "cand").join(old, r.key, "full_outer")
         .where(F.col("cand").isNotNull() | was_here))
    ahead = _rank("cand", r) >= _rank("old", r)
    # the old row was in a rebuilt month and nothing there is as new: look in all months
    unsure = F.col("old").isNotNull() & was_here & ~F.coalesce(
        F.col("cand").isNotNull() & ahead, F.lit(False))
    j = j.withColumn("unsure", unsure).checkpoint(eager=True)
    sure = j.where(~F.col("unsure")).select(r.key, "old", F.when(
        F.col("old").isNull() | ahead, F.col("cand")).otherwise(F.col("old")).alias("new"))
    asked = j.where("unsure").select(r.key, "old")
    if not asked.isEmpty():
        found = _latest(silver.join(asked.select(r.key), r.key, "left_semi"), r, "new")
        sure = sure.unionByName(asked.join(found, r.key, "left"))
    return sure.where(~F.col("old").eqNullSafe(F.col("new")))


def _deltas(changes: DataFrame, r: Rollup) -> DataFrame:
    """Signed counts per item: rows that left count -1, rows that entered +1."""
    signed = changes.select(F.explode(F.array(
        F.struct(F.lit(-1).cast("long").alias("sign"), F.col("old").alias("row")),
        F.struct(F.lit(1).cast("long").alias("sign"), F.col("new").alias("row")))).alias("s"))
    rows = signed.where("s.row IS NOT NULL").select("s.sign", "s.row.*")
    items = G.unnest(rows, r.arr, r.item)
    aggs = [F.sum("sign").alias(r.count_alias)]
    aggs += [F.sum(F.when(F.array_contains(arr, value), F.col("sign")).otherwise(F.lit(0)))
             .alias(alias) for alias, arr, value in r.pivots]
    return items.groupBy(r.item).agg(*aggs)


def latest_rows(spark: SparkSession, state_path: str, log: StructType, r: Rollup) -> DataFrame:
    """(key, old): the latest row of every key in the published state."""
    m = V.manifest(spark, state_path) or {"log": []}
    newest = V.read_data(spark, state_path, m["log"], log).groupBy(r.key).agg(
        F.max_by("new", "seq").alias("old"))
    return newest.where("old IS NOT NULL")


def refresh_gold(spark: SparkSession, silver_path: str, state_path: str, months: Sequence,
                 rollup: Rollup) -> int | None:
    """Bring the published rollup up to date after ``months`` of silver were rewritten;
    returns the new version, or None if nothing changed. The first call takes all months."""
    r, silver = rollup, spark.read.parquet(silver_path)
    if B.PARTITION_COL not in silver.columns:
        silver = silver.withColumn(B.PARTITION_COL, month_key("ingested_at"))
    silver = silver.withColumn(B.PARTITION_COL, F.col(B.PARTITION_COL).cast("string"))
    months = [str(x) for x in months]
    log, gold = _schemas(silver, r)
    m = V.manifest(spark, state_path)
    if m is None:
        months = [x[0] for x in silver.select(B.PARTITION_COL).distinct().collect()]
        m = {"log": [], "gold": [], "seq": 0}
    old = latest_rows(spark, state_path, log, r)
    found = _changes(silver, old, months, r).select(
        r.key, F.lit(m["seq"] + 1).cast("long").alias("seq"), "old", "new")
    written = V.write_data(found, state_path)
    changes = V.read_data(spark, state_path, [written], log)
    if changes.isEmpty() and m["gold"]:
        return None
    before = V.read_data(spark, state_path, m["gold"], gold)
    merged = (before.unionByName(_deltas(changes, r)).groupBy(r.item)
              .agg(*[F.sum(c).alias(c) for c in r.counts]).where(F.col(r.count_alias) != 0))
    names = [*m["log"], written]
    rolled = V.write_data(merged, state_path)
    if len(names) > COMPACT:
        whole = V.read_data(spark, state_path, names, log).groupBy(r.key).agg(
            F.max_by(F.struct("seq", "old", "new"), "seq").alias("c")).select(r.key, "c.*")
        names = [V.write_data(whole.where("new IS NOT NULL"), state_path)]
    return V.publish(spark, state_path, {"log": names, "gold": [rolled], "seq": m["seq"] + 1})


def read_gold(spark: SparkSession, state_path: str, silver_path: str, rollup: Rollup) -> DataFrame:
    """The published rollup."""
    m = V.manifest(spark, state_path) or {"gold": []}
    _, gold = _schemas(spark.read.parquet(silver_path), rollup)
    return V.read_data(spark, state_path, m["gold"], gold)
