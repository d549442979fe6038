"""Retention: which members of a group seen in one period are seen again later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_index(ts) -> Column:
    """Months since year 0, so that lags are differences."""
    return F.year(ts) * 12 + F.month(ts)


def retention(df: DataFrame, group: Sequence[str], member: str, period: Column,
              lags: Sequence[int]) -> DataFrame:
    """Per group and lag: ``seen``, the (member, period) pairs whose period + lag is not
    after the last period of the table, and ``kept``, those of them in which the member is
    seen again in just that later period. ``kept_bp`` is the share in 1/10,000, rounded
    down. Rows with a null member or period count nowhere; a null group is a group.

    A member's periods are one set, no longer than the history has periods and combined in
    every task before the only wide shuffle; the set is intersected with itself shifted by
    each lag, so there is no self join. Groups then add up plain counts, and a group with
    many members is combined in each task.
    """
    rows = df.select(*group, F.col(member).alias("_m"), period.cast("int").alias("_p")).where(
        "_m IS NOT NULL AND _p IS NOT NULL")
    last = rows.agg(F.max("_p").alias("_last"))         # one row
    sets = rows.groupBy(*group, "_m").agg(F.collect_set("_p").alias("_s"))
    each = sets.withColumn("_last", last.scalar()).withColumn(
        "lag", F.explode(F.array(*[F.lit(int(x)) for x in lags])))
    shifted = F.transform("_s", lambda p: p + F.col("lag"))
    within = F.filter(shifted, lambda p: p <= F.col("_last"))
    counted = each.select(*group, "lag", F.size(within).cast("long").alias("_n"),
                          F.size(F.array_intersect(within, "_s")).cast("long").alias("_k"))
    out = counted.groupBy(*group, "lag").agg(F.sum("_n").alias("seen"), F.sum("_k").alias("kept"))
    return out.where("seen > 0").withColumn("kept_bp", F.expr("kept * 10000 div seen"))
