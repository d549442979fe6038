"""Latest version per key, array fan-out and ranked rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.operators.silver import arg_extreme


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
                   cols: Sequence[str]) -> DataFrame:
    """The values of the newest row per key.

    One max over a struct led by the order columns, e.g. (ingested_at, snapshot_id),
    and carrying all wanted columns (not one arg-max per column), so ties cannot mix
    values from different rows. Partial aggregation keeps one candidate per key per task.
    Unlike an arg-max that skips NULL values, a NULL field of the winning row stays NULL.
    """
    keys = [key] if isinstance(key, str) else list(key)
    best = arg_extreme(order, cols).alias("_latest")
    return (df.groupBy(*keys).agg(best)
            .select(*keys, *[F.col("_latest")[c].alias(c) for c in cols]))


def unnest(df: DataFrame, arr: str, out: str, drop_empty: bool = True) -> DataFrame:
    """A5: one row per array element (rows with empty or NULL arrays vanish, as an
    inner array join does); empty strings dropped."""
    rows = df.select("*", F.explode(arr).alias(out)).drop(arr)
    return rows.filter(F.col(out) != "") if drop_empty else rows


def count_if_contains(arr: str, value) -> Column:
    """``countIf(has(arr, value))``; a NULL array counts as false."""
    return F.count_if(F.coalesce(F.array_contains(arr, value), F.lit(False)))


def ranked_rollup(exploded: DataFrame, item: str,
                  pivots: Sequence[tuple[str, str, object]],
                  count_alias: str = "vacancies_count") -> DataFrame:
    """A7 core: group the fanned-out rows by item, count them and count the rows whose
    array pivots contain each value. ``pivots`` = [(alias, array_col, value), ...].

    Counts are element occurrences, equal to distinct keys only when arrays hold no
    repeats. A popular item is combined map-side before the shuffle.
    """
    aggs = [F.count(F.lit(1)).alias(count_alias)]
    aggs += [count_if_contains(arr, v).alias(alias) for alias, arr, v in pivots]
    return exploded.groupBy(item).agg(*aggs)


def skills_top(silver: DataFrame, key: str = "vacancy_id",
               order: Sequence[str] = ("ingested_at", "snapshot_id"),
               arr: str = "skills", item: str = "skill",
               pivots: Sequence[tuple[str, str, object]] = (),
               carry: Sequence[str] = ("matched_roles", "matched_areas"),
               count_alias: str = "vacancies_count") -> DataFrame:
    """Latest row per key (A3) -> fan out the array (A5) -> ranked rollup."""
    latest = latest_per_key(silver, key, order, [arr, *carry])
    return ranked_rollup(unnest(latest, arr, item), item, pivots, count_alias)


def top_k(df: DataFrame, order: Sequence[str], k: int = 20,
          tiebreak: Sequence[str] = ()) -> DataFrame:
    """O1: ``ORDER BY order DESC, tiebreak ASC LIMIT k`` (TakeOrderedAndProject: each
    task keeps k rows, the driver merges k x tasks rows)."""
    return df.orderBy(*[F.col(c).desc() for c in order],
                      *[F.col(c).asc() for c in tiebreak]).limit(k)
