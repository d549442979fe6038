"""Event rollups (A13, A14): daily counts, exact distinct users and amounts; keyed
summing merges, with mergeable sketches where a distinct count must be re-combined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AMOUNT = "decimal(18,2)"


def daily_rollup(events: DataFrame, ts: str = "event_time", kind: str = "event_type",
                 user: str = "user_id", amount: str = "amount") -> DataFrame:
    """(date, type) -> events, exact distinct users, total amount (decimal(18,2):
    the widened sum is cast back). Every aggregate is partial; the distinct count is
    planned as a (date, type, user) pre-aggregation, so a hot day/type is combined
    map-side."""
    return events.groupBy(F.to_date(ts).alias("event_date"), F.col(kind).alias("event_type")) \
        .agg(F.count(F.lit(1)).alias("events_count"),
             F.count_distinct(user).alias("unique_users"),
             F.sum(F.col(amount).cast(AMOUNT)).cast(AMOUNT).alias("total_amount"))


def summing_merge(df: DataFrame, keys: Sequence[str], sums: Sequence[str],
                  drop_all_zero: bool = True) -> DataFrame:
    """Collapse rows with equal key by summing the numeric columns; rows whose
    sums are all zero vanish (summing-merge semantics). A summed distinct count is not
    a distinct count: keep sketches (:func:`sketch_rollup`) for that."""
    out = df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    if drop_all_zero:
        nonzero = F.lit(False)
        for c in sums:
            nonzero = nonzero | (F.coalesce(F.col(c), F.lit(0)) != 0)
        out = out.filter(nonzero)
    return out


def sketch_rollup(events: DataFrame, keys: Sequence, user: str = "user_id",
                  lg_k: int = 12) -> DataFrame:
    """Per key: an HLL sketch of users (binary, mergeable across partial rollups)."""
    return events.groupBy(*keys).agg(F.hll_sketch_agg(user, lg_k).alias("users_sketch"))


def merge_sketches(df: DataFrame, keys: Sequence[str], sketch: str = "users_sketch") -> DataFrame:
    """Union partial sketches per key and estimate the distinct users."""
    return df.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias("unique_users_approx"))


def bitmap_rollup(events: DataFrame, keys: Sequence, user: str = "user_id") -> DataFrame:
    """Per key and bucket of users: a bitmap of the users seen (integer ids; 32,768 to a
    bucket of 4 KB). Partial rollups over any split of the events merge exactly
    (:func:`merge_bitmaps`), so a key's users spread over as many rows as there are buckets
    and no task holds all of them. NULL users leave an empty bitmap: the key stays."""
    return events.groupBy(*keys, F.bitmap_bucket_number(user).alias("users_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("users"))


def merge_bitmaps(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partial bitmaps of one key and bucket or-ed together; can itself be merged again."""
    return parts.groupBy(*keys, "users_bucket").agg(F.bitmap_or_agg("users").alias("users"))


def bitmap_users(rolled: DataFrame, keys: Sequence[str], alias: str = "unique_users") -> DataFrame:
    """Exact distinct users per key from merged bitmaps (one row per key and bucket)."""
    return rolled.groupBy(*keys).agg(F.sum(F.bitmap_count("users")).alias(alias))
