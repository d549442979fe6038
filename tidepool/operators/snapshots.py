"""Snapshot completeness and snapshot-level statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.session import bounded_broadcast

SID = "snapshot_id"
SLICES = ("search_text", "search_area")
TS = "ingested_at"


def _slice_count(slices: Sequence[str]) -> Column:
    # count(DISTINCT a, b) skips tuples with a NULL member, like a NULL concatenation
    # would be skipped by an exact distinct count. A struct key would also avoid the
    # collisions a 'a|b' string key allows when values contain the separator.
    return F.count_distinct(*[F.col(c) for c in slices])


def complete_snapshots(df: DataFrame, sid: str = SID, slices: Sequence[str] = SLICES,
                       n: int = 6, manifest: DataFrame | None = None) -> DataFrame:
    """snapshot ids that hold exactly ``n`` distinct slices.

    Planned as a two-level distinct aggregate: (sid, slice) is combined map-side first,
    so a snapshot holding a third of all rows still shrinks to <= n rows per task
    before the shuffle. ``manifest`` (sid + slice columns, one row per slice that
    finished landing, empty ones included) lets a legitimately empty slice count;
    without it completeness is derived from the rows alone.
    """
    keys = df.select(sid, *slices)
    if manifest is not None:
        keys = keys.unionByName(manifest.select(sid, *slices))
    return (keys.groupBy(sid).agg(_slice_count(slices).alias("n_slices"))
            .filter(F.col("n_slices") == n))


def keep_complete(df: DataFrame, complete: DataFrame, sid: str = SID,
                  max_broadcast_rows: int | None = None) -> DataFrame:
    """rows of complete snapshots (``sid IN (SELECT ...)`` as a left semi join).

    The id set is one row per snapshot; it is materialised once and broadcast only
    when its measured size is under the bound, otherwise the semi join shuffles.
    """
    ids = complete.select(sid)
    ids = bounded_broadcast(ids, max_broadcast_rows) if max_broadcast_rows else bounded_broadcast(ids)
    return df.join(ids, sid, "left_semi")


def snapshot_summary(df: DataFrame, sid: str = SID, slices: Sequence[str] = SLICES,
                     ts: str = TS) -> DataFrame:
    """Per snapshot: distinct slices and newest ingest time."""
    return df.groupBy(sid).agg(_slice_count(slices).alias("n_slices"),
                               F.max(ts).alias("max_ts"))


def latest_complete(df: DataFrame, sid: str = SID, slices: Sequence[str] = SLICES,
                    n: int = 6, ts: str = TS) -> DataFrame:
    """the newest complete snapshot (one row: sid, n_slices, max_ts).

    The aggregate is computed first and ordered afterwards (ordering a grouped query
    by an unselected aggregate does not analyse in Spark SQL). Ties on the newest
    ingest time are broken by the snapshot id, descending.
    """
    return (snapshot_summary(df, sid, slices, ts).filter(F.col("n_slices") == n)
            .orderBy(F.col("max_ts").desc(), F.col(sid).desc()).limit(1))


def latest_complete_id(df: DataFrame, sid: str = SID, slices: Sequence[str] = SLICES,
                       n: int = 6, ts: str = TS) -> str | None:
    """F3 as a driver value (one row), for gates and parameterised filters."""
    row = latest_complete(df, sid, slices, n, ts).select(sid).first()
    return None if row is None else row[0]


def for_snapshot(df: DataFrame, value, sid: str = SID,
                 slice_values: dict[str, object] | None = None) -> DataFrame:
    """equality filter on a snapshot id (and optionally slice values).

    A literal predicate, so it reaches the Parquet scan as a pushed filter and prunes
    row groups when bronze is sorted by snapshot inside its month partitions.
    """
    cond = F.col(sid) == F.lit(value)
    for c, v in (slice_values or {}).items():
        cond = cond & (F.col(c) == F.lit(v))
    return df.filter(cond)


def where_latest(df: DataFrame, bronze: DataFrame, sid: str = SID,
                 slices: Sequence[str] = SLICES, n: int = 6, ts: str = TS) -> DataFrame:
    """rows of ``df`` from the latest complete snapshot of ``bronze``.

    The scalar subquery becomes a semi join against a one-row side (bounded by the
    LIMIT 1, so the broadcast is safe). With no complete snapshot nothing matches.
    """
    latest = F.broadcast(latest_complete(bronze, sid, slices, n, ts).select(sid))
    return df.join(latest, sid, "left_semi")


def distinct_per_snapshot(df: DataFrame, key: str, sid: str = SID,
                          alias: str = "n_distinct") -> DataFrame:
    """A2: exact distinct count of ``key`` per snapshot."""
    return df.groupBy(sid).agg(F.count_distinct(key).alias(alias))


def snapshot_stats(df: DataFrame, value=None, sid: str = SID,
                   slices: Sequence[str] = SLICES, key: str = "vacancy_id",
                   ts: str = TS, exact: bool = True) -> DataFrame:
    """Slices, rows, distinct ids, first and last ingest of one snapshot.

    ``value=None`` aggregates whatever ``df`` holds (callers pass an already filtered
    frame, e.g. from :func:`where_latest`).
    """
    src = df if value is None else for_snapshot(df, value, sid)
    uniq = F.count_distinct(key) if exact else F.approx_count_distinct(key)
    return src.agg(_slice_count(slices).alias("combos"),
                   F.count(F.lit(1)).alias("rows"),
                   uniq.alias("unique_keys"),
                   F.min(ts).alias("first_row"),
                   F.max(ts).alias("last_row"))


def table_stats(df: DataFrame, sid: str = SID, ts: str = TS) -> DataFrame:
    """Rows, exact distinct snapshots, newest ingest."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct(sid).alias("snapshots"),
                  F.max(ts).alias("max_ts"))


def snapshot_history(df: DataFrame, n: int = 3, sid: str = SID,
                     slices: Sequence[str] = SLICES, ts: str = TS) -> DataFrame:
    """Slice count of the newest ``n`` snapshots (a top-n report)."""
    return (snapshot_summary(df, sid, slices, ts)
            .orderBy(F.col("max_ts").desc(), F.col(sid).desc()).limit(n))
