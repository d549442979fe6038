"""Data-quality checks and pipeline gates.

Checks return failing rows or failure counts as DataFrames; gates run one small
action, raise on failure and return the statistics they looked at.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators import snapshots
from tidepool.session import bounded_broadcast


class GateError(RuntimeError):
    """A pipeline gate refused to let the run continue."""


def _where(df: DataFrame, where: Column | str | None) -> DataFrame:
    if where is None:
        return df
    return df.filter(F.expr(where) if isinstance(where, str) else where)


# ---------------------------------------------------------------- column checks


def not_null(df: DataFrame, col: str, where: Column | str | None = None) -> DataFrame:
    """Failing rows (``col IS NULL``)."""
    return _where(df, where).filter(F.col(col).isNull())


def accepted_values(df: DataFrame, col: str, values: Sequence, where=None) -> DataFrame:
    """Failing rows (value outside the list). NULL does not fail: ``NOT IN`` over a
    NULL is NULL, which the filter drops."""
    return _where(df, where).filter(~F.col(col).isin(list(values)))


def check_counts(df: DataFrame, not_null_cols: Sequence[str] = (),
                 accepted: Mapping[str, Sequence] | None = None,
                 where: Column | str | None = None) -> DataFrame:
    """D1 + D2 batched: every check of one table as one ``count_if`` in a single
    aggregate (one scan, partial aggregation), named ``not_null__c`` /
    ``accepted__c``. One row of failure counts."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"not_null__{c}") for c in not_null_cols]
    for c, vals in (accepted or {}).items():
        aggs.append(F.count_if(~F.col(c).isin(list(vals))).alias(f"accepted__{c}"))
    return _where(df, where).agg(*aggs)


def assert_no_failures(counts: DataFrame) -> dict[str, int]:
    """Run the batched checks (one row to the driver) and raise on any failure."""
    row = counts.first().asDict()
    bad = {k: v for k, v in row.items() if v}
    if bad:
        raise GateError(f"data tests failed: {bad}")
    return row


def observe_checks(df: DataFrame, name: str, not_null_cols: Sequence[str] = (),
                   scope: Column | None = None, scoped_not_null: Sequence[str] = (),
                   scoped_accepted: Mapping[str, Sequence] | None = None
                   ) -> tuple[DataFrame, Observation]:
    """D1 + D2 without a scan of their own: ``df`` that counts its failing rows while
    something else reads it, and the observation that holds the counts afterwards.

    ``not_null_cols`` look at every row, the scoped checks at rows where ``scope`` holds.
    Names are those of :func:`check_counts`. The counts are exact about zero: a stage that
    runs again after an executor was lost can count a failing row twice, never hide one.
    """
    scope = F.lit(True) if scope is None else scope
    aggs = [F.count_if(F.col(c).isNull()).alias(f"not_null__{c}") for c in not_null_cols]
    aggs += [F.count_if(scope & F.col(c).isNull()).alias(f"not_null__{c}")
             for c in scoped_not_null]
    aggs += [F.count_if(scope & ~F.col(c).isin(list(vals))).alias(f"accepted__{c}")
             for c, vals in (scoped_accepted or {}).items()]
    seen = Observation(name)
    return df.observe(seen, *aggs), seen


def assert_observed(*seen: Observation) -> dict[str, int]:
    """Raise on any failure that the observations of a finished write counted."""
    counts = {k: v for o in seen for k, v in o.get.items()}
    bad = {k: v for o in seen for k, v in o.get.items() if v}
    if bad:
        raise GateError(f"data tests failed: {bad}")
    return counts


def unique_violations(df: DataFrame, keys: Sequence[str],
                      count_alias: str = "n_rows") -> DataFrame:
    """Key groups that occur more than once (partial count per task, so a
    hot key is combined before the shuffle)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_alias))
            .filter(F.col(count_alias) > 1))


def orphans(child: DataFrame, parent: DataFrame, child_key: str,
            parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent; NULL keys are not orphans (a nullable
    foreign key is allowed to be empty)."""
    pk = parent_key or child_key
    parents = parent.select(F.col(pk).alias(child_key))
    return child.filter(F.col(child_key).isNotNull()).join(parents, child_key, "left_anti")


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key tuples (partial distinct per task before the shuffle)."""
    return df.select(*keys).distinct()


def grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row count against exact distinct key tuples (equal when the grain holds)."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct(*[F.col(k) for k in keys]).alias("unique_keys"))


def partial_rows(silver: DataFrame, complete: DataFrame,
                 sid: str = "snapshot_id") -> DataFrame:
    """Count of silver rows whose snapshot is not complete (must be 0)."""
    ids = bounded_broadcast(complete.select(sid))
    return silver.join(ids, sid, "left_anti").agg(F.count(F.lit(1)).alias("partial_rows"))


# ---------------------------------------------------------------- gates

BRONZE_STATS_SCHEMA = T.StructType([
    T.StructField("snapshot_id", T.StringType()),
    T.StructField("combos", T.LongType()),
    T.StructField("rows", T.LongType()),
    T.StructField("unique_keys", T.LongType()),
    T.StructField("first_row", T.StringType()),
    T.StructField("last_row", T.StringType()),
])


@dataclass
class BronzeStats:
    snapshot_id: str
    combos: int
    rows: int
    unique_keys: int
    first_row: str
    last_row: str
    status: str

    def as_row(self) -> tuple:
        d = asdict(self)
        return tuple(d[f.name] for f in BRONZE_STATS_SCHEMA.fields)


def bronze_gate(df: DataFrame, snapshot=None, sid: str = "snapshot_id",
                slices: Sequence[str] = ("search_text", "search_area"), n: int = 6,
                key: str = "vacancy_id", ts: str = "ingested_at") -> BronzeStats:
    """Pick the snapshot (given, else the latest complete one), compute its A9
    statistics and fail when it is absent or has fewer than ``n`` slices.

    A snapshot with more than ``n`` slices passes this gate but is dropped by the exact
    completeness filter of silver; it is reported as ``over_complete`` so the later
    silver gate failure is explained.
    """
    if snapshot is None:
        snapshot = snapshots.latest_complete_id(df, sid, slices, n, ts)
        if snapshot is None:
            raise GateError(f"no complete snapshot with {n} slices")
    row = snapshots.snapshot_stats(df, snapshot, sid, slices, key, ts).first()
    if row is None or row["rows"] == 0:
        raise GateError(f"snapshot {snapshot} not found")
    if row["combos"] < n:
        raise GateError(f"snapshot {snapshot} is partial: {row['combos']}/{n} slices")
    status = "over_complete" if row["combos"] > n else "complete"
    fmt = "%Y-%m-%d %H:%M:%S"
    return BronzeStats(str(snapshot), row["combos"], row["rows"], row["unique_keys"],
                       row["first_row"].strftime(fmt), row["last_row"].strftime(fmt), status)


def silver_stats(df: DataFrame, keys: Sequence[str], counts: Mapping[str, Column],
                 mean_of: str | None = None, mean_alias: str = "avg_len") -> DataFrame:
    """A10: rows, exact distinct keys, conditional counts and a half-even rounded mean
    in one aggregate. (An approximate distinct in an equality test fails spuriously at
    scale, so the key count is exact.) Empty input gives a NULL mean."""
    aggs = [F.count(F.lit(1)).alias("silver_rows"),
            F.count_distinct(*[F.col(k) for k in keys]).alias("unique_keys")]
    aggs += [F.count_if(cond).alias(name) for name, cond in counts.items()]
    if mean_of:
        aggs.append(F.bround(F.avg(mean_of), 0).cast("double").alias(mean_alias))
    return df.agg(*aggs)


def silver_gate(silver: DataFrame, snapshot, keys: Sequence[str],
                counts: Mapping[str, Column], mean_of: str | None = None,
                mean_alias: str = "avg_len", sid: str = "snapshot_id") -> DataFrame:
    """Fail when the snapshot is missing from silver or its grain is broken;
    return the statistics (one row)."""
    stats = silver_stats(snapshots.for_snapshot(silver, snapshot, sid), keys, counts,
                         mean_of, mean_alias)
    row = stats.first()
    if row["silver_rows"] == 0:
        raise GateError(f"snapshot {snapshot} is in bronze but not in silver")
    if row["silver_rows"] != row["unique_keys"]:
        raise GateError(f"silver grain broken: {row['silver_rows']} rows, "
                        f"{row['unique_keys']} keys")
    spark = silver.sparkSession
    return spark.createDataFrame([tuple(row)], stats.schema)
