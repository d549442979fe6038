"""Best row per key and matched slice sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("snapshot_id", "vacancy_id")
ORDER = ("quality_score", "description_length", "ingested_at")
SETS = {"matched_roles": "search_text", "matched_areas": "search_area"}


def _order_desc(order: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in order]


def best_row(df: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER,
             cols: Sequence[str] | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order DESC) = 1``.

    ``order`` must be a total order within a key (append tie-break columns such as the
    slice columns and page number), or the winner is not deterministic. Spark plans a
    partial WindowGroupLimit before the shuffle, so each map task ships at most one
    row per key and a hot key does not land whole in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*_order_desc(order))
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    if cols is not None:
        out = out.select(*keys, *[c for c in cols if c not in keys])
    return out


def matched(df: DataFrame, keys: Sequence[str] = KEYS,
            sets: Mapping[str, str] = SETS, count_alias: str = "matched_rows") -> DataFrame:
    """A1: distinct values of each slice column (sorted, source order is unspecified)
    and the row count per key."""
    aggs = [F.array_sort(F.collect_set(src)).alias(out) for out, src in sets.items()]
    aggs.append(F.count(F.lit(1)).alias(count_alias))
    return df.groupBy(*keys).agg(*aggs)


def best_with_matches(df: DataFrame, keys: Sequence[str] = KEYS,
                      order: Sequence[str] = ORDER, cols: Sequence[str] | None = None,
                      sets: Mapping[str, str] = SETS,
                      count_alias: str = "matched_rows") -> DataFrame:
    """W1 left-joined to A1 on the key (the reference's two-pass shape).

    Both sides come from the same rows, so every best row finds its match; the fused
    :func:`best_row_fused` computes the same result with one shuffle.
    """
    return best_row(df, keys, order, cols).join(matched(df, keys, sets, count_alias),
                                                 list(keys), "left")


def arg_extreme(order: Sequence[str], cols: Sequence[str], largest: bool = True):
    """One aggregate that picks the whole row first under ``order``: ``max`` (or
    ``min``) of a struct whose leading fields are the order columns. One struct
    comparison per row instead of two (``max_by``), and equal orders are settled by the
    remaining fields, so the pick is deterministic. A NULL field sorts lowest."""
    fields = list(dict.fromkeys([*order, *cols]))
    s = F.struct(*[F.col(c) for c in fields])
    return F.max(s) if largest else F.min(s)


def set_aggregates(sets: Mapping[str, str]) -> list:
    """Aggregates for sorted distinct-value arrays; every value that occurs is kept."""
    return [F.array_sort(F.collect_set(src)).alias(out) for out, src in sets.items()]


def best_row_fused(df: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER,
                   cols: Sequence[str] | None = None, sets: Mapping[str, str] = SETS,
                   count_alias: str = "matched_rows") -> DataFrame:
    """W1 and A1 in one aggregate (one exchange).

    The best row is ``max(struct(order..., cols...))`` (:func:`arg_extreme`), the same
    row ``ORDER BY order DESC`` ranks first. Every aggregate is partial: a map task
    keeps one candidate struct, one set entry per slice value and one counter per key, so
    skewed keys are combined before the shuffle. The set aggregate makes it an object hash
    aggregate; beyond ``spark.sql.objectHashAggregate.sortBased.fallbackThreshold`` keys a
    task (128 unless set) Spark goes on by sorting. Keep very wide columns out of ``cols``
    when keys rarely repeat; then W1 moves less data.
    """
    cols = [c for c in (cols if cols is not None else df.columns) if c not in keys]
    aggs = [arg_extreme(order, cols).alias("_best"), *set_aggregates(sets),
            F.count(F.lit(1)).alias(count_alias)]
    return (df.groupBy(*keys).agg(*aggs)
            .select(*keys, *[F.col("_best")[c].alias(c) for c in cols],
                    *sets, count_alias))
