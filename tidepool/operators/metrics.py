"""Metric-series evaluation (M1-M10, J5) over a long table of samples.

Series identity: a MAP of labels groups fine but cannot be a window partition or
join key, so a canonical text id (sorted labels as JSON) is derived once.

Windows never take a whole series: samples are cut into time buckets, each bucket
also receives a *halo* of the samples within the look-back range before it, and the
windows run per (series, bucket). What must reach further back (the start of a
condition that may hold for days) is carried across buckets by a prefix over a
per-bucket summary (one row per series and bucket). A series holding a third of
all samples is therefore spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

US = 1_000_000


def series_id(labels) -> Column:
    """Canonical series id: labels sorted by name, as JSON text."""
    labels = F.col(labels) if isinstance(labels, str) else labels
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(labels))))


def epoch_us(ts) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp"))


def _with_halo(df: DataFrame, t: str, bucket_us: int, halo_us: int) -> DataFrame:
    """Own bucket ``_own``; ``_part`` = own bucket plus a copy into every later bucket
    whose look-back halo reaches back to the row (``t >= start(j) - halo``)."""
    own = F.floor(F.col(t) / F.lit(bucket_us))
    last = F.floor((F.col(t) + F.lit(halo_us)) / F.lit(bucket_us))
    return df.withColumn("_own", own).withColumn("_part", F.explode(F.sequence(own, last)))


def running_total(df: DataFrame, keys: Sequence[str], ts: str, value: str,
                  order: Sequence[str], bucket_s: int = 3600, out: str = "running") -> DataFrame:
    """Cumulative sum of ``value`` per key under ``order`` (a counter built from
    increments), as a bucketed prefix sum: per-bucket totals -> running offset per
    key over the bucket summary -> local running sum inside each bucket."""
    b_us = bucket_s * US
    d = df.withColumn("_t", epoch_us(ts)).withColumn("_b", F.floor(F.col("_t") / F.lit(b_us)))
    per = d.groupBy(*keys, "_b").agg(F.sum(value).alias("_bs"))
    off = per.select(*keys, "_b", F.sum("_bs").over(
        Window.partitionBy(*keys).orderBy("_b")
        .rowsBetween(Window.unboundedPreceding, -1)).alias("_off"))
    w = Window.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast(d.schema[value].dataType)
    return (d.join(off, [*keys, "_b"])
            .withColumn(out, F.coalesce(F.col("_off"), zero) + F.sum(value).over(w))
            .drop("_t", "_b", "_off"))


def counter_rate(df: DataFrame, series: Sequence[str], ts: str, value: str,
                 range_s: int, order: Sequence[str] = (), bucket_s: int | None = None) -> DataFrame:
    """M1: per sample, the counter increase over the trailing ``(t - range, t]`` and
    the per-second rate. A drop (counter reset) counts the new value as the increase.
    Only increases between two samples inside the range count (the first sample of
    the range is the baseline), so a range with fewer than two samples gives NULL;
    edge extrapolation is not applied.

    A task window holds one series' samples of a bucket and the range before it; the
    bucket defaults to the range, the smallest that keeps a sample in two windows at most,
    so a dense series is cut as finely as its own frames allow."""
    r_us = range_s * US
    b_us = (bucket_s or range_s) * US
    d = _with_halo(df.withColumn("_t", epoch_us(ts)), "_t", b_us, r_us)
    part = [*series, "_part"]
    w_lag = Window.partitionBy(*part).orderBy("_t", *order)
    prev = F.lag(value).over(w_lag)
    d = d.withColumn("_inc", F.when(prev.isNull(), F.lit(None))
                     .when(F.col(value) < prev, F.col(value)).otherwise(F.col(value) - prev))
    frame = Window.partitionBy(*part).orderBy("_t").rangeBetween(-(r_us - 1), 0)
    inc = F.when(F.count(F.lit(1)).over(frame) >= 2,
                 F.sum("_inc").over(frame) - F.coalesce(F.first("_inc").over(frame), F.lit(0)))
    out = d.withColumn("increase", inc).filter(F.col("_part") == F.col("_own"))
    return (out.withColumn("rate", F.col("increase").cast("double") / F.lit(float(range_s)))
            .drop("_t", "_own", "_part", "_inc"))


def sustained(df: DataFrame, series: Sequence[str], ts: str, cond: str, hold_s: int,
              cadence_s: int, bucket_s: int = 86400) -> DataFrame:
    """M2: a sample fires when ``cond`` has held on every sample since the island
    started at least ``hold_s`` ago; a false sample or a missing one (gap above the
    cadence) ends the island. Adds ``island_start`` (timestamp) and ``firing``."""
    c_us, b_us = cadence_s * US, bucket_s * US
    d = _with_halo(df.withColumn("_t", epoch_us(ts)), "_t", b_us, c_us)
    part = [*series, "_part"]
    w = Window.partitionBy(*part).orderBy("_t")
    prev_t, prev_c = F.lag("_t").over(w), F.lag(cond).over(w)
    start = F.col(cond) & (prev_c.isNull() | ~prev_c | ((F.col("_t") - prev_t) > c_us))
    own = (d.withColumn("_start", start).filter(F.col("_part") == F.col("_own"))
           .drop("_part"))
    # Latest island start per (series, bucket), carried forward over earlier buckets.
    per = own.groupBy(*series, "_own").agg(
        F.max(F.when(F.col("_start"), F.col("_t"))).alias("_bmax"))
    carry = per.select(*series, "_own", F.max("_bmax").over(
        Window.partitionBy(*series).orderBy("_own")
        .rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    w_in = Window.partitionBy(*series, "_own").orderBy("_t").rowsBetween(
        Window.unboundedPreceding, 0)
    start_us = F.coalesce(F.max(F.when(F.col("_start"), F.col("_t"))).over(w_in),
                          F.col("_carry"))
    out = own.join(carry, [*series, "_own"]).withColumn(
        "_is", F.when(F.col(cond), start_us))
    return (out.withColumn("island_start", F.timestamp_micros("_is"))
            .withColumn("firing", F.coalesce(F.col(cond), F.lit(False))
                        & ((F.col("_t") - F.col("_is")) >= hold_s * US))
            .drop("_t", "_own", "_start", "_carry", "_is"))


def latest_value(df: DataFrame, series: Sequence[str], ts: str, value: str,
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    """M3: the newest non-null value per series (partial max_by per task)."""
    best = F.max(F.struct(F.col(ts).alias("ts"),
                          *[F.col(c).alias(f"_tb{i}") for i, c in enumerate(tiebreak)],
                          F.col(value).alias("value")))
    return (df.filter(F.col(value).isNotNull()).groupBy(*series).agg(best.alias("_l"))
            .select(*series, "_l.value", "_l.ts"))


def agg_by(df: DataFrame, by: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """M4: ``avg by`` / ``sum by`` / ``count(cond)`` style aggregation over labels.
    Groups with no samples produce no row (not 0)."""
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in aggs.items()])


def count_matching(df: DataFrame, by: Sequence[str], cond: Column,
                   alias: str = "value") -> DataFrame:
    """M4 ``count(expr) by (labels)``: samples where ``cond`` holds, counted per group;
    a group with no matching sample has no row (not 0)."""
    return df.filter(cond).groupBy(*by).agg(F.count(F.lit(1)).alias(alias))


def match(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """One-to-one vector matching: inner equi-join of two series sets on the
    shared labels and the sample time."""
    return a.join(b, list(on), "inner")


def asof_match(a: DataFrame, b: DataFrame, on: Sequence[str], a_ts: str, b_ts: str,
               lookback_s: int, order: Sequence[str] = ()) -> DataFrame:
    """J5 with staleness: every row of ``a`` with the newest row of ``b`` of the same labels
    in ``(t - lookback, t]`` (ties: the last under ``order``), or NULL columns if that range
    has none. Columns of ``b`` other than the labels must not clash with those of ``a``.

    Both sides are cut into time buckets of one look-back; a row of ``b`` is also copied
    into the next bucket, which is as far as it can be seen. So a window holds two
    look-backs of a series and a hot series spreads over tasks by time. Labels match
    null-safely; rows without a time are never seen, and match nothing.
    """
    on, l_us = list(on), lookback_s * US
    mine, theirs = list(a.columns), [c for c in b.columns if c not in on]
    left = (a.withColumn("_t", epoch_us(a_ts)).withColumn("_part", F.floor(F.col("_t") / F.lit(l_us)))
            .select(*on, "_part", "_t", F.lit(1).alias("_side"), F.struct(*mine).alias("_a"),
                    F.lit(None).cast(b.select(F.struct(*theirs).alias("x")).schema["x"].dataType)
                    .alias("_b")))
    right = b.withColumn("_t", epoch_us(b_ts)).where(F.col("_t").isNotNull())
    right = (_with_halo(right, "_t", l_us, l_us - 1)
             .groupBy(*on, "_part", "_t").agg(F.max(F.struct(*order, F.struct(*theirs).alias("_v")))
                                              .alias("_m"))
             .select(*on, "_part", "_t", F.lit(0).alias("_side"),
                     F.lit(None).cast(left.schema["_a"].dataType).alias("_a"),
                     F.col("_m._v").alias("_b")))
    w = Window.partitionBy(*on, "_part").orderBy("_t", "_side").rowsBetween(
        Window.unboundedPreceding, 0)
    seen = F.last(F.when(F.col("_b").isNotNull(), F.struct("_t", "_b")), ignorenulls=True).over(w)
    return (left.unionByName(right).withColumn("_s", seen).where("_side = 1")
            .withColumn("_hit", F.when(F.col("_s._t") > F.col("_t") - l_us, F.col("_s._b")))
            .select("_a.*", *[F.col("_hit")[c].alias(c) for c in theirs]))


def instant_vector(df: DataFrame, series: Sequence[str], ts: str, value: str, step_s: int,
                   lookback_s: int, order: Sequence[str] = ()) -> DataFrame:
    """The value of every series at every evaluation step (``at``, multiples of ``step_s``):
    its newest sample in ``(at - lookback, at]`` (ties: the last under ``order``); a series
    without one there has no row. NULL values count as absent.

    Each sample is offered to the steps that can see it, ``lookback / step`` of them at
    most, and the newest wins in a combining aggregate on (series, step), so no task
    gathers a series. Two such vectors match on labels and step whatever the times at
    which their samples were taken.
    """
    s_us, l_us = step_s * US, lookback_s * US
    d = df.where(F.col(value).isNotNull() & F.col(ts).isNotNull()).withColumn("_t", epoch_us(ts))
    first = F.ceil(F.col("_t") / F.lit(s_us))
    last = F.floor((F.col("_t") + F.lit(l_us - 1)) / F.lit(s_us))
    steps = F.when(first <= last, F.sequence(first, last))
    newest = F.max(F.struct("_t", *order, F.col(value).alias("_v")))
    return (d.withColumn("_step", F.explode(steps)).groupBy(*series, "_step")
            .agg(newest.alias("_n"))
            .select(*series, F.timestamp_micros(F.col("_step") * F.lit(s_us)).alias("at"),
                    F.col("_n._v").alias(value)))


def ratio_pct(a, b) -> Column:
    """M5: ``(1 - a / b) * 100``; NULL when b is 0."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.when(b == 0, F.lit(None)).otherwise((F.lit(1.0) - a / b) * F.lit(100.0))


def select_series(df: DataFrame, labels: str, matchers: Sequence[tuple[str, str, str]]) -> DataFrame:
    """M7: label matchers ``=``, ``!=``, ``=~``, ``!~``; regexes are anchored and a
    missing label matches as ''."""
    cond = F.lit(True)
    for key, op, val in matchers:
        v = F.coalesce(F.col(labels)[key], F.lit(""))
        if op == "=":
            c = v == F.lit(val)
        elif op == "!=":
            c = v != F.lit(val)
        elif op == "=~":
            c = v.rlike(f"^(?:{val})$")
        elif op == "!~":
            c = ~v.rlike(f"^(?:{val})$")
        else:
            raise ValueError(op)
        cond = cond & c
    return df.filter(cond)


def inhibit(alerts: DataFrame, equal: Sequence[str] = ("alertname", "instance"),
            at: str = "ts", source: str = "critical", target: str = "warning",
            severity: str = "severity") -> DataFrame:
    """M9: a firing ``source`` alert hides ``target`` alerts with equal labels at the
    same evaluation time."""
    keys = [*equal, at]
    src = alerts.filter(F.col(severity) == source).select(*keys).distinct()
    hidden = alerts.filter(F.col(severity) == target).join(src, keys, "left_anti")
    return alerts.filter(F.col(severity) != target).unionByName(hidden)


def group_alerts(alerts: DataFrame, by: Sequence[str] = ("alertname", "severity"),
                 ts: str = "ts", group_wait_s: int = 30, group_interval_s: int = 300) -> DataFrame:
    """M10 (batch form): per group, alert count, first/last time and the number of
    notifications, one per ``group_interval`` slot (shifted by ``group_wait``) that
    holds alerts. The timing of a live router is a stream concern."""
    slot = F.floor((epoch_us(ts) - F.lit(group_wait_s * US)) / F.lit(group_interval_s * US))
    return alerts.groupBy(*by).agg(F.count(F.lit(1)).alias("n_alerts"),
                                   F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
                                   F.count_distinct(slot).alias("n_notifications"))


def prefix_max_before(df: DataFrame, keys: Sequence[str], t: str, order: Sequence[str],
                      value: str, bucket_us: int, out: str) -> DataFrame:
    """For every row, the max of ``value`` over the rows of its key that come before it
    (under ``t`` then ``order``), as a bucketed prefix: per-bucket maxima carried over
    earlier buckets, plus a window inside the row's own bucket."""
    d = df.withColumn("_pb", F.floor(F.col(t) / F.lit(bucket_us)))
    per = d.groupBy(*keys, "_pb").agg(F.max(value).alias("_bm"))
    carry = per.select(*keys, "_pb", F.max("_bm").over(
        Window.partitionBy(*keys).orderBy("_pb").rowsBetween(Window.unboundedPreceding, -1))
        .alias("_carry"))
    w = Window.partitionBy(*keys, "_pb").orderBy(t, *order).rowsBetween(
        Window.unboundedPreceding, -1)
    return (d.join(carry, [*keys, "_pb"])
            .withColumn(out, F.greatest(F.max(value).over(w), F.col("_carry")))
            .drop("_pb", "_carry"))


def notifications(alerts: DataFrame, by: Sequence[str] = ("alertname", "severity"),
                  instance: str = "instance", ts: str = "ts", cadence_s: int = 60,
                  group_wait_s: int = 30, group_interval_s: int = 300,
                  repeat_interval_s: int = 4 * 3600, resolve_timeout_s: int = 300,
                  bucket_s: int = 86400) -> DataFrame:
    """Notifications a grouping router sends for alert rows (one row per firing
    alert per evaluation).

    * An *episode* of an alert is a run of evaluations with gaps up to ``cadence_s``;
      it resolves ``resolve_timeout_s`` after its last evaluation.
    * A group *session* is a maximal union of overlapping episodes of the group; a
      group that has fully resolved starts a new session (and waits again).
    * Within a session, flush ticks fall every ``group_interval_s`` from session start
      + ``group_wait_s``; a tick notifies when an episode started or resolved since
      the previous tick, and otherwise re-notifies once ``repeat_interval_s`` has
      passed since the last notification.

    Episodes use the bucketed island logic of :func:`sustained`. Sessions depend on times
    only: episodes of a group are reduced to distinct (start, end) times in every map task,
    so the rows of a group and bucket are bounded by evaluation times, whatever the number
    of instances, and starts are then walked with a bucketed prefix max.
    """
    by = list(by)
    keys = [*by, instance]
    flagged = sustained(alerts.select(*keys, ts).withColumn("_on", F.lit(True)), keys, ts,
                        "_on", 0, cadence_s, bucket_s)
    res_us = resolve_timeout_s * US
    episodes = (flagged.groupBy(*keys, "island_start")
                .agg(F.count(F.lit(1)).alias("_n"), F.max(ts).alias("_last"))
                .select(*keys, "_n", epoch_us("island_start").alias("_s"),
                        (epoch_us("_last") + F.lit(res_us)).alias("_e")))
    b_us = bucket_s * US
    spans = episodes.select(*by, "_s", "_e").distinct()
    ep = prefix_max_before(spans.groupBy(*by, "_s").agg(F.max("_e").alias("_e")), by, "_s", [],
                           "_e", b_us, "_prev_end")
    ep = ep.withColumn("_sess_start", F.when(
        F.col("_prev_end").isNull() | (F.col("_s") > F.col("_prev_end")), F.col("_s")))
    ep = prefix_max_before(ep, by, "_s", [], "_sess_start", b_us, "_sess_prev")
    ep = spans.join(ep.select(*by, "_s", F.coalesce("_sess_start", "_sess_prev").alias("_sess")),
                    [*by, "_s"])
    # change events (episode start and resolution) -> flush tick index in the session
    iv = F.lit(group_interval_s * US)
    changes = ep.select(*by, "_sess", F.explode(F.array("_s", "_e")).alias("_ev"))
    changes = changes.select(*by, "_sess", F.greatest(
        F.ceil((F.col("_ev") - (F.col("_sess") + F.lit(group_wait_s * US))) / iv),
        F.lit(0)).alias("_tick")).distinct()
    r_ticks = -(-repeat_interval_s // group_interval_s)
    w = Window.partitionBy(*by, "_sess").orderBy("_tick")
    gaps = changes.withColumn("_next", F.lead("_tick").over(w))
    repeats = F.coalesce(F.floor((F.col("_next") - F.col("_tick") - 1) / F.lit(r_ticks)),
                         F.lit(0))
    per_session = gaps.groupBy(*by, "_sess").agg(
        (F.count(F.lit(1)) + F.sum(repeats)).alias("_notes"))
    per_group_eps = episodes.groupBy(*by).agg(F.sum("_n").alias("n_alerts"),
                                              F.count(F.lit(1)).alias("n_episodes"),
                                              F.min("_s").alias("_first"))
    per_group = per_session.groupBy(*by).agg(F.count(F.lit(1)).alias("n_sessions"),
                                            F.sum("_notes").cast("long").alias("n_notifications"))
    return (per_group_eps.join(per_group, by)
            .select(*by, "n_alerts", "n_episodes", "n_sessions", "n_notifications",
                    F.timestamp_micros("_first").alias("first_ts")))
