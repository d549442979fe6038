"""Alert-rule evaluation over series derived from ``events``.

Series: hourly event counts per event type (label ``type``), and per-user counters
(running amount that resets every day)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import text as X
from tidepool.functions.format import ts_text, ts_text_us
from tidepool.operators import metrics as M
from tidepool.plans.registry import query
from tidepool.sources.metric_table import event_metrics
from tidepool.sources.tables import read_table


def ev(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events")


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    """(event_type, hour, n): one sample per type and hour with events."""
    e = ev(spark, sf)
    return e.groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"))


HOURLY_SQL = """h AS (SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n
                    FROM events GROUP BY ALL)"""
RANGE_S = 21600


def counters(spark: SparkSession, sf: str) -> DataFrame:
    e = ev(spark, sf).select("user_id", "event_id", "ts",
                             F.col("value").cast("decimal(18,2)").alias("amount"),
                             F.to_date("ts").alias("day"))
    return M.running_total(e, ["user_id", "day"], "ts", "amount", ["ts", "event_id"],
                           bucket_s=3600, out="counter")


@query("m1_counter_rate", f"""
WITH c AS (SELECT user_id, event_id, ts, epoch_us(ts) AS t,
                  sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id, CAST(ts AS DATE)
                      ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS counter FROM events),
i AS (SELECT *, CASE WHEN lag(counter) OVER w IS NULL THEN NULL
                     WHEN counter < lag(counter) OVER w THEN counter
                     ELSE counter - lag(counter) OVER w END AS inc
      FROM c WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)),
r AS (SELECT *, CASE WHEN count(*) OVER f >= 2
                     THEN sum(inc) OVER f - coalesce(first_value(inc) OVER f, 0) END AS increase FROM i
      WINDOW f AS (PARTITION BY user_id ORDER BY t RANGE BETWEEN {RANGE_S * 1000000 - 1} PRECEDING
                   AND CURRENT ROW))
SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
       CAST(counter AS DOUBLE) AS counter, CAST(increase AS DOUBLE) AS increase,
       CAST(increase AS DOUBLE) / {float(RANGE_S)} AS rate FROM r""")
def m1_counter_rate(spark, sf):
    r = M.counter_rate(counters(spark, sf), ["user_id"], "ts", "counter", RANGE_S,
                       order=["event_id"])
    return r.select("user_id", "event_id", ts_text_us("ts").alias("ts"),
                    F.col("counter").cast("double").alias("counter"),
                    F.col("increase").cast("double").alias("increase"), "rate")


HOLD_S, CADENCE_S = 3 * 3600, 3600


@query("m2_for_duration", f"""
WITH {HOURLY_SQL},
s AS (SELECT *, n >= 3 AS cond, epoch_us(hour) AS t FROM h),
f AS (SELECT *, cond AND (lag(cond) OVER w IS NULL OR NOT lag(cond) OVER w
                          OR t - lag(t) OVER w > {CADENCE_S * 1000000}) AS st
      FROM s WINDOW w AS (PARTITION BY event_type ORDER BY t)),
g AS (SELECT *, CASE WHEN cond THEN max(CASE WHEN st THEN t END) OVER (PARTITION BY event_type
                ORDER BY t ROWS UNBOUNDED PRECEDING) END AS is_us FROM f)
SELECT event_type, strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, n, cond,
       strftime(make_timestamp(is_us), '%Y-%m-%d %H:%M:%S') AS island_start,
       coalesce(cond, false) AND t - is_us >= {HOLD_S * 1000000} AS firing FROM g""")
def m2_for_duration(spark, sf):
    h = hourly(spark, sf).withColumn("cond", F.col("n") >= 3)
    s = M.sustained(h, ["event_type"], "hour", "cond", HOLD_S, CADENCE_S, bucket_s=86400)
    return s.select("event_type", ts_text("hour").alias("hour"), "n", "cond",
                    ts_text("island_start").alias("island_start"), "firing")


@query("m3_instant_latest", """
SELECT user_id, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE value IS NOT NULL) WHERE rn = 1""")
def m3_instant_latest(spark, sf):
    lv = M.latest_value(ev(spark, sf), ["user_id"], "ts", "value", ["event_id"])
    return lv.select("user_id", "value", ts_text_us("ts").alias("ts"))


@query("m4_agg_by_label", f"""
WITH {HOURLY_SQL}
SELECT event_type, avg(n) AS avg_per_hour, CAST(sum(n) AS BIGINT) AS total,
       count(*) FILTER (WHERE n >= 5) AS hot_hours FROM h GROUP BY event_type""")
def m4_agg_by_label(spark, sf):
    return M.agg_by(hourly(spark, sf), ["event_type"],
                    {"avg_per_hour": F.avg("n"), "total": F.sum("n"),
                     "hot_hours": F.count_if(F.col("n") >= 5)})


@query("m4_count_matching", f"""
WITH {HOURLY_SQL}
SELECT event_type, strftime(CAST(hour AS DATE), '%Y-%m-%d') AS day, count(*) AS value
FROM h WHERE n >= 7 GROUP BY ALL""")
def m4_count_matching(spark, sf):
    """``count(hourly_events >= 7) by (type, day)``: days without such an hour have no row."""
    h = hourly(spark, sf)
    return M.count_matching(h, ["event_type", F.date_format("hour", "yyyy-MM-dd").alias("day")],
                            F.col("n") >= 7)


PER_HOUR_SQL = """t AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS total,
                         count(*) FILTER (WHERE event_type = 'error') AS errors,
                         count(DISTINCT event_type) AS kinds FROM events GROUP BY 1)"""


def per_hour(spark, sf):
    e = ev(spark, sf)
    return e.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.count_distinct("event_type").alias("kinds"))


@query("m5_ratio_alert", f"""
WITH {HOURLY_SQL}, e AS (SELECT hour, n AS errors FROM h WHERE event_type = 'error'),
{PER_HOUR_SQL}
SELECT strftime(t.hour, '%Y-%m-%d %H:%M:%S') AS hour, e.errors, t.total,
       (1.0 - e.errors / t.total) * 100.0 AS ok_pct,
       (1.0 - e.errors / t.total) * 100.0 > 80.0 AS firing
FROM e JOIN t ON e.hour = t.hour""")
def m5_ratio_alert(spark, sf):
    errors = hourly(spark, sf).filter(F.col("event_type") == "error").select(
        "hour", F.col("n").alias("errors"))
    totals = per_hour(spark, sf).select("hour", "total")
    j = M.match(errors, totals, ["hour"])
    return j.select(ts_text("hour").alias("hour"), "errors", "total",
                    M.ratio_pct("errors", "total").alias("ok_pct"),
                    (M.ratio_pct("errors", "total") > 80.0).alias("firing"))


@query("j5_series_match", f"""
WITH {HOURLY_SQL}
SELECT strftime(a.hour, '%Y-%m-%d %H:%M:%S') AS hour, a.n AS clicks, b.n AS views, a.n - b.n AS diff
FROM h a JOIN h b ON a.hour = b.hour WHERE a.event_type = 'click' AND b.event_type = 'view'""")
def j5_series_match(spark, sf):
    h = hourly(spark, sf)
    a = h.filter(F.col("event_type") == "click").select("hour", F.col("n").alias("clicks"))
    b = h.filter(F.col("event_type") == "view").select("hour", F.col("n").alias("views"))
    return M.match(a, b, ["hour"]).select(ts_text("hour").alias("hour"), "clicks", "views",
                                          (F.col("clicks") - F.col("views")).alias("diff"))


@query("m6_scaled_threshold", f"""
WITH {HOURLY_SQL}, a AS (SELECT hour, sum(n) AS total FROM h GROUP BY hour),
b AS (SELECT date_trunc('hour', ts) AS hour, count(DISTINCT event_type) * 3 AS capacity
      FROM events GROUP BY 1)
SELECT strftime(a.hour, '%Y-%m-%d %H:%M:%S') AS hour, CAST(a.total AS BIGINT) AS total,
       b.capacity, a.total > b.capacity * 0.8 AS firing FROM a JOIN b ON a.hour = b.hour""")
def m6_scaled_threshold(spark, sf):
    """``sum by (hour)(per-type counts) > capacity * 0.8``, capacity = 3 per active type."""
    a = hourly(spark, sf).groupBy("hour").agg(F.sum("n").alias("total"))
    b = per_hour(spark, sf).select("hour", (F.col("kinds") * 3).alias("capacity"))
    j = M.match(a, b, ["hour"])
    return j.select(ts_text("hour").alias("hour"), "total", "capacity",
                    (F.col("total") > F.col("capacity") * 0.8).alias("firing"))


def labelled(spark, sf):
    e = ev(spark, sf)
    k = F.get_json_object("props", "$.k")
    labels = F.create_map(F.lit("type"), F.col("event_type"), F.lit("k"), k)
    return e.select("event_id", labels.alias("labels"))


@query("m7_label_match", """
SELECT event_id, json_object('k', json_extract_string(props, '$.k'), 'type', event_type)::VARCHAR
       AS series_id
FROM events WHERE regexp_full_match(event_type, 'click|view')
  AND NOT regexp_full_match(coalesce(json_extract_string(props, '$.k'), ''), '1.*')
  AND coalesce(NULL, '') = ''""")
def m7_label_match(spark, sf):
    sel = M.select_series(labelled(spark, sf), "labels",
                          [("type", "=~", "click|view"), ("k", "!~", "1.*"), ("zone", "=", "")])
    return sel.select("event_id", M.series_id("labels").alias("series_id"))


STEPS = ((3, "yellow"), (5, "red"))


@query("m8_threshold_bands", f"""
WITH {HOURLY_SQL}
SELECT event_type, strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, n,
       CASE WHEN n >= 5 THEN 'red' WHEN n >= 3 THEN 'yellow' ELSE 'green' END AS band FROM h""")
def m8_threshold_bands(spark, sf):
    h = hourly(spark, sf)
    return h.select("event_type", ts_text("hour").alias("hour"), "n",
                    X.band("n", STEPS).alias("band"))


def alerts(spark, sf) -> DataFrame:
    """Alert instances: a warning for every firing M2 sample (3 h of >= 3 events per
    hour), a critical for every hour with >= 6 events."""
    h = hourly(spark, sf).withColumn("cond", F.col("n") >= 3)
    warn = (M.sustained(h, ["event_type"], "hour", "cond", HOLD_S, CADENCE_S)
            .filter("firing").select(F.col("event_type").alias("instance"),
                                     F.col("hour").alias("ts"),
                                     F.lit("warning").alias("severity")))
    crit = hourly(spark, sf).filter(F.col("n") >= 6).select(
        F.col("event_type").alias("instance"), F.col("hour").alias("ts"),
        F.lit("critical").alias("severity"))
    return warn.unionByName(crit).withColumn("alertname", F.lit("HighEventRate"))


ALERTS_SQL = f"""{HOURLY_SQL},
s AS (SELECT *, n >= 3 AS cond, epoch_us(hour) AS t FROM h),
f AS (SELECT *, cond AND (lag(cond) OVER w IS NULL OR NOT lag(cond) OVER w
                          OR t - lag(t) OVER w > {CADENCE_S * 1000000}) AS st
      FROM s WINDOW w AS (PARTITION BY event_type ORDER BY t)),
g AS (SELECT *, CASE WHEN cond THEN max(CASE WHEN st THEN t END) OVER (PARTITION BY event_type
                ORDER BY t ROWS UNBOUNDED PRECEDING) END AS is_us FROM f),
al AS (SELECT 'HighEventRate' AS alertname, event_type AS instance, hour AS ts,
              'warning' AS severity FROM g WHERE coalesce(cond, false) AND t - is_us >= {HOLD_S * 1000000}
       UNION ALL
       SELECT 'HighEventRate', event_type, hour, 'critical' FROM h WHERE n >= 6)"""


@query("m9_alert_inhibit", f"""
WITH {ALERTS_SQL}
SELECT alertname, instance, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, severity FROM al a
WHERE severity <> 'warning' OR NOT EXISTS (
  SELECT 1 FROM al c WHERE c.severity = 'critical' AND c.alertname = a.alertname
    AND c.instance = a.instance AND c.ts = a.ts)""")
def m9_alert_inhibit(spark, sf):
    out = M.inhibit(alerts(spark, sf))
    return out.select("alertname", "instance", ts_text("ts").alias("ts"), "severity")


@query("m10_alert_group", f"""
WITH {ALERTS_SQL}
SELECT alertname, severity, count(*) AS n_alerts,
       strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts,
       count(DISTINCT floor((epoch_us(ts) - 30000000) / 300000000)) AS n_notifications
FROM al GROUP BY alertname, severity""")
def m10_alert_group(spark, sf):
    g = M.group_alerts(alerts(spark, sf))
    return g.select("alertname", "severity", "n_alerts", ts_text("first_ts").alias("first_ts"),
                    ts_text("last_ts").alias("last_ts"), "n_notifications")


WAIT_S, INTERVAL_S, REPEAT_S, RESOLVE_S = 30, 300, 4 * 3600, 300


@query("m10_alert_notifications", f"""
WITH {ALERTS_SQL},
a AS (SELECT alertname, severity, instance, epoch_us(ts) AS t FROM al),
fa AS (SELECT *, lag(t) OVER (PARTITION BY alertname, severity, instance ORDER BY t) AS pt FROM a),
ga AS (SELECT *, max(CASE WHEN pt IS NULL OR t - pt > {CADENCE_S * 1000000} THEN t END) OVER (
        PARTITION BY alertname, severity, instance ORDER BY t ROWS UNBOUNDED PRECEDING) AS s FROM fa),
ep AS (SELECT alertname, severity, instance, s, count(*) AS n, max(t) + {RESOLVE_S * 1000000} AS e
       FROM ga GROUP BY ALL),
p AS (SELECT *, max(e) OVER (PARTITION BY alertname, severity ORDER BY s, instance
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end FROM ep),
q AS (SELECT *, CASE WHEN prev_end IS NULL OR s > prev_end THEN s END AS ss FROM p),
r AS (SELECT *, max(ss) OVER (PARTITION BY alertname, severity ORDER BY s, instance
        ROWS UNBOUNDED PRECEDING) AS sess FROM q),
ch AS (SELECT DISTINCT alertname, severity, sess,
         greatest(CAST(ceil((ev - (sess + {WAIT_S * 1000000})) / {INTERVAL_S * 1000000}) AS BIGINT), 0)
           AS tick
       FROM (SELECT alertname, severity, sess, s AS ev FROM r
             UNION ALL SELECT alertname, severity, sess, e FROM r)),
gp AS (SELECT *, lead(tick) OVER (PARTITION BY alertname, severity, sess ORDER BY tick) AS nx FROM ch),
ps AS (SELECT alertname, severity, sess,
              count(*) + sum(coalesce(floor((nx - tick - 1) / {-(-REPEAT_S // INTERVAL_S)}), 0)) AS notes
       FROM gp GROUP BY ALL),
pg AS (SELECT alertname, severity, count(*) AS n_sessions, CAST(sum(notes) AS BIGINT) AS n_notifications
       FROM ps GROUP BY ALL),
pe AS (SELECT alertname, severity, CAST(sum(n) AS BIGINT) AS n_alerts, count(*) AS n_episodes,
              min(s) AS first FROM ep GROUP BY ALL)
SELECT pe.alertname, pe.severity, n_alerts, n_episodes, n_sessions, n_notifications,
       strftime(make_timestamp(first), '%Y-%m-%d %H:%M:%S') AS first_ts
FROM pe JOIN pg USING (alertname, severity)""")
def m10_alert_notifications(spark, sf):
    """Router timing per (alertname, severity): episodes, sessions and notifications
    (wait 30 s, interval 5 m, repeat 4 h, resolve after 5 m) over hourly evaluations."""
    n = M.notifications(alerts(spark, sf), cadence_s=CADENCE_S, group_wait_s=WAIT_S,
                        group_interval_s=INTERVAL_S, repeat_interval_s=REPEAT_S,
                        resolve_timeout_s=RESOLVE_S)
    return n.select("alertname", "severity", "n_alerts", "n_episodes", "n_sessions",
                    "n_notifications", ts_text("first_ts").alias("first_ts"))


@query("m3_latest_by_series", """
WITH m AS (
  SELECT date_trunc('hour', ts) AS ts, 'events_total' AS metric,
         json_object('type', event_type)::VARCHAR AS series_id, CAST(count(*) AS DOUBLE) AS value, 0 AS tb
  FROM events GROUP BY ALL
  UNION ALL
  SELECT ts, 'amount_total', json_object('user', CAST(user_id AS VARCHAR))::VARCHAR,
         CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id, CAST(ts AS DATE)
              ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE), 0
  FROM events)
SELECT metric, series_id, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM (
  SELECT *, row_number() OVER (PARTITION BY metric, series_id ORDER BY ts DESC, value DESC) AS rn
  FROM m) WHERE rn = 1""")
def m3_latest_by_series(spark, sf):
    """Latest sample of every series of the long metric table."""
    lv = M.latest_value(event_metrics(spark, sf), ["metric", "series_id"], "ts", "value",
                        ["value"])
    return lv.select("metric", "series_id", "value", ts_text_us("ts").alias("ts"))


LOOKBACK_S = 6 * 3600
VIEW_LOOKBACK_S = 10 * 86400
LATEST_SQL = """v AS (SELECT event_type, user_id % 10 AS shard, ts, event_id, value FROM events
                      WHERE value IS NOT NULL)"""


@query("j5_asof_match", f"""
SELECT a.event_id, strftime(a.ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, a.user_id, b.event_id AS view_id,
       b.value AS view_value, a.value - b.value AS diff
FROM events a LEFT JOIN LATERAL (
  SELECT event_id, value FROM events v WHERE v.event_type = 'view' AND v.user_id = a.user_id
    AND v.ts <= a.ts AND epoch_us(v.ts) > epoch_us(a.ts) - {VIEW_LOOKBACK_S * 1000000}
  ORDER BY v.ts DESC, v.event_id DESC LIMIT 1) b ON true
WHERE a.event_type = 'click'""")
def j5_asof_match(spark, sf):
    """Every click with the user's newest view of the ten days before it; the two series
    have no sample time in common."""
    e = ev(spark, sf)
    clicks = e.filter(F.col("event_type") == "click").select("event_id", "ts", "user_id", "value")
    views = e.filter(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"),
        F.col("value").alias("view_value"))
    m = M.asof_match(clicks, views, ["user_id"], "ts", "view_ts", VIEW_LOOKBACK_S, ["view_id"])
    return m.select("event_id", ts_text_us("ts").alias("ts"), "user_id", "view_id", "view_value",
                    (F.col("value") - F.col("view_value")).alias("diff"))


STEP_S = 1800
INSTANT_SQL = f"""{LATEST_SQL},
s AS (SELECT *, unnest(range(CAST(ceil(epoch_us(ts) / {STEP_S * 1000000}) AS BIGINT),
        CAST(floor((epoch_us(ts) + {LOOKBACK_S * 1000000 - 1}) / {STEP_S * 1000000}) AS BIGINT) + 1)) AS step
      FROM v),
i AS (SELECT event_type, shard, step, value FROM s QUALIFY row_number() OVER (
        PARTITION BY event_type, shard, step ORDER BY ts DESC, event_id DESC) = 1)"""


def instants(spark, sf) -> DataFrame:
    """(event_type, shard, at, value): newest value per type and user shard at every half
    hour, not older than six hours."""
    e = ev(spark, sf).select("event_type", (F.col("user_id") % 10).alias("shard"), "ts",
                             "event_id", "value")
    return M.instant_vector(e, ["event_type", "shard"], "ts", "value", STEP_S, LOOKBACK_S,
                            ["event_id"])


@query("m5_instant_ratio", f"""
WITH {INSTANT_SQL}
SELECT a.shard, strftime(make_timestamp(a.step * {STEP_S * 1000000}), '%Y-%m-%d %H:%M:%S') AS "at",
       CASE WHEN b.value = 0 THEN NULL ELSE (1.0 - a.value / b.value) * 100.0 END AS pct,
       coalesce(CASE WHEN b.value = 0 THEN NULL ELSE (1.0 - a.value / b.value) * 100.0 END > 80.0,
                false) AS firing
FROM i a JOIN i b ON a.shard = b.shard AND a.step = b.step
WHERE a.event_type = 'click' AND b.event_type = 'view'""")
def m5_instant_ratio(spark, sf):
    """``(1 - click / view) * 100 > 80`` per shard at every step, over samples that were
    taken at different times."""
    v = instants(spark, sf)
    a = v.filter(F.col("event_type") == "click").select("shard", "at", F.col("value").alias("a"))
    b = v.filter(F.col("event_type") == "view").select("shard", "at", F.col("value").alias("b"))
    pct = M.ratio_pct("a", "b")
    return M.match(a, b, ["shard", "at"]).select(
        "shard", ts_text("at").alias("at"), pct.alias("pct"),
        F.coalesce(pct > 80.0, F.lit(False)).alias("firing"))


@query("m6_instant_threshold", f"""
WITH {INSTANT_SQL},
t AS (SELECT shard, step, sum(CAST(value AS DECIMAL(18,2))) AS total, count(*) AS kinds
      FROM i GROUP BY ALL)
SELECT shard, strftime(make_timestamp(step * {STEP_S * 1000000}), '%Y-%m-%d %H:%M:%S') AS "at",
       CAST(total AS DOUBLE) AS total, kinds, CAST(total AS DOUBLE) > kinds * 100 * 0.8 AS firing FROM t""")
def m6_instant_threshold(spark, sf):
    """``sum by (shard)(latest values) > capacity * 0.8`` at every step, capacity = 100 per
    type that has a sample in the look-back."""
    t = instants(spark, sf).groupBy("shard", "at").agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
        F.count(F.lit(1)).alias("kinds"))
    return t.select("shard", ts_text("at").alias("at"), "total", "kinds",
                    (F.col("total") > F.col("kinds") * 100 * 0.8).alias("firing"))
