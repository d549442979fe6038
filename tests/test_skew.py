"""Hot keys: one key holding a third of all rows must be combined before the shuffle.
Checked on the SQL metrics of the executed plans."""

from pyspark.sql import functions as F

from tidepool.operators import gold, silver
from tidepool.operators import landing as L
from tidepool.operators import metrics as M


def nodes(df):
    """(node name, metrics) of the final physical plan, after an action on ``df``."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.finalPhysicalPlan()
    out, stack = [], [plan]
    while stack:
        p = stack.pop()
        name = p.nodeName()
        if name in ("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage"):
            stack.append(p.plan())
            continue
        m = p.metrics()
        vals = {k: m.apply(k).value() for k in ("numOutputRows",) if m.contains(k)}
        out.append((name, p.simpleStringWithNodeId() if hasattr(p, "simpleStringWithNodeId") else "",
                    vals))
        children = p.children()
        for i in range(children.size()):
            stack.append(children.apply(i))
    return out


def hot_input(spark, n=60_000, parts=8):
    """Keys 0..9999 once or so; key -1 holds a third of the rows."""
    return spark.range(n, numPartitions=parts).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 10_000).alias("k"),
        (F.col("id") % 7).alias("q"), F.col("id").alias("n"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("s"))


def test_fused_best_row_combines_hot_key_map_side(spark):
    df = hot_input(spark)
    out = silver.best_row_fused(df, ["k"], ["q", "n"], ["n"], {"m": "s"}, "c")
    rows = {r["k"]: r for r in out.collect()}
    assert rows[-1]["c"] == 20_000 and rows[-1]["n"] == 59_982   # q = 6 is max, then n
    partial = [v["numOutputRows"] for name, desc, v in nodes(out)
               if "Aggregate" in name and "numOutputRows" in v]
    # the partial aggregate passes the 40,000 ordinary rows and at most one row of the
    # hot key per task (8 tasks): its 20,000 rows never reach the shuffle
    assert min(partial) <= 40_000 + 8


def test_latest_per_key_hot_key(spark):
    df = hot_input(spark).withColumn("ts", F.col("n"))
    out = gold.latest_per_key(df, "k", ["ts"], ["q"])
    assert out.filter("k = -1").first()["q"] == 59_997 % 7


def test_sustained_hot_series_is_bucketed(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    df = spark.range(5_000).select(F.lit("hot").alias("s"),
                                   (F.lit(t0) + F.make_interval(mins=F.col("id").cast("int")))
                                   .alias("ts"),
                                   (F.col("id") % 97 != 0).alias("c"))
    out = M.sustained(df, ["s"], "ts", "c", 30 * 60, 60, bucket_s=3600)
    assert out.count() == 5_000
    firing = out.filter("firing").count()
    # islands are the 96-minute runs between falses; 30 minutes of each one fire
    assert 0 < firing < 5_000


def test_detail_cap_hot_slice_limited_per_task(spark):
    from tidepool.operators import landing as L
    cards = spark.range(40_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            (F.col("id") % 500).cast("string")).alias("slice"),
        F.col("id").cast("string").alias("key"), (F.col("id") % 11).alias("page"),
        F.col("id").alias("pos"))
    details = cards.select("slice", "key", F.lit("ok").alias("detail_status"))
    out = L.cap_enrich(cards, details, ["slice"], "key", ["page", "pos"], n=5)
    counts = {r["detail_status"]: r["count"] for r in
              out.filter("slice = 'hot'").groupBy("detail_status").count().collect()}
    assert counts == {"ok": 5, "not_fetched_limit": 13_334 - 5}
    chosen = out.filter("slice = 'hot'")
    chosen.collect()
    limits = [v["numOutputRows"] for name, _, v in nodes(chosen)
              if name == "WindowGroupLimit" and "numOutputRows" in v]
    # 501 slices: the partial limit sends at most n rows per slice per task into the
    # shuffle (instead of all 40,000 cards), the final one keeps n per slice
    assert limits and max(limits) <= 5 * 8 * 501 and min(limits) <= 5 * 501


def test_completeness_hot_snapshot(spark):
    from tidepool.operators import snapshots
    grid = [(r, a) for r in ("x", "y") for a in ("1", "2", "3")]
    df = spark.range(60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            (F.col("id") % 1000).cast("string")).alias("snapshot_id"),
        F.element_at(F.array(*[F.lit(r) for r, _ in grid]),
                     (F.floor(F.col("id") / 3) % 6 + 1).cast("int")).alias("search_text"),
        F.element_at(F.array(*[F.lit(a) for _, a in grid]),
                     (F.floor(F.col("id") / 3) % 6 + 1).cast("int")).alias("search_area"))
    out = snapshots.complete_snapshots(df)
    ids = {r[0] for r in out.collect()}
    assert "hot" in ids
    partial = [v["numOutputRows"] for name, _, v in nodes(out)
               if "Aggregate" in name and "numOutputRows" in v]
    # (snapshot, slice) pairs are combined per task first: the hot snapshot's 20,000
    # rows become at most 6 per task
    assert min(partial) <= 1000 * 6 * 8 + 6 * 8


def test_notifications_of_a_hot_group_shrink_to_their_times(spark):
    """A third of all alert rows in one group-day: sessions see distinct times only."""
    rows = spark.range(60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 200).cast("string")).alias("alertname"),
        F.lit("critical").alias("severity"), (F.col("id") % 1000).cast("string").alias("instance"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.floor(F.col("id") / 3) % 20 * 3600).alias("ts")).distinct()
    out = M.notifications(rows, cadence_s=3600)
    hot = out.filter("alertname = 'hot'").first()
    assert hot["n_alerts"] == rows.filter("alertname = 'hot'").count()
    assert hot["n_episodes"] == 1000 and hot["n_sessions"] == 20    # one per evaluation hour
    out.collect()
    partial = [v["numOutputRows"] for name, desc, v in nodes(out)
               if "Aggregate" in name and v.get("numOutputRows")]
    assert min(partial) <= 201 * 20


def test_first_n_of_a_slice_over_many_tasks(spark):
    cards = spark.range(30_000, numPartitions=200).select(
        F.lit("hot").alias("slice"), F.col("id").cast("string").alias("key"),
        (F.pmod(F.xxhash64("id"), F.lit(50))).cast("int").alias("page"), F.col("id").alias("pos"))
    details = cards.select("slice", "key", F.lit("ok").alias("detail_status"))
    out = L.cap_enrich(cards, details, ["slice"], "key", ["page", "pos"], n=7)
    got = {r["key"] for r in out.filter("detail_status = 'ok'").collect()}
    assert got == {r["key"] for r in cards.orderBy("page", "pos").limit(7).collect()}
    limits = [v["numOutputRows"] for name, _, v in nodes(out) if name == "WindowGroupLimit"
              and "numOutputRows" in v]
    # 7 rows of each of 200 map tasks, then 7 of each share: all the last window sees
    assert sorted(limits)[:2] == [7 * L.SHARES, 7 * 200]
