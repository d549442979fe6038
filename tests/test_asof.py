"""As-of matching and instant vectors against direct walks over jittered samples."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidepool.operators import metrics as M

T0 = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
A = "k string, ts timestamp, id int"
B = "k string, at timestamp, v int"


def samples(seed, n, spread_s, offset=0.0):
    """(label, seconds, id) with jittered and tied times, a null label and a hot one."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        k = r.choice(["hot"] * 4 + ["x", "y", None])
        t = r.choice([r.uniform(0, spread_s), float(r.randrange(0, int(spread_s), 60))])
        out.append((k, round(t + offset, 6), i))
    return out


def frame(spark, rows, schema):
    return spark.createDataFrame([(k, None if t is None else T0 + dt.timedelta(seconds=t), i)
                                  for k, t, i in rows], schema)


def us(t):
    return round(t * 1_000_000)


def test_asof_match_equals_a_direct_search(spark):
    a, b = samples(1, 300, 9000), samples(2, 400, 9000)
    a += [("x", None, 900), ("none", 10.0, 901)]
    b += [("x", None, 900), ("y", 50.0, 901), ("y", 50.0, 902)]
    for lookback in (1, 300, 4000):
        got = M.asof_match(frame(spark, a, A), frame(spark, b, B), ["k"], "ts", "at", lookback, ["v"])
        assert got.columns == ["k", "ts", "id", "at", "v"]
        want = {}
        for k, t, i in a:
            seen = [(u, v) for l, u, v in b if l == k and t is not None and u is not None
                    and us(t) - lookback * M.US < us(u) <= us(t)]
            want[i] = max(seen, default=(None, None))[1]
        assert {r["id"]: r["v"] for r in got.collect()} == want
        assert sum(v is not None for v in want.values()) > (20 if lookback > 1 else 0)


def test_instant_vector_equals_a_direct_search(spark):
    b = samples(3, 500, 20000) + [("x", None, 900)]
    for step, lookback in ((60, 300), (300, 60), (600, 600)):
        got = M.instant_vector(frame(spark, b, B), ["k"], "at", "v", step, lookback)
        want = {}
        for k in {r[0] for r in b}:
            for n in range(0, 20000 // step + lookback // step + 3):
                at = n * step
                seen = [(us(t), v) for l, t, v in b if l == k and t is not None
                        and us(at) - lookback * M.US < us(t) <= us(at)]
                if seen:
                    want[(k, at)] = max(seen)[1]
        rows = {(r["k"], int((r["at"].replace(tzinfo=dt.timezone.utc) - T0).total_seconds())): r["v"]
                for r in got.collect()}
        assert rows == want and want


def test_vectors_match_although_no_sample_time_is_shared(spark):
    a = frame(spark, [("x", 1.0, 10), ("x", 61.0, 20)], B)
    b = frame(spark, [("x", 7.5, 40), ("x", 400.0, 50)], B)
    va, vb = (M.instant_vector(x, ["k"], "at", "v", 60, 300) for x in (a, b))
    j = M.match(va.withColumnRenamed("v", "a"), vb.withColumnRenamed("v", "b"), ["k", "at"])
    got = {int((r["at"].replace(tzinfo=dt.timezone.utc) - T0).total_seconds()): (r["a"], r["b"])
           for r in j.collect()}
    assert got == {60: (10, 40), 120: (20, 40), 180: (20, 40), 240: (20, 40), 300: (20, 40)}


def test_a_hot_series_spreads_over_windows(spark):
    """No (label, bucket) window holds more than two look-backs of a series."""
    n = 20_000
    rows = spark.range(n).select(F.lit("hot").alias("k"), F.timestamp_seconds(
        F.col("id") + 1_700_000_000).alias("at"), F.col("id").cast("int").alias("v"))
    per = (M._with_halo(rows.withColumn("_t", M.epoch_us("at")), "_t", 60 * M.US, 60 * M.US - 1)
           .groupBy("k", "_part").count().agg(F.max("count")).first()[0])
    assert per <= 120
    left = rows.select("k", F.col("at").alias("ts"), F.col("v").alias("id"))
    got = M.asof_match(left, rows, ["k"], "ts", "at", 60)
    assert got.where("v = id").count() == n


def test_empty_sides(spark):
    a, b = frame(spark, [("x", 1.0, 1)], A), frame(spark, [("x", 1.0, 1)], B)
    assert [r["v"] for r in M.asof_match(a, b.limit(0), ["k"], "ts", "at", 60).collect()] == [None]
    assert M.asof_match(a.limit(0), b, ["k"], "ts", "at", 60).collect() == []
    assert M.instant_vector(b.limit(0), ["k"], "at", "v", 60, 60).collect() == []
