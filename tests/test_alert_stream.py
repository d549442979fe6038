"""The alert router as a stream gives the notifications of its batch form."""

import datetime as dt
import random
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF01
from tidepool.operators import metrics as M
from tidepool.plans.q_metrics import (CADENCE_S, INTERVAL_S, REPEAT_S, RESOLVE_S, WAIT_S, alerts)
from tidepool.streaming import alert_stream as A

SCHEMA = "alertname string, severity string, instance string, ts timestamp"
TIMING = dict(cadence_s=CADENCE_S, group_wait_s=WAIT_S, group_interval_s=INTERVAL_S,
              repeat_interval_s=REPEAT_S, resolve_timeout_s=RESOLVE_S)


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, A.ROCKSDB)
    yield spark
    spark.conf.set(key, before) if before else spark.conf.unset(key)


def run(spark, root, watermark, fail_at=None, timing=TIMING):
    """One pass over what has landed; ``fail_at`` loses that batch after it was written."""
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")

    def write(df, batch):
        df.write.mode("overwrite").parquet(f"{root}/out/batch={batch}")
        if batch == fail_at:
            raise RuntimeError("executor lost")

    q = (A.notification_stream(stream, watermark=watermark, **timing).writeStream
         .outputMode("append").option("checkpointLocation", f"{root}/ck").foreachBatch(write)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def sent(spark, root):
    return spark.read.parquet(f"{root}/out").drop("batch").where("alertname != 'end'")


def land(spark, root, batches, schema=SCHEMA):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/in/b{k:03}")


def batch_form(spark, rows, **timing):
    df = spark.createDataFrame([r for r in rows if r[0] != "end"], SCHEMA)
    return M.notifications(df, **{**TIMING, **timing})


def same(got, want):
    cols = sorted(want.columns)
    return (sorted(map(tuple, got.select(cols).collect()))
            == sorted(map(tuple, want.select(cols).collect())))


def test_shuffled_arrivals_and_a_lost_batch_equal_the_batch_form(rocks):
    """All alerts of the events table, out of order over three batches, one of them lost
    after its output was written and run again."""
    spark = rocks
    rows = [tuple(r) for r in alerts(spark, SF01).select("alertname", "severity", "instance",
                                                         F.col("ts").cast("timestamp")).collect()]
    first, last = min(r[3] for r in rows), max(r[3] for r in rows)
    random.Random(5).shuffle(rows)
    cut = len(rows) // 3
    end = [("end", "x", "x", last + dt.timedelta(days=900))]
    root = tempfile.mkdtemp(prefix="tp-alerts-")
    land(spark, root, [rows[:cut], rows[cut:2 * cut], rows[2 * cut:], end])
    delay = f"{(last - first).days + 2} days"
    with pytest.raises(Exception, match="executor lost"):
        run(spark, root, delay, fail_at=2)
    run(spark, root, delay)
    notes = sent(spark, root)
    assert same(A.summary(notes), batch_form(spark, rows))
    assert notes.where("is_repeat").count() > 0
    assert notes.select("alertname", "severity", "sent_at").distinct().count() == notes.count()
    before = notes.count()
    run(spark, root, delay)                     # nothing new has landed
    assert sent(spark, root).count() == before


def test_timers_send_without_further_alerts_of_the_group(rocks):
    """A quiet group's notifications come out as other groups move the watermark."""
    spark = rocks
    t0 = dt.datetime(2024, 1, 1)
    quick = dict(cadence_s=60, group_wait_s=30, group_interval_s=300, repeat_interval_s=3600,
                 resolve_timeout_s=300)
    root = tempfile.mkdtemp(prefix="tp-timer-")
    rows = [("A", "warning", "h1", t0), ("A", "warning", "h2", t0 + dt.timedelta(seconds=50))]
    land(spark, root, [rows, [("end", "x", "x", t0 + dt.timedelta(hours=1))]])
    run(spark, root, "1 minute", timing=quick)
    notes = [(r["sent_at"], r["n_started"], r["n_resolved"]) for r in
             sent(spark, root).orderBy("sent_at").collect()]
    assert notes == [(t0 + dt.timedelta(seconds=30), 1, 0), (t0 + dt.timedelta(seconds=330), 1, 1),
                     (t0 + dt.timedelta(seconds=630), 0, 1)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 400), st.sampled_from("ab")), min_size=1, max_size=25),
       st.integers(1, 40), st.integers(0, 30), st.integers(1, 20), st.integers(1, 60),
       st.integers(1, 50), st.lists(st.integers(0, 450), max_size=6))
def test_watermark_steps_do_not_matter(times, cadence, wait, interval, repeat, resolve, marks):
    """However the watermark advances, the notifications are those of one pass, and those
    of a direct walk over the session's ticks."""
    t = A.Timing(cadence, wait, interval, repeat, resolve)

    def walk(steps):
        held, episodes, changes, session, out = list(times), {}, [], None, []
        for mark in [*sorted(steps), 10_000]:
            ready = [x for x in held if x[0] <= mark]
            held = [x for x in held if x[0] > mark]
            changes += A.close_episodes(ready, episodes, mark, t)
            session, changes, new = A.route(session, changes, mark - t.lag, t)
            wake = A.next_wake(session, changes, held, episodes, t)
            assert wake is None or wake > mark, "something due was left undone"
            out += new
        assert session is None and not changes and not episodes
        return out

    once = walk([])
    assert walk(marks) == once
    assert [(s, k) for s, k, *_ in once] == direct(times, t)


def direct(times, t):
    """(session, tick) of every notification, from episodes of all alerts at once."""
    episodes = []
    for name in {n for _, n in times}:
        own = sorted(a for a, n in times if n == name)
        start = last = own[0]
        for a in own[1:]:
            if a - last > t.cadence:
                episodes.append((start, last + t.resolve))
                start = a
            last = a
        episodes.append((start, last + t.resolve))
    out, sessions = [], []
    for s, e in sorted(episodes):
        if sessions and s <= sessions[-1][1]:
            sessions[-1][1] = max(e, sessions[-1][1])
            sessions[-1][2] += [s, e]
        else:
            sessions.append([s, e, [s, e]])
    step = -(-t.repeat // t.interval)
    for start, _, changes in sessions:
        ticks = sorted({t.tick_of(start, c) for c in changes})
        for tick, after in zip(ticks, [*ticks[1:], ticks[-1]]):
            out += [(start, k) for k in [tick, *range(tick + step, after, step)]]
    return out


def test_no_rows(rocks):
    root = tempfile.mkdtemp(prefix="tp-none-")
    land(rocks, root, [[]])
    run(rocks, root, "1 minute")
    assert sent(rocks, root).count() == 0
