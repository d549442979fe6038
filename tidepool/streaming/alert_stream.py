"""The grouping alert router as a stream (M10): notifications with event-time timers.

One state key per alert group, driven by ``transformWithState``. Alerts are held in list
state until the watermark has passed them, evaluated in time order, and turned into episodes
(map state, one entry per instance) and sessions. A timer wakes the group at the next time
something can become due: a held alert, the end of an episode, a flush tick or a repeat. So
notifications come out whether or not further alerts of the group arrive, and they are those
of the batch form (:func:`tidepool.operators.metrics.notifications`) for any arrival order
within the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

US = 1_000_000
START, END = 0, 1
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass
class Timing:
    """The router's intervals, in microseconds."""
    cadence: int
    wait: int
    interval: int
    repeat: int
    resolve: int

    @property
    def lag(self) -> int:
        """How long after an episode's end it is certain that it has ended."""
        return max(self.cadence - self.resolve, 0)

    def tick_of(self, session: int, at: int) -> int:
        return max(0, -(-(at - session - self.wait) // self.interval))

    def tick_time(self, session: int, tick: int) -> int:
        return session + self.wait + tick * self.interval


@dataclass
class Session:
    """A group's open session: a maximal union of overlapping episodes."""
    start: int
    last_end: int               # latest end of an episode that has ended
    active: int = 0             # episodes that have not ended
    notified: int = -1          # tick of the last notification
    tick: int = -1              # tick that holds changes not yet notified
    started: int = 0
    resolved: int = 0
    alerts: int = 0

    def state(self) -> tuple:
        return (self.start, self.last_end, self.active, self.notified, self.tick,
                self.started, self.resolved, self.alerts)


def close_episodes(alerts: list[tuple], episodes: dict, mark: int, t: Timing) -> list[tuple]:
    """Take (time, instance) ``alerts`` in order into ``episodes`` (instance -> start, last,
    count) and return the changes (time, START or END, count) that are now certain: the
    starts, and the ends of episodes that no alert up to ``mark`` continues."""
    changes = []
    for at, instance in sorted(alerts):
        e = episodes.get(instance)
        if e is not None and at - e[1] <= t.cadence:
            episodes[instance] = (e[0], at, e[2] + 1)
            continue
        if e is not None:
            changes.append((e[1] + t.resolve, END, e[2]))
        episodes[instance] = (at, at, 1)
        changes.append((at, START, 0))
    for instance, (_, last, n) in list(episodes.items()):
        if last + t.cadence < mark:
            changes.append((last + t.resolve, END, n))
            del episodes[instance]
    return changes


def route(session: Session | None, changes: list[tuple], until: int, t: Timing
          ) -> tuple[Session | None, list[tuple], list[tuple]]:
    """Walk ``changes`` up to ``until`` in time order: the open session then, the changes
    still ahead and the notifications (session start, tick, repeat, started, resolved,
    alerts). A tick with changes notifies them; while a session goes on, a quiet stretch of
    the repeat interval notifies again."""
    out = []

    def flush(s: Session, before: int) -> None:
        """Notify every tick that falls before the time ``before``."""
        if s.tick >= 0 and t.tick_time(s.start, s.tick) < before:
            out.append((s.start, s.tick, False, s.started, s.resolved, s.alerts))
            s.notified, s.tick, s.started, s.resolved, s.alerts = s.tick, -1, 0, 0, 0
        step = -(-t.repeat // t.interval)
        while (s.tick < 0 <= s.notified and s.active
               and t.tick_time(s.start, s.notified + step) < before):
            s.notified += step
            out.append((s.start, s.notified, True, 0, 0, 0))

    changes = sorted(changes)
    done = 0
    for at, kind, n in changes:
        if at > until:
            break
        done += 1
        if session is not None:
            flush(session, at)
        if kind == START:
            if session is None or (not session.active and at > session.last_end):
                if session is not None:
                    flush(session, 1 << 62)
                session = Session(start=at, last_end=at)
            session.active += 1
            session.started += 1
        else:
            session.active -= 1
            session.resolved += 1
            session.alerts += n
            session.last_end = max(session.last_end, at)
        tick = t.tick_of(session.start, at)
        if session.tick >= 0 and session.tick != tick:      # cannot be: flushed before ``at``
            raise AssertionError("a tick was passed without its notification")
        session.tick = tick
    if session is not None:
        flush(session, until + 1)
        if not session.active and session.tick < 0 and session.last_end < until:
            session = None
    return session, changes[done:], out


def next_wake(session: Session | None, changes: list[tuple], held: list[tuple], episodes: dict,
              t: Timing) -> int | None:
    """Watermark (us) at which the group has something to do next; None: nothing is open."""
    times = [at for at, _ in held] + [last + t.cadence + 1 for _, last, _ in episodes.values()]
    times += [at + t.lag for at, _, _ in changes]
    if session is not None:
        if session.tick >= 0:
            times.append(t.tick_time(session.start, session.tick) + t.lag)
        elif session.active:
            step = -(-t.repeat // t.interval)
            times.append(t.tick_time(session.start, session.notified + step) + t.lag)
        else:
            times.append(session.last_end + 1 + t.lag)
    return min(times, default=None)


class Router(StatefulProcessor):
    """State of one alert group; see the module's docstring."""

    def __init__(self, timing: Timing, by: Sequence[str], instance: str, ts: str):
        self.t, self.by, self.instance, self.ts = timing, list(by), instance, ts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "at long, instance string")
        self.changes = handle.getListState("changes", "at long, kind int, n long")
        self.episodes = handle.getMapState("episodes", "instance string",
                                           "start long, last long, n long")
        self.session = handle.getValueState(
            "session", "start long, last_end long, active long, notified long, tick long, "
            "started long, resolved long, alerts long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues
                        ) -> Iterator[pd.DataFrame]:
        for p in rows:
            p = p[p[self.ts].notna()]
            at = p[self.ts].to_numpy("datetime64[us]").astype("int64").tolist()
            names = ["" if pd.isna(x) else str(x) for x in p[self.instance]]
            if at:
                self.held.appendList(list(zip(at, names)))
        yield from self._advance(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(key, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _advance(self, key, mark_ms: int) -> Iterator[pd.DataFrame]:
        mark = max(mark_ms, 0) * 1000
        held = [tuple(r) for r in self.held.get()] if self.held.exists() else []
        ready = [r for r in held if r[0] <= mark]
        held = [r for r in held if r[0] > mark]
        episodes = ({k[0]: tuple(v) for k, v in self.episodes.iterator()}
                    if self.episodes.exists() else {})
        before = dict(episodes)
        changes = [tuple(r) for r in self.changes.get()] if self.changes.exists() else []
        session = Session(*self.session.get()) if self.session.exists() else None
        changes += close_episodes(ready, episodes, mark, self.t)
        session, changes, out = route(session, changes, mark - self.t.lag, self.t)

        for state, rows in ((self.held, held), (self.changes, changes)):
            state.put(rows) if rows else state.clear()
        for name in before.keys() - episodes.keys():
            self.episodes.removeKey((name,))
        for name, e in episodes.items():
            if before.get(name) != e:
                self.episodes.updateValue((name,), e)
        self.session.update(session.state()) if session else self.session.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        wake = next_wake(session, changes, held, episodes, self.t)
        if wake is not None:
            self.handle.registerTimer(max(-(-wake // 1000), mark_ms + 1))
        if out:
            start, tick, repeat, started, resolved, alerts = zip(*out)
            yield pd.DataFrame({
                **{c: [key[i]] * len(out) for i, c in enumerate(self.by)},
                "session_start": pd.to_datetime(list(start), unit="us"),
                "sent_at": pd.to_datetime([self.t.tick_time(s, k) for s, k in zip(start, tick)],
                                          unit="us"),
                "is_repeat": list(repeat), "n_started": list(started),
                "n_resolved": list(resolved), "n_alerts": list(alerts)})


def notification_stream(alerts: DataFrame, by: Sequence[str] = ("alertname", "severity"),
                        instance: str = "instance", ts: str = "ts", cadence_s: int = 60,
                        group_wait_s: int = 30, group_interval_s: int = 300,
                        repeat_interval_s: int = 4 * 3600, resolve_timeout_s: int = 300,
                        watermark: str = "10 minutes") -> DataFrame:
    """M10 on a stream of alert rows (one per firing alert and evaluation): one row per
    notification with its group, session start, time, whether it is a repeat, and the
    episodes started and resolved (with their number of alerts) since the one before.

    Rows may come in any order within the watermark; later ones are dropped, as are rows
    without a time. The session must use the RocksDB state store (``ROCKSDB``). A replayed
    batch starts from the state of its checkpoint, so it sends the same notifications.
    """
    timing = Timing(*[s * US for s in (cadence_s, group_wait_s, group_interval_s,
                                       repeat_interval_s, resolve_timeout_s)])
    keys = [*by, instance]
    out = ", ".join(f"{c} string" for c in by) + (
        ", session_start timestamp, sent_at timestamp, is_repeat boolean, n_started long, "
        "n_resolved long, n_alerts long")
    rows = alerts.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in keys],
                         F.col(ts)).withWatermark(ts, watermark)
    return rows.groupBy(*by).transformWithStateInPandas(
        Router(timing, by, instance, ts), out, "Append", "EventTime")


def summary(notes: DataFrame, by: Sequence[str] = ("alertname", "severity")) -> DataFrame:
    """The batch form's row per group from sent notifications of ended sessions."""
    return notes.groupBy(*by).agg(
        F.sum("n_alerts").alias("n_alerts"), F.sum("n_started").alias("n_episodes"),
        F.count_distinct("session_start").alias("n_sessions"),
        F.count(F.lit(1)).alias("n_notifications"), F.min("session_start").alias("first_ts"))
