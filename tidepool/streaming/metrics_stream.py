"""Metric streams: event-time windows with a watermark, and the "held for a
duration" rule as per-series state.

``sustained_stream`` holds a series' samples back until the watermark has passed them and
then evaluates them in time order, so samples that arrive late but inside the watermark
give the same answer as in the batch form (:func:`tidepool.operators.metrics.sustained`).
A series keeps its samples of the watermark delay, the time and condition of the last one
evaluated, and the start of the current island; a silent series expires.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed_counts(stream: DataFrame, ts: str, keys: Sequence[str], window: str,
                    slide: str | None = None, watermark: str = "10 minutes") -> DataFrame:
    """Counts per key and event-time window; late rows beyond the watermark are
    dropped and a window is emitted once (append mode) when the watermark passes it."""
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    return (stream.withWatermark(ts, watermark).groupBy(w.alias("window"), *keys)
            .agg(F.count(F.lit(1)).alias("n")))


OUT_SCHEMA = "series string, ts timestamp, cond boolean, island_start timestamp, firing boolean"
STATE_SCHEMA = ("last_ts long, last_cond boolean, start_ts long, "
                "held_ts array<long>, held_cond array<int>")
_NONE = -1      # a NULL condition among the held samples


def _evaluated(t: np.ndarray, c: np.ndarray, last_ts, last_cond, start, cad_us: int):
    """Island start (-1: none) of samples in time order that follow the last evaluated one."""
    before_t = np.concatenate(([t[0] if last_ts is None else last_ts], t[:-1]))
    before_c = np.concatenate(([bool(last_cond)], c[:-1]))
    begins = c & (~before_c | (t - before_t > cad_us))
    at = np.where(begins, np.arange(len(t)), -1)
    at = np.maximum.accumulate(at)
    carried = -1 if start is None else start
    return np.where(c, np.where(at >= 0, t[at], carried), -1)


def sustained_stream(samples: DataFrame, series: str, ts: str, cond: str, hold_s: int,
                     cadence_s: int, watermark: str = "2 hours") -> DataFrame:
    """M2 on a stream of (series, ts, cond) samples; every sample is emitted once, with its
    island start and whether it fires, as soon as the watermark has passed it. Samples may
    arrive in any order within the watermark; later ones are dropped."""
    hold_us, cad_us = hold_s * 1_000_000, cadence_s * 1_000_000

    def step(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last_ts, last_cond, start, held_ts, held_cond = (
            state.get if state.exists else (None, None, None, [], []))
        times, conds = [np.array(held_ts, "int64")], [np.array(held_cond, "int64")]
        if not state.hasTimedOut:
            for p in pdfs:
                p = p[p[ts].notna()]
                times.append(p[ts].to_numpy("datetime64[us]").astype("int64"))
                conds.append(p[cond].astype("boolean").astype("Int64").fillna(_NONE).to_numpy("int64"))
        t, c = np.concatenate(times), np.concatenate(conds)
        order = np.lexsort((c, t))
        t, c = t[order], c[order]
        mark_ms = state.getCurrentWatermarkMs()
        ready = int(np.searchsorted(t, mark_ms * 1000, side="right"))
        if ready:
            now, on = t[:ready], c[:ready] == 1
            begun = _evaluated(now, on, last_ts, last_cond, start, cad_us)
            yield pd.DataFrame({
                "series": key[0], "ts": now.astype("datetime64[us]"),
                "cond": pd.Series(c[:ready]).map({1: True, 0: False, _NONE: None}).astype(object),
                "island_start": pd.Series(np.where(begun < 0, 0, begun).astype("datetime64[us]"))
                .where(begun >= 0),
                "firing": (begun >= 0) & (now - begun >= hold_us)})
            last_ts, last_cond = int(now[-1]), bool(on[-1])
            start = int(begun[-1]) if begun[-1] >= 0 else None
        t, c = t[ready:], c[ready:]
        if not len(t) and (last_ts is None or last_ts + cad_us < mark_ms * 1000):
            state.remove()          # whatever comes next starts a new island
            return
        state.update((last_ts, last_cond, start, t.tolist(), c.tolist()))
        wake = int(t[0]) if len(t) else last_ts + cad_us
        state.setTimeoutTimestamp(max(mark_ms, wake // 1000) + 1)

    return (samples.withColumn(series, F.col(series).cast("string"))
            .withWatermark(ts, watermark).groupBy(series)
            .applyInPandasWithState(step, OUT_SCHEMA, STATE_SCHEMA, "append",
                                    GroupStateTimeout.EventTimeTimeout))
