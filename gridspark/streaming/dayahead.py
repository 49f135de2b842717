"""Online day-ahead smoothing (extension): state per series, 24 predictions whenever a day closes, by event time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gridspark.functions import timefn
from gridspark.models import smoothing
from gridspark.models.smoothing import HOURS, Params

#: The state store that keeps list, map and value states with timers.
STORE = {"spark.sql.streaming.stateStore.providerClass":
         "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
MODEL = "day bigint, last bigint, timer bigint, start array<double>, state array<double>"
OPEN = "slots array<bigint>, vals array<double>"


class DayAhead(StatefulProcessor):
    """Open hours and smoothing state of one series.

    The first day closes when the watermark has passed it, so that no earlier row can still come; later ones when their 24 hours
    are there or the watermark has passed them. What closes depends on event time alone: how the input is cut into
    batches decides when a prediction is given, never which.
    """

    def __init__(self, keys: list[str], params: np.ndarray, level: str, val: str, idle_days: int) -> None:
        self.keys, self.params, self.level, self.val, self.idle = keys, params, level, val, idle_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.model = handle.getValueState("model", MODEL)
        self.open = handle.getValueState("open", OPEN)

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        hours, model = self._hours(), self.model.get() if self.model.exists() else None
        day, last, timer, start, state = model if model else (None, None, None, None, None)
        for pdf in rows:
            if start is None and pdf["state"].iloc[0] is not None:
                start = [float(v) for v in pdf["state"].iloc[0]]
            for slot, value in zip(pdf["slot"].tolist(), pdf[self.val].astype(float).tolist()):
                if day is None or slot >= day * HOURS:                # rows of closed days come too late
                    hours.setdefault(slot, value)
        yield from self._advance(key, hours, day, last, timer, start, state, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.model.exists():
            day, last, _, start, state = self.model.get()
            yield from self._advance(key, self._hours(), day, last, None, start, state, timerValues)

    def _hours(self) -> dict[int, float]:
        return {int(s): float("nan") if v is None else float(v) for s, v in zip(*self.open.get())} if self.open.exists() else {}

    def _advance(self, key, hours, day, last, timer, start, state, times) -> Iterator[pd.DataFrame]:
        """Close all days that can be closed, in order; days without rows close too, `idle` of them at most in a row."""
        now = times.getCurrentWatermarkInMs() // (1000 * timefn.HOUR)
        out = []
        while True:
            begun = day is not None
            d = day if begun else min((s // HOURS for s in hours), default=None)
            if d is None:
                break
            y = np.array([hours.get(d * HOURS + h, np.nan) for h in range(HOURS)])
            if now < (d + 1) * HOURS and not (begun and np.isfinite(y).all()):
                break
            if any(s // HOURS == d for s in hours):
                last = d
            elif d - last > self.idle:                                # silent for too long: forgotten, a later row starts anew
                day = last = state = None
                continue
            hours = {s: v for s, v in hours.items() if s // HOURS > d}
            if state is None:
                if start is None and not np.isfinite(y).any():
                    day = d + 1
                    continue
                state = start if start is not None else [float(np.nanmean(y)), *[0.0] * (smoothing.STATE - 1)]
            state, preds = self._day(d, y, np.asarray(state, float))
            out.append(pd.DataFrame({"slot": (d + 1) * HOURS + np.arange(HOURS), "pred": preds}))
            day = d + 1
        self._keep(hours, day, last, timer, start, state)
        for name, value in zip(self.keys, key):
            for frame in out:
                frame[name] = value
        if out:
            yield pd.concat(out)[[*self.keys, "slot", "pred"]]

    def _day(self, day: int, y: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, state = smoothing.day_step(state, y, int((day + 3) % 7 >= 5), self.params, self.level)
        following, _ = smoothing.day_step(state, np.full(HOURS, np.nan), int((day + 4) % 7 >= 5), self.params, self.level)
        return state, following

    def _keep(self, hours, day, last, timer, start, state) -> None:
        first = day if day is not None else min((s // HOURS for s in hours), default=None)
        due = None if first is None else (first + 1) * HOURS * timefn.HOUR * 1000
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer)
        if due is None:
            self.model.clear()
            self.open.clear()
            return
        if timer != due:
            self.handle.registerTimer(due)
        numbers = None if state is None else [float(v) for v in state]
        self.model.update((day, last, due, start, numbers))
        if hours:
            slots = sorted(hours)
            self.open.update((slots, [hours[s] for s in slots]))
        else:
            self.open.clear()


def online_dayahead(stream: DataFrame, states: DataFrame, keys: list[str], params: Params = Params(), val: str = "val",
                    level: str = "mean", delay: str = "2 days", idle_days: int = 14) -> DataFrame:
    """Predict the next day after each closed day of a stream of hourly rows (keys, slot, val).

    `states` gives each series its start state (keys, state array); a series without one starts level at the mean of its
    first day with a value. Rows may come out of order by `delay`; later ones, and rows of closed days, are ignored; of several rows of
    an hour the first to arrive counts. Days with missing hours correct nothing and close when the watermark has passed them, also
    for a series that has fallen silent; after `idle_days` days without a row its state is dropped. Every day from the second on is
    predicted. The session must use the state store named in STORE. Output (append): keys, slot, pred.
    """
    rows = (stream.withColumn("_ts", F.timestamp_seconds(F.col("slot") * timefn.HOUR)).withWatermark("_ts", delay)
            .join(states.select(*keys, "state"), keys, "left").select(*keys, "slot", val, "state", "_ts"))
    key_ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keys).schema.fields)
    p = np.array([getattr(params, n) for n in smoothing.PARAM_NAMES])
    return rows.groupBy(*keys).transformWithStateInPandas(
        DayAhead(keys, p, level, val, idle_days), key_ddl + ", slot bigint, pred double", "Append", "EventTime")
