"""Day-by-day smoothing over local days, which have 23, 24 or 25 hours where clocks change.

A day is the hours of one local date. The slope runs over the hours passed since local midnight, the profile over the hour
on the clock: a skipped hour learns nothing, an hour that comes twice learns the mean of its two errors. A day is still linear in
the state, so chunks (cut between local days) are chained as in `smoothing`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.functions import timefn
from gridspark.models import smoothing
from gridspark.models.smoothing import HOURS, PARAM_NAMES, STATE, Params
from gridspark.operators import grid
from gridspark.session import materialize


def with_local(df: DataFrame, zone: str) -> DataFrame:
    """Adds `day` (local days since 1970) and `hour` (local hour) of the UTC hour `slot`."""
    local = timefn.to_local(timefn.slot_ts("slot", timefn.HOUR), zone)
    return df.withColumn("day", F.datediff(local.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")).withColumn("hour", F.hour(local))


@lru_cache(maxsize=256)
def day_maps(params: bytes, weekend: int, level: str, clock: bytes) -> tuple[np.ndarray, np.ndarray]:
    """`smoothing.day_matrices` for a day whose hours show the clock times `clock`."""
    p, clock = np.frombuffer(params), np.frombuffer(clock, dtype=np.int64)
    n, ones = len(clock), np.ones(len(clock))
    passed = np.arange(n)
    show = np.zeros((n, STATE))
    show[:, 0], show[:, 1] = 1, passed
    show[passed, 2 + weekend * HOURS + clock] = 1
    mean = ones / n if level == "mean" else np.eye(n)[0]
    rise = (np.eye(n)[-1] - np.eye(n)[0]) / n
    left = np.eye(n) - np.outer(ones, mean) - np.outer(passed, rise)
    to_clock = np.zeros((HOURS, n))
    to_clock[clock, passed] = 1 / np.bincount(clock, minlength=HOURS)[clock]
    rates = p[2:6].reshape(2, 2)[:, weekend]
    return show, np.concatenate([p[0] * mean[None], p[1] * rise[None], *(g * (to_clock @ left) for g in rates)])


def days_of(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, int, bytes]]:
    """(rows, weekend, clock times) of each local day of a chunk, in order."""
    order = np.argsort(pdf["slot"].to_numpy(), kind="stable")
    day, hour = pdf["day"].to_numpy()[order], pdf["hour"].to_numpy(np.int64)[order]
    for rows in np.split(np.arange(len(order)), np.flatnonzero(np.diff(day)) + 1):
        yield order[rows], int((day[rows[0]] + 3) % 7 >= 5), hour[rows].tobytes()


def _net(pdf: pd.DataFrame, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    t = smoothing.temp_values(pdf["t"].to_numpy(float), p) if p[6] or p[7] else np.zeros(len(pdf))
    return pdf["y"].to_numpy(float) - t, t


def chunk_maps(pdf: pd.DataFrame, params: np.ndarray, mode: str, level: str) -> np.ndarray:
    """`smoothing.chunk_maps` over local days."""
    out = []
    for p in params:
        net, _ = _net(pdf, p)
        effect = np.concatenate([np.zeros((1, STATE)), np.eye(STATE)])
        for rows, weekend, clock in days_of(pdf):
            if np.isfinite(net[rows]).all():
                show, learn = day_maps(p.tobytes(), weekend, level, clock)
                err = -effect @ show.T
                err[0] += net[rows]
                effect = effect + err @ learn.T
        out.append(effect)
    return np.stack(out)


def chunk_predict(pdf: pd.DataFrame, state: np.ndarray, p: np.ndarray, level: str) -> np.ndarray:
    """(rows, 4): total, trend, season, temperature response."""
    net, t = _net(pdf, p)
    out = np.empty((len(pdf), 4))
    for rows, weekend, clock in days_of(pdf):
        show, learn = day_maps(p.tobytes(), weekend, level, clock)
        pred, trend = show @ state, state[0] + state[1] * np.arange(len(rows))
        out[rows] = np.stack([pred + t[rows], trend, pred - trend, t[rows]], axis=-1)
        if np.isfinite(net[rows]).all():
            state = state + learn @ (net[rows] - pred)
    return out


def start_state(day: np.ndarray, hour: np.ndarray, net: np.ndarray, level: str) -> np.ndarray:
    """Level, slope and profiles of the hours (in order, NaN where missing) of the first local days."""
    there = np.flatnonzero(np.isfinite(net))
    if not len(there):
        return np.full(STATE, np.nan)
    head, tail = there[0], there[-1]
    b = (net[tail] - net[head]) / (tail - head + 1)
    lv = net[there].mean() if level == "mean" else net[head] - b * head
    cell = ((day + 3) % 7 >= 5) * HOURS + hour
    rest = net - b * np.arange(len(net)) - lv
    counts = np.bincount(cell[there], minlength=2 * HOURS)
    sums = np.bincount(cell[there], weights=rest[there], minlength=2 * HOURS)
    return np.r_[lv, b, np.where(counts > 0, sums / np.maximum(counts, 1), 0.0)]


def walk_forward_local(df: DataFrame, keys: list[str], zone: str, params: Params = Params(), val: str = "val", temp: str | None = None,
                       init_days: int = 28, level: str | None = None, size: int = grid.CHUNK) -> DataFrame:
    """`smoothing.walk_forward` over the local days of `zone`.

    Rows are UTC hours with consecutive `slot`s. The start state comes from the first `init_days` whole local days; hours
    before them are left out, a part day at the end is predicted. Days with a missing value correct nothing. A series that can't be
    started keeps its rows, with NULL predictions. Output: keys, slot, day, hour, val, pred, trend, season, temp_part.
    """
    level = level or ("first" if temp else "mean")
    t = F.col(temp).cast("double") if temp else F.lit(0.0)
    rows = with_local(df, zone).select(*keys, "slot", "day", "hour", F.col(val).cast("double").alias("y"), t.alias("t"))
    hours = materialize(rows.withColumn("chunk", F.floor(F.col("day") * HOURS / size).cast("long")), "local-hours")
    begin = F.min(F.struct("slot", "day", "hour"))
    first = hours.groupBy(*keys, "chunk").agg(begin.alias("b"), F.max("chunk").alias("last")).groupBy(*keys).agg(
        F.min("b").alias("b"), F.min("chunk").alias("lo"), F.max("last").alias("hi"))
    first = first.select(*keys, "lo", "hi", (F.col("b.day") + (F.col("b.hour") > 0).cast("int")).alias("first"))
    spans = materialize(first.withColumn("chunk", F.explode(F.sequence("lo", "hi"))).drop("lo", "hi"), "local-spans")
    placed = hours.join(spans, [*keys, "chunk"]).where("day >= first")
    stretch = (placed.where(F.col("day") < F.col("first") + init_days).groupBy(*keys)
               .agg(F.array_sort(F.collect_list(F.struct("slot", "day", "hour", "y", "t"))).alias("hours")))   # some weeks of one series
    p = np.array([getattr(params, n) for n in PARAM_NAMES])
    cand_ddl = smoothing._ddl(hours, keys) + ", cand int, params array<double>, state array<double>"

    def starts(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                h = pd.DataFrame(list(row["hours"])).astype(float)
                net = h["y"].to_numpy() - (smoothing.temp_values(h["t"].to_numpy(), p) if temp else 0)
                out.append([*(row[k] for k in keys), 0, p, start_state(h["day"].to_numpy().astype(int), h["hour"].to_numpy().astype(int), net, level)])
            yield pd.DataFrame(out, columns=[*keys, "cand", "params", "state"])

    cands = materialize(stretch.mapInPandas(starts, cand_ddl), "local-starts")
    later = placed.where(F.col("day") >= F.col("first") + init_days).drop("first")
    states = smoothing._chunk_states(later, cands, keys, "day", level, chunk_maps)
    schema = smoothing._ddl(hours, keys) + (", slot bigint, day bigint, hour int, val double, pred double, trend double, season double, "
                                            "temp_part double")

    def predict(pdf: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        columns = [*keys, "slot", "day", "hour", "val", "pred", "trend", "season", "temp_part"]
        if not len(pdf) or not len(start):
            return pd.DataFrame(columns=columns)
        frame = pdf[[*keys, "slot", "day", "hour", "y"]].rename(columns={"y": "val"}).reset_index(drop=True)
        frame[["pred", "trend", "season", "temp_part"]] = chunk_predict(pdf, np.asarray(start["state"].iloc[0], float), p, level)
        return frame[columns]

    return later.groupBy(*keys, "chunk").cogroup(smoothing._fresh(states).groupBy(*keys, "chunk")).applyInPandas(predict, schema)
