"""Local days of 23, 24 and 25 hours against a plain loop."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import numpy as np
import pytest
from helpers import frame

from gridspark.models import localdays, smoothing
from gridspark.models.smoothing import Params

K = ["series"]


def loop(y, start, zone, p, init_days, level):
    """{slot: prediction}, hour by hour in local time."""
    days = {}
    for i, v in enumerate(y):
        local = datetime.fromtimestamp((start + i) * 3600, timezone.utc).astimezone(ZoneInfo(zone))
        days.setdefault(local.date(), []).append((start + i, local.hour, v))
    dates = sorted(days)
    if days[dates[0]][0][1] > 0:
        dates = dates[1:]
    first = [(s, h, v, d.weekday() >= 5) for d in dates[:init_days] for s, h, v in days[d]]
    known = [(i, v) for i, (_, _, v, _) in enumerate(first) if v is not None]
    b = (known[-1][1] - known[0][1]) / (known[-1][0] - known[0][0] + 1)
    lv = np.mean([v for _, v in known]) if level == "mean" else known[0][1] - b * known[0][0]
    season = np.zeros((2, 24))
    for w in (0, 1):
        for h in range(24):
            rest = [v - b * i - lv for i, (_, hh, v, ww) in enumerate(first) if hh == h and ww == w and v is not None]
            season[w, h] = np.mean(rest) if rest else 0
    out = {}
    for d in dates[init_days:]:
        w, rows = int(d.weekday() >= 5), days[d]
        pred = [lv + b * i + season[w, h] for i, (_, h, _) in enumerate(rows)]
        out.update({s: x for (s, _, _), x in zip(rows, pred)})
        if any(v is None for _, _, v in rows):
            continue
        e = np.array([v for _, _, v in rows]) - pred
        off, rise = (e.mean() if level == "mean" else e[0]), (e[-1] - e[0]) / len(e)
        left = e - off - rise * np.arange(len(e))
        lv, b = lv + p.alpha * off, b + p.beta * rise
        for kind, g in ((0, (p.g00, p.g01)[w]), (1, (p.g10, p.g11)[w])):
            for h in range(24):
                same = [left[i] for i, (_, hh, _) in enumerate(rows) if hh == h]
                season[kind, h] += g * np.mean(same) if same else 0
    return out


@pytest.mark.parametrize("day,zone", [("2024-02-20", "US/Pacific"), ("2024-10-15", "US/Pacific"), ("2024-03-10", "Europe/Berlin"), ("2024-01-01", "UTC")])
@pytest.mark.parametrize("level", ["mean", "first"])
def test_walk_across_clock_changes(spark, day, zone, level):
    rng = np.random.default_rng(4)
    start = int(datetime.fromisoformat(day).replace(tzinfo=timezone.utc).timestamp()) // 3600
    y = {f"s{i}": list(50 + 10 * np.sin(np.arange(24 * 36) / 24 * 2 * np.pi) + rng.normal(0, 3, 24 * 36)) for i in range(2)}
    for i in (5, 24 * 17 + 3, 24 * 20):
        y["s1"][i] = None
    y["s1"] = y["s1"][:-7]
    p = Params(alpha=0.2, beta=0.1, g00=0.15, g01=0.05, g10=0.02, g11=0.3)
    got = localdays.walk_forward_local(frame(spark, y, start), K, zone, p, init_days=14, level=level, size=48).collect()
    for k in y:
        want = loop(y[k], start, zone, p, 14, level)
        rows = {r.slot: r for r in got if r.series == k}
        assert sorted(rows) == sorted(want)
        np.testing.assert_allclose([rows[s].pred for s in sorted(want)], [want[s] for s in sorted(want)], rtol=1e-9)
        shown = {s: datetime.fromtimestamp(s * 3600, timezone.utc).astimezone(ZoneInfo(zone)).hour for s in want}
        assert {s: r.hour for s, r in rows.items()} == shown


def test_utc_days_equal_the_plain_walk(spark):
    rng = np.random.default_rng(6)
    y, temp = {"a": list(50 + rng.normal(0, 5, 24 * 30))}, {"a": rng.integers(50, 300, 24 * 30).tolist()}
    p = Params(alpha=0.2, An=0.3, Ap=0.2)
    df = frame(spark, y, temp=temp)
    want = {r.slot: r.pred for r in smoothing.walk_forward(df, K, p, temp="temp", ninit=14 * 24).collect()}
    got = {r.slot: r.pred for r in localdays.walk_forward_local(df, K, "UTC", p, temp="temp", init_days=14, size=168).collect()}
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-9 for s in want)


def test_a_series_without_values_keeps_its_rows(spark):
    got = localdays.walk_forward_local(frame(spark, {"a": [None] * 24 * 5}), K, "US/Pacific", init_days=2).collect()
    assert got and all(r.pred is None or r.pred != r.pred for r in got)
    assert timedelta(hours=len(got)) > timedelta(days=1)
