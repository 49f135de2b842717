"""Small series for tests, and the plain loops the operators are checked against."""

from __future__ import annotations

import numpy as np
import pandas as pd

from gridspark.functions import timefn

MONDAY = 19723 * 24  # slot of Monday 2024-01-01 00:00


def frame(spark, series: dict[str, list], start: int = MONDAY, step: int = timefn.HOUR, **columns):
    """Long frame (series, slot, ts, val) of regular series; None stays NULL."""
    rows = []
    for name, values in series.items():
        for i, v in enumerate(values):
            extra = [columns[c][name][i] for c in columns]
            rows.append((name, start + i, None if v is None or v != v else float(v), *extra))
    ddl = "series string, slot long, val double" + "".join(f", {c} int" for c in columns)
    df = spark.createDataFrame(rows, ddl)
    return df.withColumn("ts", timefn.slot_ts("slot", step))


def values(df, col: str, order: str = "slot") -> dict[str, list]:
    """series -> values in order."""
    out: dict[str, list] = {}
    for row in sorted(df.select("series", order, col).collect(), key=lambda r: (r[0], r[1])):
        out.setdefault(row[0], []).append(row[2])
    return out


def same(got: dict[str, list], want: dict[str, list], tol: float = 1e-9) -> None:
    assert got.keys() == want.keys()
    for k in want:
        a = np.array([np.nan if v is None else v for v in got[k]], float)
        b = np.array([np.nan if v is None else v for v in want[k]], float)
        np.testing.assert_allclose(a, b, rtol=tol, atol=tol, err_msg=k)


def messy(rng, n: int) -> list:
    x = rng.normal(100, 10, n)
    x[rng.random(n) < 0.08] = 0
    x[rng.random(n) < 0.03] *= 50
    return [None if hole else float(v) for v, hole in zip(x, rng.random(n) < 0.15)]


def loop_remove_na(x: list, w: int) -> list:
    s = pd.Series(x, dtype=float)
    holes = s.isna().to_numpy()
    s[holes] = s.mean()
    y = s.to_list()
    for i in np.flatnonzero(holes):
        y[i] = y[i - w]
    return y


def loop_avg_extremes(x: list, w: int) -> list:
    s = pd.Series(x, dtype=float)
    bad = ((s - s.mean()) > 4 * s.std()) | (s == 0)
    y = s.to_list()
    for i in np.flatnonzero(bad.to_numpy()):
        y[i] = y[i - w]
    return y
