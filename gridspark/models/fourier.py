"""Fourier series over the year, the week and the day, fitted by projection in one aggregation."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.operators import grid

PERIODS = ("annual", "weekly", "daily")


def phases(ts: Column | str) -> dict[str, Column]:
    """Position in the year, week and day. The annual phase exceeds 1 on the last day of a leap year."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return {
        "annual": F.dayofyear(ts) / F.lit(365.0),
        "weekly": (F.weekday(ts) * 24 + F.hour(ts)) / F.lit(168.0),
        "daily": F.hour(ts) / F.lit(24.0),
    }


def _terms(n_max: dict[str, int]) -> list[tuple[str, int]]:
    return [(p, n) for p in PERIODS for n in range(1, n_max.get(p, 0) + 1)]


def fit(df: DataFrame, keys: list[str], n_max: dict[str, int], val: str = "val", ts: str = "ts") -> DataFrame:
    """Coefficients per series: (keys, period, n, a, b); the mean is period 'mean', n = 0. Gaps are not allowed
    for in the reference; here rows with NULL values do not count."""
    phase, v = phases(ts), F.col(val)
    terms = _terms(n_max)
    rows = df.where(v.isNotNull())
    sums = rows.groupBy(*keys).agg(
        F.avg(v).alias("mean"),
        *[(2 * F.sum(F.cos(2 * pi * n * phase[p]) * v) / F.count(v)).alias(f"a_{p}_{n}") for p, n in terms],
        *[(2 * F.sum(F.sin(2 * pi * n * phase[p]) * v) / F.count(v)).alias(f"b_{p}_{n}") for p, n in terms])
    cells = [F.struct(F.lit("mean").alias("period"), F.lit(0).alias("n"), F.col("mean").alias("a"),
                      F.lit(0.0).alias("b"))]
    cells += [F.struct(F.lit(p).alias("period"), F.lit(n).alias("n"), F.col(f"a_{p}_{n}").alias("a"),
                       F.col(f"b_{p}_{n}").alias("b")) for p, n in terms]
    return sums.select(*keys, F.explode(F.array(*cells)).alias("c")).select(*keys, "c.*")


def predict(df: DataFrame, coefficients: DataFrame, keys: list[str], n_max: dict[str, int], ts: str = "ts",
            out: str = "fourier", size: int = grid.CHUNK) -> DataFrame:
    """Evaluate fitted series at the rows of `df` (needs `slot`)."""
    terms, phase = _terms(n_max), phases(ts)

    def pick(col: str, p: str, n: int) -> Column:
        return F.max(F.when((F.col("period") == p) & (F.col("n") == n), F.col(col))).alias(f"{col}_{p}_{n}")

    wide = coefficients.groupBy(*keys).agg(
        pick("a", "mean", 0), *[pick(c, p, n) for p, n in terms for c in ("a", "b")])
    spans = grid.series_stats(df, keys)
    rows = grid.attach(df, spans.join(wide, keys), keys, size)
    total = F.col("a_mean_0")
    for p, n in terms:
        angle = 2 * pi * n * phase[p]
        total = total + F.col(f"a_{p}_{n}") * F.cos(angle) + F.col(f"b_{p}_{n}") * F.sin(angle)
    return rows.select(*df.columns, total.alias(out))
