"""Demand as a rectified-linear function of temperature."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARAMS = ["a0", "ap", "an", "tp", "tn"]


def response(temp: Column, ap: Column, an: Column, tp: Column, tn: Column, a0: Column | float = 0.0) -> Column:
    """a0 + ap [T - tp]+ + an [tn - T]+"""
    return a0 + ap * F.greatest(temp - tp, F.lit(0.0)) + an * F.greatest(tn - temp, F.lit(0.0))


def response_abs(temp: Column, a0: Column, ap: Column, tp: Column) -> Column:
    """a0 + ap |T - tp|"""
    return a0 + ap * F.abs(temp - tp)


def gradient(df: DataFrame, keys: list[str], val: str = "val", temp: str = "temp") -> DataFrame:
    """Mean-square gradient and cost per series; the parameters are columns a0, ap, an, tp, tn of the rows."""
    t, y = F.col(temp), F.col(val)
    rows = df.where(t.isNotNull() & y.isNotNull())
    err = response(t, F.col("ap"), F.col("an"), F.col("tp"), F.col("tn"), F.col("a0")) - y
    hot, cold = t > F.col("tp"), t < F.col("tn")
    n = F.count(F.lit(1))

    def mean_if(cond: Column, value: Column) -> Column:
        return F.sum(F.when(cond, value).otherwise(F.lit(0.0))) / n

    return rows.groupBy(*keys).agg(
        (F.sum(err) / n).alias("d_a0"),
        mean_if(hot, (t - F.col("tp")) * err).alias("d_ap"),
        mean_if(cold, (F.col("tn") - t) * err).alias("d_an"),
        mean_if(hot, -F.col("ap") * err).alias("d_tp"),
        mean_if(cold, F.col("an") * err).alias("d_tn"),
        (F.sum(err * err) / n).alias("cost"))


def _descend(t: np.ndarray, n: np.ndarray, y: np.ndarray, y2: np.ndarray, start: np.ndarray, alpha: float,
             rtol: float, nmax: int) -> tuple[np.ndarray, float, int]:
    """Gradient descent on temperature groups: n rows at temperature t with demand sum y and square sum y2."""
    total = n.sum()

    def cost_and_grad(p: np.ndarray) -> tuple[float, np.ndarray]:
        a0, ap, an, tp, tn = p
        hot, cold = t > tp, t < tn
        pred = a0 + ap * (t - tp) * hot + an * (tn - t) * cold
        err = n * pred - y
        cost = (n * pred**2 - 2 * pred * y + y2).sum() / total
        grad = np.array([err.sum(), ((t - tp) * err * hot).sum(), ((tn - t) * err * cold).sum(),
                         -ap * (err * hot).sum(), an * (err * cold).sum()]) / total
        return cost, grad

    params, (cost, grad) = start, cost_and_grad(start)
    for step in range(1, nmax + 1):
        params = params - alpha * grad
        previous, (cost, grad) = cost, cost_and_grad(params)
        if cost == 0 or abs(1 - previous / cost) < rtol or not np.isfinite(cost):
            break
    return params, cost, step


def fit(df: DataFrame, keys: list[str], val: str = "val", temp: str = "temp", alpha: float = 0.01,
        rtol: float = 1e-6, nmax: int = 200, parts: int = 100) -> DataFrame:
    """Fit all series by gradient descent from the means, with half the span of the demand over that of the temperature.

    Rows of a series are first summed per temperature, to the `parts`-th part of its unit (map-side). What reaches the
    per-series descent is one row per such temperature, whose number depends on the climate and not on the length
    of the series, and no iteration reads the observations again.
    Output: keys, a0, ap, an, tp, tn, cost, steps.
    """
    t, y = F.round(F.col(temp).cast("double") * parts) / parts, F.col(val)
    groups = (df.where(F.col(temp).isNotNull() & y.isNotNull())
              .groupBy(*keys, t.alias("t"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("y"), F.sum(y * y).alias("y2"),
                   F.min(y).alias("lo"), F.max(y).alias("hi")))
    fields = [*groups.select(*keys).schema.fields]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in fields]
                       + [f"{p} double" for p in PARAMS] + ["cost double", "steps int"])

    def descend(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t")
        t, n, y = (pdf[c].to_numpy(float) for c in ("t", "n", "y"))
        slope = 0.5 * (pdf["hi"].max() - pdf["lo"].min()) / max(t.max() - t.min(), 1.0)
        mean_t = (n * t).sum() / n.sum()
        start = np.array([y.sum() / n.sum(), slope, slope, mean_t, mean_t])
        params, cost, steps = _descend(t, n, y, pdf["y2"].to_numpy(float), start, alpha, rtol, nmax)
        return pd.DataFrame([[*pdf[keys].iloc[0], *params, cost, steps]], columns=[*keys, *PARAMS, "cost", "steps"])

    return groups.groupBy(*keys).applyInPandas(descend, schema)
