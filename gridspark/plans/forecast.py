"""Clean, forecast and score demand, end to end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions import timefn
from gridspark.models import features, score, smoothing
from gridspark.operators import align, quality, series
from gridspark.session import materialize


def clean(df: DataFrame, keys: list[str], values: dict[str, int], ts: str = "ts", step: int = timefn.HOUR,
          common: bool = False) -> DataFrame:
    """Regular calendar, then fill NULLs and average extremes down; `values` maps column -> look-back steps."""
    rows = align.calendar_fill(df, keys, list(values), ts, step, common)
    for col, window in values.items():
        rows = quality.remove_na(rows, keys, col, window)
        rows = quality.avg_extremes(rows, keys, col, window)
    return rows


def day_ahead_scores(df: DataFrame, keys: list[str], params: smoothing.Params, ninit: int, val: str = "val",
                     temp: str | None = None, forecast: str | None = None, regress: str | None = None,
                     by: list[str | Column] | None = None) -> DataFrame:
    """Walk the smoothing model forward and score it against persistence and, if given, the utility's forecast and a lag
    regression on the temperature column `regress` (which needs `ts`).

    Scores are per series and half, or per group of `by`. All methods are scored after the initial stretch. `df` must be
    clean (see `clean`); it is written once, since all forecasts read it.
    """
    extra = [c for c in (temp, forecast, regress) if c] + (["ts"] if "ts" in df.columns else [])
    df = materialize(df.select(*dict.fromkeys([*keys, "slot", val, *extra])), "clean")
    given = [c for c in (forecast, "ts") if c in df.columns]
    base = series.persistence(df, keys, val).select(*keys, "slot", "rn", "part", "persist", val, *given)
    model = smoothing.walk_forward(df, keys, params, val, temp, ninit).select(*keys, "slot", "pred")
    rows = base.join(model, [*keys, "slot"], "left")
    methods = {"pred": "smoothing", "persist": "persistence"} | ({forecast: "utility"} if forecast else {})
    if regress:
        learned = features.lag_regression(df, keys, val, regress).select(*keys, "slot", F.col("pred").alias("learned"))
        rows = rows.join(learned, [*keys, "slot"], "left")
        methods["learned"] = "regression"
    return score.scoreboard(rows.where(F.col("rn") >= ninit), by or [*keys, "part"], val, methods)
