"""Score forecasts against each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.operators import stats


def unpivot_forecasts(df: DataFrame, ids: list[str | Column], actual: str, methods: dict[str, str]) -> DataFrame:
    """One row per observation and method; `methods` maps forecast column -> method name."""
    cells = [F.struct(F.lit(name).alias("method"), F.col(c).cast("double").alias("pred"))
             for c, name in methods.items()]
    rows = df.select(*ids, F.col(actual).alias("actual"), F.explode(F.array(*cells)).alias("m"))
    return rows.select(*rows.columns[:-1], "m.method", "m.pred")


def scoreboard(df: DataFrame, by: list[str | Column], actual: str, methods: dict[str, str]) -> DataFrame:
    """RMSE and MAPE per method and group, over the rows where both sides exist."""
    long = unpivot_forecasts(df, by, actual, methods)
    names = [c for c in long.columns if c not in ("actual", "pred", "method")]
    rows = long.where(F.col("actual").isNotNull() & F.col("pred").isNotNull())
    return rows.groupBy(*names, "method").agg(
        F.count(F.lit(1)).alias("n"),
        stats.rmse(F.col("pred"), F.col("actual")).alias("rmse"),
        stats.mape(F.col("pred"), F.col("actual")).alias("mape"))
