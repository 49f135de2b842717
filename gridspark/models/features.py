"""Learned day-ahead forecasters from calendar, temperature and lag features."""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.functions import timefn
from gridspark.operators import grid, series

FEATURES = ["hour_frac", "week_frac", "year_frac", "temp", "l_day", "d_day", "l_week"]


def joint_features(df: DataFrame, keys: list[str], val: str = "val", temp: str = "temp", ts: str = "ts",
                   size: int = grid.CHUNK) -> DataFrame:
    """Features known a day ahead: calendar, temperature, yesterday's value and change, last week's value."""
    rows = series.lagged(df, keys, val, [24, 25, 168], "l", size)
    rows = rows.withColumns(timefn.calendar_features(ts))
    return (rows.withColumn("d_day", F.col("l24") - F.col("l25"))
            .withColumnRenamed("l24", "l_day").withColumnRenamed("l168", "l_week")
            .withColumnRenamed(temp, "temp").drop("l25"))


def fit_linear(df: DataFrame, keys: list[str], label: str, features: list[str], ridge: float = 1e-9) -> DataFrame:
    """Least squares for every series at once: Spark sums the normal equations, Python solves one small system
    per series. Rows with NULLs do not count. Output: keys, n, coef array (intercept first)."""
    names = ["one", *features]
    rows = df.dropna(subset=[label, *features]).withColumn("one", F.lit(1.0))
    pairs = list(combinations_with_replacement(range(len(names)), 2))
    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs]).alias("xx"),
        F.array(*[F.sum(F.col(c) * F.col(label)) for c in names]).alias("xy"))
    schema = sums.select(*keys, "n", F.col("xy").alias("coef")).schema

    def solve(batches):
        i, j = np.array(pairs).T
        for pdf in batches:
            coefs = []
            for xx, xy in zip(pdf["xx"], pdf["xy"]):
                m = np.zeros((len(names), len(names)))
                m[i, j] = m[j, i] = np.asarray(xx, float)
                scale = np.sqrt(np.maximum(np.diag(m), 1e-300))
                normal = m / np.outer(scale, scale) + ridge * np.eye(len(names))
                coefs.append(np.linalg.lstsq(normal, np.asarray(xy, float) / scale, rcond=None)[0] / scale)
            yield pd.concat([pdf[[*keys, "n"]], pd.Series(coefs, name="coef", index=pdf.index, dtype=object)], axis=1)

    return sums.mapInPandas(solve, schema)


def predict_linear(df: DataFrame, coefs: DataFrame, keys: list[str], features: list[str], out: str = "pred",
                   size: int = grid.CHUNK) -> DataFrame:
    spans = grid.series_stats(df, keys)
    rows = grid.attach(df, spans.join(coefs.select(*keys, "coef"), keys), keys, size)
    total = F.col("coef")[0]
    for i, c in enumerate(features, start=1):
        total = total + F.col("coef")[i] * F.col(c)
    return rows.select(*df.columns, total.alias(out))


def lag_regression(df: DataFrame, keys: list[str], val: str = "val", temp: str = "temp",
                   size: int = grid.CHUNK) -> DataFrame:
    """Fit on the first half of each series, predict all rows. Output: keys, slot, ts, val, part, pred."""
    rows = series.split_half(joint_features(df, keys, val, temp, size=size), keys, size)
    coefs = fit_linear(rows.where(F.col("part") == "train"), keys, val, FEATURES)
    return predict_linear(rows, coefs, keys, FEATURES, size=size).select(*keys, "slot", "ts", val, "part", "pred")


def gbt_forecaster(train: DataFrame, label: str, features: list[str] | None = None, **params) -> PipelineModel:
    """One boosted-tree model over all series' rows, trained by Spark ML."""
    features = features or FEATURES
    assemble = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip")
    trees = GBTRegressor(labelCol=label, featuresCol="features", predictionCol="pred", **params)
    return Pipeline(stages=[assemble, trees]).fit(train.dropna(subset=[label]))
