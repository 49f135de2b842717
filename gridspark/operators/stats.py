"""Aggregates over series. Everything combines map-side before it is shuffled."""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions import text, timefn
from gridspark.operators import grid
from gridspark.session import materialize


def series_stats(df: DataFrame, keys: list[str], val: str = "val") -> DataFrame:
    v = F.col(val)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min_val"), F.max(v).alias("max_val"))


def series_max(df: DataFrame, keys: list[str], val: str = "val", ts: str = "ts",
               year: int | None = None) -> DataFrame:
    """Largest value per series, over one year when given, largest first."""
    rows = df if year is None else df.where(timefn.partial_date_slice(ts, f"{year:04d}"))
    return rows.groupBy(*keys).agg(F.max(val).alias("max_val")).orderBy(F.desc("max_val"), *keys)


def type_counts(df: DataFrame, name: str = "name") -> DataFrame:
    """Series per first name level."""
    return df.groupBy(text.name_level(name, 0).alias("series_type")).agg(F.count(F.lit(1)).alias("n"))


def type_counts_containing(df: DataFrame, name: str = "name") -> DataFrame:
    """As the notebooks count it: series whose first level contains the type as a substring.

    Types are counted first; each then lists its own substrings, so that containment becomes an equality join.
    """
    types = type_counts(df, name).withColumnRenamed("series_type", "t")
    last = F.length("t")
    inner = F.flatten(F.transform(F.sequence(F.lit(1), last), lambda i: F.transform(
        F.sequence(F.lit(1), last - i + 1), lambda n: F.substring(F.col("t"), i, n))))
    parts = types.where(last > 0).select("n", F.explode(F.array_distinct(inner)).alias("series_type"))
    wanted = types.select(F.col("t").alias("series_type"))
    return parts.join(wanted, "series_type").groupBy("series_type").agg(F.sum("n").alias("n"))


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, NULL pairs skipped: one aggregation over the rows."""
    pairs = list(combinations_with_replacement(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"c{i}").alias("r"))
             for i, (a, b) in enumerate(pairs) for x, y in dict.fromkeys([(a, b), (b, a)])]
    return wide.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


PAIR_SUMS = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"


def corr_series(df: DataFrame, key: str, time: str, val: str = "val", block: int = 256, chunk: int = 16_128) -> DataFrame:
    """Pearson correlation (a, b, r) of every pair of series of a long frame, over the times at which both have a value.

    Series are numbered and cut into blocks; a task multiplies two blocks over one stretch of `chunk` hours, so that the plan does not
    grow with the series and no series or time meets in one task. Values are taken relative to the series' mean first. A series
    repeats at most one value per time. A NULL key takes no part; a pair without two common times or without spread gives NULL.
    """
    rows = df.select(F.col(key).cast("string").alias("k"), timefn.slot_of(time).alias("slot"), F.col(val).cast("double").alias("v")).where(
        "k is not null and v is not null and not isnan(v)")
    series = materialize(grid.dense_ids(rows.groupBy("k").agg(F.avg("v").alias("mean")), "k", "id", 0), "series-numbers")
    blocks = series.agg(F.max("id")).first()[0]
    blocks = 0 if blocks is None else blocks // block + 1
    at = F.floor(F.col("id") / block).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.lit(max(blocks - 1, 0))), lambda b: F.struct(F.least(at, b).alias("a"), F.greatest(at, b).alias("b")))
    spread = (rows.join(series, "k").select((F.col("v") - F.col("mean")).alias("v"), "id", "slot", F.floor(F.col("slot") / chunk).alias("part"),
                                            F.explode(pairs).alias("p")).select("v", "id", "slot", "part", "p.a", "p.b"))

    def multiply(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = int(pdf["a"].iloc[0]), int(pdf["b"].iloc[0])
        times, row = np.unique(pdf["slot"].to_numpy(), return_inverse=True)
        ids, v = pdf["id"].to_numpy(), pdf["v"].to_numpy()

        def side(k: int) -> tuple[np.ndarray, np.ndarray]:
            own = ids // block == k
            x, there = np.zeros((len(times), block)), np.zeros((len(times), block))
            x[row[own], ids[own] - k * block], there[row[own], ids[own] - k * block] = v[own], 1
            return x, there

        (x, mx), (y, my) = side(a), side(b)
        n = mx.T @ my
        i, j = np.nonzero(n)
        sums = [n, x.T @ my, mx.T @ y, (x * x).T @ my, mx.T @ (y * y), x.T @ y]
        return pd.DataFrame(dict(zip(["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"], [i + a * block, j + b * block, *(m[i, j] for m in sums)])))

    sums = spread.groupBy("part", "a", "b").applyInPandas(multiply, PAIR_SUMS).where("i <= j")
    total = sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    vx, vy = F.col("n") * F.col("sxx") - F.col("sx") ** 2, F.col("n") * F.col("syy") - F.col("sy") ** 2
    r = F.when((F.col("n") > 1) & (vx > 0) & (vy > 0), (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt(vx) / F.sqrt(vy))
    total = total.select("i", "j", r.alias("r"))
    both = total.unionByName(total.where("i < j").select(F.col("j").alias("i"), F.col("i").alias("j"), "r"))
    names = series.select(F.col("id").alias("i"), F.col("k").alias("a")), series.select(F.col("id").alias("j"), F.col("k").alias("b"))
    return both.join(names[0], "i").join(names[1], "j").select("a", "b", "r")


def rmse(pred: Column, actual: Column) -> Column:
    """Root mean square error; the divisor counts every row, NULLs too."""
    return F.sqrt(F.sum((pred - actual) * (pred - actual)) / F.count(F.lit(1)))


def mape(pred: Column, actual: Column, eps: float = 0.0) -> Column:
    """Mean |1 - pred/actual|; rows whose (shifted) actual is 0 do not count."""
    base = actual + eps
    return F.avg(F.when(base != 0, F.abs(1 - pred / base)))


def scale_by_max(df: DataFrame, keys: list[str], val: str = "val") -> DataFrame:
    """val divided by its series maximum. Needs `slot`; the maxima are aggregated first and joined back."""
    top = grid.series_stats(df, keys, F.max(val).alias("max_val"))
    return (grid.attach(df, top, keys).drop("lo", "hi")
            .withColumn("scaled", F.when(F.col("max_val") != 0, F.col(val) / F.col("max_val"))))


def state_fuel_pivot(df: DataFrame, year: int, fuels: list[str], by: str = "state") -> DataFrame:
    """One row per state, one column per fuel, for one year of (state, fuel, obs_date, obs_val)."""
    rows = df.where(F.col("obs_date") == F.lit(f"{year:04d}-12-31").cast("date"))
    return rows.groupBy(by).pivot("fuel", fuels).agg(F.first("obs_val", ignorenulls=True))


def elec_gen_rows(df: DataFrame, series_id: str = "series_id") -> DataFrame:
    """Add state and fuel taken from annual ids of the form ELEC.GEN.{fuel}-{state}-99.A; others are dropped."""
    # fixed value: the id pattern
    pattern = r"^ELEC\.GEN\.(\w+)-(\w+)-99\.A$"
    return (df.where(F.col(series_id).rlike(pattern))
            .withColumn("fuel", F.regexp_extract(series_id, pattern, 1))
            .withColumn("state", F.regexp_extract(series_id, pattern, 2)))


def fuel_share(matrix: DataFrame, fuels: list[str], total: str = "ALL", by: str = "state") -> DataFrame:
    return matrix.select(by, *[F.when(F.col(total) != 0, F.col(f) / F.col(total)).alias(f) for f in fuels])


def minmax_fill(df: DataFrame, value: str, name: str, skip: list[str]) -> DataFrame:
    """Map colours: range rounded to 2 decimals, NULL drawn as the minimum, `skip` names left out."""
    lo = df.agg(F.round(F.min(value), 2)).scalar()
    hi = df.agg(F.round(F.max(value), 2)).scalar()
    rows = df.where(~F.col(name).isin(*skip)).withColumn("lo", lo).withColumn("hi", hi)
    filled = F.coalesce(F.col(value), F.col("lo"))
    span = F.col("hi") - F.col("lo")
    return rows.withColumn("shade", F.when(span != 0, (filled - F.col("lo")) / span)).drop("lo", "hi")


def season_profile(df: DataFrame, keys: list[str], val: str = "val", ts: str = "ts") -> DataFrame:
    """Mean per day type (1 = weekend) and hour."""
    return df.groupBy(*keys, timefn.is_weekend(ts).cast("int").alias("weekend"), F.hour(ts).alias("hour")).agg(
        F.avg(val).alias("mean"))
