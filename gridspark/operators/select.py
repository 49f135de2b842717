"""Filters, projections, ordering and set operations."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridspark.functions import timefn
from gridspark.operators import grid


def multi_like(df: DataFrame, columns: list[str], match_names: list[str], freq: str, name: str = "name") -> DataFrame:
    """Rows whose name contains every pattern (case-sensitive LIKE, wildcards allowed) and whose `f` is LIKE freq."""
    conds = [F.col(name).like(f"%{m}%") for m in match_names] + [F.col("f").like(freq)]
    return df.where(reduce(and_, conds)).select(*columns)


def regex_find(df: DataFrame, column: str, pattern: str, columns: list[str]) -> DataFrame:
    return df.where(F.col(column).rlike(pattern)).select(*columns)


def find_one(df: DataFrame, column: str, pattern: str, columns: list[str]) -> DataFrame:
    return regex_find(df, column, pattern, columns).limit(1)


def route_series(docs: DataFrame) -> DataFrame:
    """Drop documents with neither id nor data, keep UTC series, and mark interchange series."""
    empty = F.coalesce(F.col("series_id"), F.lit("")) == ""
    no_data = F.col("data").isNull() | (F.size("data") == 0)
    # fixed values: the words that route a series
    return (docs.where(~(empty & no_data) & F.col("name").contains("UTC"))
            .withColumn("target", F.when(F.col("name").contains("Actual Net Interchange"), F.lit("eba_inter"))
                        .otherwise(F.lit("eba"))))


def hour_slice(df: DataFrame, hour: int, ts: str = "ts") -> DataFrame:
    return df.where(F.hour(ts) == hour)


def row_slice(df: DataFrame, keys: list[str], start: int, end: int | None, size: int = grid.CHUNK) -> DataFrame:
    """Positions [start, end) of each series on a regular calendar (needs `slot`); adds `rn`."""
    spans = grid.series_stats(df, keys)
    rows = grid.attach(df, spans, keys, size).withColumn("rn", F.col("slot") - F.col("lo"))
    cond = F.col("rn") >= start
    if end is not None:
        cond = cond & (F.col("rn") < end)
    return rows.where(cond).drop("lo", "hi")


def first_per_key(df: DataFrame, keys: list[str], order: Column, columns: list[str]) -> DataFrame:
    """Keep the row with the smallest `order` per key: an aggregation, so hot keys combine map-side."""
    best = F.min_by(F.struct(*columns), order)
    return df.groupBy(*keys).agg(best.alias("row")).select(*keys, "row.*")


def top_series(df: DataFrame, key: str, value: Column, k: int) -> DataFrame:
    """The k series with the largest maximum, largest first."""
    return (df.groupBy(key).agg(F.max(value).alias("max_val"))
            .orderBy(F.desc_nulls_last("max_val"), key).limit(k))


def rank_positions(df: DataFrame, key: str, value: Column, positions: list[int]) -> DataFrame:
    """Series at the given 0-based ranks by descending maximum; reads only the top max(positions)+1."""
    top = top_series(df, key, value, max(positions) + 1)
    rank = F.row_number().over(W.orderBy(F.desc_nulls_last("max_val"), key)) - 1
    return top.withColumn("position", rank).where(F.col("position").isin(*positions))


def union_frames(*frames: DataFrame) -> DataFrame:
    """Append frames; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def date_slice(df: DataFrame, start: str, end: str | None = None, ts: str = "ts") -> DataFrame:
    return df.where(timefn.partial_date_slice(ts, start, end))
