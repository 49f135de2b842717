"""Key-wise replacement of observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_wins(df: DataFrame, keys: list[str], value: str, order: Column) -> DataFrame:
    """One row per key with the value of the highest `order`. An aggregation: repeated keys combine map-side."""
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def upsert(existing: DataFrame, new: DataFrame, keys: list[str], value: str, order: str | None = None,
           spread: list[str] | None = None) -> DataFrame:
    """Existing rows overwritten by new ones on equal keys, new keys added.

    `order` ranks several new rows of one key; without it they must be unique. Applying the same update twice
    changes nothing. `spread` names some of the keys to shuffle by.
    """
    rank = F.col(order) if order else F.lit(0)
    old = existing.select(*keys, value, F.struct(F.lit(0).alias("new"), F.lit(None).cast(
        new.schema[order].dataType if order else "int").alias("rank")).alias("prio"))
    upd = new.select(*keys, value, F.struct(F.lit(1).alias("new"), rank.alias("rank")).alias("prio"))
    rows = old.unionByName(upd)
    return last_wins(rows.repartition(*spread) if spread else rows, keys, value, F.col("prio"))
