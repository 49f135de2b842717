"""File sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("compression", "gzip").csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def write_name_map(df: DataFrame, path: str, key: str = "abbr", value: str = "full_name") -> None:
    """One small JSON object per line: {key: value}."""
    df.select(F.to_json(F.create_map(key, value)).alias("value")).write.mode("errorifexists").text(path)


def record_json(columns: dict[str, str | Column]) -> Column:
    """One training record as JSON text."""
    cells = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()]
    return F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})
