"""15-minute meter files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions import timefn
from gridspark.schemas import METER_CSV


def read_meter(spark: SparkSession, path: str, nrows: int | None = None) -> DataFrame:
    """ID, LocalDateTime and kWh of a headed CSV; other columns are never parsed. Zip files must be unpacked."""
    rows = spark.read.option("header", True).csv(path).select(
        "ID", "LocalDateTime", F.col("kWh").try_cast("double").alias("kWh"))
    return rows.limit(nrows) if nrows else rows


def parse_meter_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The same from text lines that hold exactly these three fields."""
    return lines.select(F.from_csv(column, METER_CSV.simpleString()[7:-1].replace(":", " ")).alias("m")).select("m.*")


def meter_series(rows: DataFrame) -> DataFrame:
    """(ID, ts, kWh) with parsed local times; unreadable times are NULL."""
    return rows.select("ID", timefn.meter_time("LocalDateTime").alias("ts"), "kWh")
