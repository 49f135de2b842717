"""File listings and which files to use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions import text


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, length) below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", "length")


def expected_files(expected: DataFrame, listing: DataFrame, by: list[str]) -> DataFrame:
    """Per group: files expected and files found with content. Both sides need `file_name`."""
    have = listing.where("length > 0").select("file_name").distinct().withColumn("have", F.lit(1))
    return (expected.join(have, "file_name", "left").groupBy(*by)
            .agg(F.count(F.lit(1)).alias("n_expected"), F.count("have").alias("n_found")))


def existing_files(expected: DataFrame, listing: DataFrame) -> DataFrame:
    return expected.join(listing.where("length > 0").select("file_name"), "file_name", "left_semi")


def first_key_per_day(listing: DataFrame, use_newest: bool = False, key: str = "key") -> DataFrame:
    """Per variable and day the first (or last) archive key that holds the variable's prefix."""
    # fixed value: the archive's folder layout
    pattern = r"^wmo/(\w+)/(\d{4})/(\d{2})/(\d{2})/"

    def part(i: int):
        return F.regexp_extract(key, pattern, i)

    rows = listing.where(F.col(key).rlike(pattern)).select(
        key, part(1).alias("var"), F.make_date(*[part(i).cast("int") for i in (2, 3, 4)]).alias("day"))
    rows = rows.where(F.col(key).contains(text.forecast_prefix("var")))
    pick = F.max(key) if use_newest else F.min(key)
    return rows.groupBy("var", "day").agg(pick.alias("picked"))
