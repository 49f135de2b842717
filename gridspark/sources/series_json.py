"""JSON-lines series documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions import numeric, text, timefn
from gridspark.schemas import SERIES_DOC


def read_series(spark: SparkSession, path: str | list[str], origin: bool = False) -> DataFrame:
    """Series and category documents. Plain files are split across tasks; a missing field is NULL.

    `origin` adds a column that orders documents by the time of their file, its name and the place of the part read.
    """
    docs = spark.read.schema(SERIES_DOC).json(path)
    place = F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start")
    return docs.select("*", place.alias("origin")) if origin else docs


def parse_series_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The same from a column of JSON text."""
    return lines.select(F.from_json(column, SERIES_DOC).alias("doc")).select("doc.*")


def series_scan(docs: DataFrame, name_lookup: str | None = None, n: int | None = None,
                order: list[str] | None = None) -> DataFrame:
    """Documents whose name contains `name_lookup` in any case, at most `n` of them in a fixed order."""
    out = docs
    if name_lookup:
        out = out.where(F.lower("name").contains(name_lookup.lower()))
    if n:
        out = out.orderBy(*(order or ["series_id"])).limit(n)
    return out


def name_and_id(docs: DataFrame) -> DataFrame:
    """(name, series_id) of documents that have an id or data."""
    return docs.where((F.coalesce("series_id", F.lit("")) != "") | (F.size("data") > 0)).select("name", "series_id")


def category_lines(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("category_id").isNotNull()).select("category_id", "name", "childseries")


def category_names(docs: DataFrame, order: Column) -> DataFrame:
    """abbr -> full name from category documents; of several names the one with the highest `order` counts."""
    named = docs.where(F.col("category_id").isNotNull()).select(order.alias("pos"), text.meta_name("name").alias("m")).where("m is not null")
    return named.groupBy(F.col("m.abbr").alias("abbr")).agg(F.max_by("m.full_name", "pos").alias("full_name"))


def explode_observations(docs: DataFrame, zero_as_null: bool = False) -> DataFrame:
    """Long rows (ts, source, dest, measure, val, series_id, name), one per data pair.

    Ids that do not parse give NULL source and measure; route those to a reject table.
    """
    parts = text.series_id_parts("series_id").alias("p")
    rows = observations(docs.select("series_id", "name", parts, F.explode("data").alias("pair")), zero_as_null)
    return rows.select("ts", "source", "dest", "measure", "val", "series_id", "name")


def observations(pairs: DataFrame, zero_as_null: bool = False) -> DataFrame:
    """Long rows from exploded pairs (p, the parts of the id, and pair); all other columns are kept."""
    d = F.col("pair")
    val = F.get(d, F.lit(1)).try_cast("double")
    return pairs.select(
        timefn.parse_hour(F.get(d, F.lit(0))).alias("ts"),
        F.col("p.source").alias("source"), F.col("p.dest").alias("dest"), F.col("p.tag").alias("measure"),
        (numeric.zero_to_null(val) if zero_as_null else val).alias("val"), *[c for c in pairs.columns if c != "p"])


def store_documents(docs: DataFrame, path: str) -> None:
    """Every document as it is, as parquet: the document store behind `select.regex_find` and `find_one`."""
    docs.write.mode("errorifexists").parquet(path)
