"""Weather station files: hourly observations, station history and airport lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark import vocab
from gridspark.functions import numeric, text, timefn
from gridspark.operators import select


def read_isd(spark: SparkSession, path: str | list[str], expected: DataFrame | None = None) -> DataFrame:
    """Hourly station files (gz allowed, one task per file) with the file name of each line.

    `expected` (file_name and other columns) leaves the lines of other files unparsed and adds its columns and the text.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file_name"))
    if expected is None:
        return parse_isd_lines(lines, ["file_name"])
    lines = lines.join(expected, "file_name")
    return parse_isd_lines(lines, lines.columns)


def parse_isd_lines(lines: DataFrame, keep: list[str] | None = None, missing: list[int] | None = None) -> DataFrame:
    """12 whitespace-separated integers per line; missing codes become NULL. Values keep their tenths."""
    fields = F.split(F.trim("value"), r"\s+")
    cells = {name: F.get(fields, F.lit(i)).try_cast("int") for i, name in enumerate(vocab.ISD_FIELDS)}
    ts = timefn.hour_timestamp(*[cells[c] for c in ("year", "month", "day", "hour")])
    return lines.select(
        *(keep or []), ts.alias("ts"),
        *[numeric.missing_to_null(cells[c], missing).alias(c) for c in vocab.ISD_FIELDS[4:]])


def station_frame(wide: DataFrame, stations: DataFrame) -> DataFrame:
    """Add city, state, their label and the region to station rows (join on callsign)."""
    return region_map(wide.join(stations, "callsign"))


def region_map(stations: DataFrame) -> DataFrame:
    regions = vocab.region_dim(stations.sparkSession)
    return (stations.withColumn("city_state", F.concat_ws(", ", "city", "state"))
            .join(regions, "state", "left"))


def to_long(wide: DataFrame, measures: list[str] | None = None, zero_as_null: bool = False) -> DataFrame:
    """(ts, callsign, measure, val): one row per loaded measure."""
    def cell(m: str):
        val = F.col(m).cast("double")
        return F.struct(F.lit(m).alias("measure"), (numeric.zero_to_null(val) if zero_as_null else val).alias("val"))

    cells = F.explode(F.array(*[cell(m) for m in measures or vocab.ISD_LOADED]))
    return wide.select("ts", "callsign", cells.alias("m")).select("ts", "callsign", "m.measure", "m.val")


def read_station_history(spark: SparkSession, path: str) -> DataFrame:
    return parse_station_history(spark.read.text(path))


def parse_station_history(lines: DataFrame, active_after: int = 20150000) -> DataFrame:
    """Fixed-width station list: stations still active after the given yyyymmdd.

    Header lines are known by content (a station line starts with a six-character code and a space), since Spark
    gives rows no file position.
    """
    def cut(start: int, length: int):
        return F.trim(F.substring("value", start, length))

    # fixed values: column offsets of the public station history file
    rows = lines.where(F.col("value").rlike(r"^[0-9A-Z]{6} [0-9]{5} ")).select(
        cut(1, 6).alias("USAF"), cut(8, 5).alias("WBAN"), F.nullif(cut(52, 5), F.lit("")).alias("CALL"),
        cut(58, 7).try_cast("double").alias("LAT"), cut(66, 8).try_cast("double").alias("LON"),
        F.nullif(cut(49, 2), F.lit("")).alias("ST"), cut(92, 8).try_cast("int").alias("END"))
    return rows.where(F.col("END") > active_after).drop("END")


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)


def us_airports(airports: DataFrame) -> DataFrame:
    """Large and medium US airports with every column, renamed as the station join expects."""
    # fixed values: the airport types kept
    return (airports.where((F.col("iso_country") == "US") & F.col("type").isin("large_airport", "medium_airport"))
            .withColumnsRenamed({"ident": "CALL", "municipality": "City"}))


def airport_filter(airports: DataFrame) -> DataFrame:
    return us_airports(airports).select("name", "City", "CALL")


def merge_stations(airports: DataFrame, history: DataFrame, order: list[str]) -> DataFrame:
    """Airports joined with stations on callsign, first match per callsign by `order`. Codes stay text: some hold a letter, and
    leading zeros are part of a file's name."""
    joined = airports.join(history, "CALL")
    columns = [c for c in joined.columns if c != "CALL" and c not in order] + order
    return select.first_per_key(joined, ["CALL"], F.struct(*order), columns)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A list file with one name per line, blanks dropped."""
    return spark.read.text(path).select(F.trim("value").alias("name")).where("name <> ''")


def sorted_callsigns(stations: DataFrame) -> DataFrame:
    return stations.orderBy("state", "callsign").select("callsign", "state")


def with_file_names(stations: DataFrame, years: list[int] | None = None) -> DataFrame:
    """One row per station and year with the file's name."""
    return (stations.withColumn("year", F.explode(F.array(*[F.lit(y) for y in years or vocab.ISD_YEARS])))
            .withColumn("file_name", text.station_file(F.col("year"), F.col("usaf"), F.col("wban"))))
