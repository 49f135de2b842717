"""Load jobs: raw files to long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark import vocab
from gridspark.functions import text
from gridspark.operators import align, grid, select
from gridspark.session import materialize
from gridspark.sources import elec, listing, series_json, warehouse, weather


def source_dim(docs: DataFrame, order: Column | None = None) -> DataFrame:
    """(id, full_name, abbr) of the reporting regions: category names plus the regions outside."""
    spark = docs.sparkSession
    named = series_json.category_names(docs, F.col("category_id") if order is None else order)
    extra = vocab.extra_region_dim(spark).select("abbr", "full_name")
    merged = named.unionByName(extra).groupBy("abbr").agg(F.max("full_name").alias("full_name"))
    return grid.dense_ids(merged, "abbr").select("id", "full_name", "abbr")


def staged_rows(docs: DataFrame) -> DataFrame:
    """One row per document and data pair, written once: all further steps read columns instead of JSON.

    Documents without pairs keep one row with a NULL pair; titles repeat, which dictionary pages make cheap.
    """
    pairs = F.transform("data", lambda d: F.coalesce(d, F.array().cast("array<string>")))
    parts = text.series_id_parts("series_id").alias("p")
    origin = F.col("origin") if "origin" in docs.columns else F.lit(None).cast("string").alias("origin")
    return materialize(docs.select("series_id", "category_id", "name", origin, parts, F.posexplode_outer(pairs).alias("pos", "pair")), "series-rows")


def eba_rows(staged: DataFrame, zero_as_null: bool = False) -> DataFrame:
    """Routed long rows: target, ts, source, dest, measure, val, and for rows that no table can hold a `reason`."""
    # fixed values: the words that route a series
    inter = F.col("name").contains("Actual Net Interchange")
    routed = staged.where(F.col("name").contains("UTC") & F.col("pair").isNotNull())
    reason = F.when(F.col("source").isNull(), F.lit("series_id")).when(F.col("ts").isNull(), F.lit("time"))
    return (series_json.observations(routed, zero_as_null)
            .withColumn("target", F.when(inter, F.lit("eba_inter")).otherwise(F.lit("eba")))
            .withColumn("reason", F.when(inter & F.col("dest").isNull(), F.lit("series_id")).otherwise(reason)))


def eba_rejects(rows: DataFrame) -> DataFrame:
    return rows.where("reason is not null").select("series_id", "name", "pair", "reason")


def series_heads(staged: DataFrame) -> DataFrame:
    """Distinct ids and titles, written once."""
    return materialize(staged.select("series_id", "category_id", "name").distinct(), "series-heads")


def complete_sources(heads: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The source dimension enlarged by names found in titles, and the sources and measures that stay unknown.

    Unknown: (kind, abbr) with kind `source` or `measure`.
    """
    pairs = (heads.where(F.col("series_id").isNotNull()).select("name").distinct()
             .select(F.explode(text.name_abbr_pairs("name")).alias("p")).select("p.abbr", "p.full_name"))
    ids = (heads.where(F.col("name").contains("UTC")).select("series_id", "name").distinct()
           .select("name", text.series_id_parts("series_id").alias("p")))
    used = ids.select(F.explode(F.array("p.source", "p.dest")).alias("abbr")).where("abbr <> 'ALL'")
    enriched, unknown = align.dim_enrich(used, known, pairs)
    tags = ids.where(~F.col("name").contains("Actual Net Interchange")).select(F.col("p.tag").alias("abbr"))
    strange = tags.where("abbr is not null").distinct().join(vocab.measure_dim(heads.sparkSession), "abbr", "left_anti")
    return enriched, unknown.select(F.lit("source").alias("kind"), "abbr").unionByName(
        strange.select(F.lit("measure").alias("kind"), "abbr"))


def eba_with_ids(docs: DataFrame, zero_as_null: bool = False) -> dict[str, DataFrame]:
    """Both facts with dimension ids, the completed source dimension, what could not be resolved and what was rejected.

    The documents are parsed once; the dimension is written too, which gives the star joins its true size. Rows of
    `unknown` keys carry NULL ids.
    """
    staged = staged_rows(docs)
    heads = series_heads(staged)
    enriched, unknown = complete_sources(heads, source_dim(heads))
    sources = materialize(enriched, "sources")
    measures = vocab.measure_dim(docs.sparkSession)
    rows = eba_rows(staged, zero_as_null)
    good = rows.where("reason is null")
    src = sources.select(F.col("abbr").alias("source"), F.col("id").alias("source_id"))
    dst = sources.select(F.col("abbr").alias("dest"), F.col("id").alias("dest_id"))
    tag = measures.select(F.col("abbr").alias("measure"), F.col("id").alias("measure_id"))
    return {
        "eba": good.where("target = 'eba'").join(src, "source", "left").join(tag, "measure", "left").select(
            "ts", "source_id", "measure_id", "val"),
        "eba_inter": good.where("target = 'eba_inter'").join(src, "source", "left").join(dst, "dest", "left").select(
            "ts", "source_id", "dest_id", "val"),
        "eba_meta": sources, "eba_measure": measures, "unknown": unknown, "rejects": eba_rejects(rows),
    }


class UnknownKeys(ValueError):
    """A load met sources or measures that no dimension and no title names."""


def load_eba(spark: SparkSession, path: str, database: str = "default", drop: bool = False,
             n_series: int | None = None, zero_as_null: bool = False) -> None:
    """JSON lines to tables partitioned by month. Running it again with the same or newer files changes only what is new.

    Names of sources come from categories, fixed regions and titles, in this order; known sources keep their ids. Unknown
    sources or measures stop the load before any fact is written. Rows without a readable id or time go to
    `eba_rejects`. Of several values of one key the last counts: that of the newest file, and there
    the last of its document.
    """
    tables = ["eba", "eba_inter", "eba_meta", "eba_measure", "eba_rejects"]
    if drop:
        warehouse.drop_tables(spark, tables, database, execute=True)
    warehouse.create_tables(spark, tables, database)
    docs = series_json.read_series(spark, path, origin=True)
    if n_series:
        series = select.route_series(docs).orderBy("series_id").limit(n_series).drop("target")
        docs = series.unionByName(docs.where("category_id is not null"))
    staged = staged_rows(docs)
    heads = series_heads(staged)
    named = warehouse.merge_dim(source_dim(heads), "eba_meta", ["abbr"], database)
    enriched, unknown = complete_sources(heads, named)
    warehouse.merge_dim(enriched, "eba_meta", ["abbr"], database)
    vocab.measure_dim(spark).select(*spark.table(f"{database}.eba_measure").columns).write.insertInto(
        f"{database}.eba_measure", overwrite=True)
    if missing := unknown.orderBy("kind", "abbr").limit(20).collect():
        raise UnknownKeys(", ".join(f"{r.kind} {r.abbr}" for r in missing))
    rows = eba_rows(staged, zero_as_null)
    warehouse.append_new(eba_rejects(rows), "eba_rejects", database)
    good = rows.where("reason is null").withColumn("at", F.struct("origin", "pos"))
    facts = good.where("target = 'eba'").select("ts", "source", "measure", "val", "at")
    warehouse.upsert_table(facts, "eba", ["ts", "source", "measure"], "val", database, order="at")
    flows = good.where("target = 'eba_inter'").select("ts", "source", "dest", "val", "at")
    warehouse.upsert_table(flows, "eba_inter", ["ts", "source", "dest"], "val", database, order="at")


def load_isd(spark: SparkSession, folder: str, stations: DataFrame, database: str = "default", drop: bool = False,
             zero_as_null: bool = False) -> DataFrame:
    """Station files to the long weather table, by month. Returns files expected and found per station.

    Lines of files that no station expects are left before they are parsed; lines without a readable time go to
    `isd_rejects`. Running it again changes only what is new.
    """
    tables = ["isd", "isd_meta", "isd_measure", "isd_rejects"]
    if drop:
        warehouse.drop_tables(spark, tables, database, execute=True)
    warehouse.create_tables(spark, tables, database)
    warehouse.merge_dim(stations, "isd_meta", ["usaf", "wban"], database)
    vocab.isd_measure_dim(spark).select(*spark.table(f"{database}.isd_measure").columns).write.insertInto(
        f"{database}.isd_measure", overwrite=True)
    expected = weather.with_file_names(stations)
    wide = materialize(weather.read_isd(spark, folder, expected.select("file_name", "callsign")), "isd-rows")
    bad = wide.where("ts is null").select("file_name", F.col("value").alias("line"), F.lit("time").alias("reason"))
    warehouse.append_new(bad, "isd_rejects", database)
    rows = weather.to_long(wide.where("ts is not null"), zero_as_null=zero_as_null)
    warehouse.upsert_table(rows, "isd", ["ts", "callsign", "measure"], "val", database, order="val")
    return listing.expected_files(expected, listing.list_files(spark, folder), ["callsign"])


def load_elec(spark: SparkSession, paths: list[str], table: str = "elec", database: str = "default", drop: bool = False) -> list[str]:
    """JSON-lines chunks to one table of text columns that grows by the fields a load brings; returns the columns added.

    Rows of earlier loads have NULL in later columns. A repeated load adds nothing; `drop` starts anew.
    """
    if drop:
        warehouse.drop_tables(spark, [table], database, execute=True)
    return warehouse.append_growing(elec.read_elec(spark, paths), table, database, new_only=True)
