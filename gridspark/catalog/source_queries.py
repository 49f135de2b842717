"""Sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridspark import fixtures as fx
from gridspark import vocab
from gridspark.catalog.base import query, rounded
from gridspark.functions import text, timefn
from gridspark.operators import align, upsert
from gridspark.plans import load, matrix
from gridspark.session import materialize
from gridspark.sources import elec, listing, meter, series_json, warehouse, weather


def json_lines(docs):
    """Documents as JSON text lines, as the bulk file holds them."""
    return docs.select(F.to_json(F.struct(*docs.columns)).alias("value"))


def parsed_docs(spark, sf, categories=False):
    docs = fx.docs(spark, sf)
    if categories:
        docs = docs.unionByName(fx.category_docs(spark, sf))
    return series_json.parse_series_lines(json_lines(docs))


@query("series_scan", """SELECT series_id, name, start FROM fx_docs WHERE contains(lower(name), 'net generation')
    ORDER BY series_id, start LIMIT 200""", ("fx_docs",))
def series_scan(spark, sf):
    docs = parsed_docs(spark, sf)
    return series_json.series_scan(docs, "NET Generation", 200, ["series_id", "start"]).select(
        "series_id", "name", "start")


@query("series_explode", """SELECT ts, source, CASE WHEN measure = 'error' THEN nxt ELSE 'ALL' END AS dest,
    tag AS measure, val FROM fx_pts""", ("fx_pts",))
def series_explode(spark, sf):
    rows = series_json.explode_observations(parsed_docs(spark, sf))
    return rows.select(F.col("ts").cast("timestamp_ntz").alias("ts"), "source", "dest", "measure", "val")


@query("meta_lines", "SELECT category_id, name, 1 AS n_children FROM fx_cats", ("fx_cats",))
def meta_lines(spark, sf):
    return series_json.category_lines(parsed_docs(spark, sf, categories=True)).select(
        "category_id", "name", F.size("childseries").alias("n_children"))


@query("series_names", "SELECT name, series_id, count(*) AS n FROM fx_docs GROUP BY ALL", ("fx_docs",))
def series_names(spark, sf):
    named = series_json.name_and_id(parsed_docs(spark, sf, categories=True))
    return named.groupBy("name", "series_id").agg(F.count(F.lit(1)).alias("n"))


def isd_lines(spark, sf):
    w = fx.weather(spark, sf)
    line = F.concat_ws(" ", F.year("ts"), F.date_format("ts", "MM"), F.date_format("ts", "dd"),
                       F.date_format("ts", "HH"), F.lpad(F.col("temp").cast("string"), 6, " "), F.lit("-9999 10132"),
                       F.lit("  270"), F.col("wind_spd").cast("string"), F.lit("8"),
                       F.lpad(F.col("precip_1hr").cast("string"), 6, " "), F.lit("-9999"))
    return w.select("callsign", line.alias("value"))


@query("isd_parse", """SELECT callsign, ts, nullif(temp, -9999) AS temp, NULL::INTEGER AS dew_temp,
    10132 AS pressure, 270 AS wind_dir, wind_spd, 8 AS cloud_cov, nullif(precip_1hr, -9999) AS precip_1hr,
    NULL::INTEGER AS precip_6hr FROM fx_weather""", ("fx_weather",))
def isd_parse(spark, sf):
    return weather.parse_isd_lines(isd_lines(spark, sf), ["callsign"])


@query("isd_long", """SELECT ts, callsign, measure, CAST(nullif(v, -9999) AS DOUBLE) AS val FROM fx_weather,
    LATERAL (VALUES ('temp', temp), ('wind_spd', wind_spd), ('precip_1hr', precip_1hr)) m(measure, v)""",
       ("fx_weather",))
def isd_long(spark, sf):
    return weather.to_long(isd_parse(spark, sf))


def history_lines(spark, sf):
    s = fx.station(spark, sf)
    end = F.when(F.col("id") % 3 == 0, F.lit("20141231")).otherwise(F.lit("20230215"))

    def pad(c, n):
        return F.rpad(c, n, " ")

    line = F.concat(F.col("usaf").cast("string"), F.lit(" "), F.lpad(F.col("wban").cast("string"), 5, "0"), F.lit(" "),
                    pad(F.col("name"), 29), F.lit(" "), pad(F.lit("US"), 4), F.lit(" "), F.col("state"), F.lit(" "),
                    pad(F.col("callsign"), 5), F.lit(" +"), F.lpad((F.col("id") % 90).cast("string"), 2, "0"),
                    F.lit(".250 "), F.lit("-"), F.lpad((F.col("id") % 180).cast("string"), 3, "0"), F.lit(".500 "),
                    F.lit("+0007.0 "), F.lit("19900101 "), end)
    title = fx.table(spark, sf, "region").select(F.concat(F.lit("USAF   WBAN  STATION NAME "), "r_name").alias("value"))
    return title.unionByName(s.select(line.alias("value")))


@query("station_history", """SELECT CAST(usaf AS VARCHAR) AS "USAF", lpad(CAST(wban AS VARCHAR), 5, '0') AS "WBAN",
    substr(callsign, 1, 5) AS "CALL", (id % 90) + 0.25::DOUBLE AS "LAT", -((id % 180) + 0.5::DOUBLE) AS "LON",
    state AS "ST" FROM fx_station WHERE id % 3 <> 0""", ("fx_station",))
def station_history(spark, sf):
    return weather.parse_station_history(history_lines(spark, sf))


def airports(spark, sf):
    s = fx.station(spark, sf)
    kind = F.element_at(F.array(*[F.lit(x) for x in ("small_airport", "medium_airport", "large_airport", "heliport")]),
                        (F.col("id") % 4 + 1).cast("int"))
    return s.select(F.col("callsign").alias("ident"), kind.alias("type"), "name", F.col("city").alias("municipality"),
                    F.when(F.col("continent") == "EUROPE", F.lit("GB")).otherwise(F.lit("US")).alias("iso_country"))


_AIR = """SELECT name, city AS "City", callsign AS "CALL", id FROM fx_station
    WHERE continent <> 'EUROPE' AND id % 4 IN (1, 2)"""


@query("airport_filter", f'SELECT name, "City", "CALL" FROM ({_AIR})', ("fx_station",))
def airport_filter(spark, sf):
    return weather.airport_filter(airports(spark, sf))


@query("airport_codes", """SELECT name AS "Name", city AS "City", callsign AS "CALL", 'US' AS iso_country,
    CASE id % 4 WHEN 1 THEN 'medium_airport' ELSE 'large_airport' END AS type FROM fx_station
    WHERE continent <> 'EUROPE' AND id % 4 IN (1, 2)""", ("fx_station",))
def airport_codes(spark, sf):
    return weather.us_airports(airports(spark, sf)).withColumnRenamed("name", "Name")


@query("meter_scan", """SELECT CAST(user_id AS VARCHAR) AS "ID", upper(strftime(ts, '%d%b%y:%H:%M:%S')) AS
    "LocalDateTime", value AS "kWh" FROM events""")
def meter_scan(spark, sf):
    return meter.parse_meter_lines(meter_lines(spark, sf))


def meter_lines(spark, sf):
    ev = fx.table(spark, sf, "events")
    stamp = F.upper(F.date_format("ts", "ddMMMyy:HH:mm:ss"))
    return ev.select(F.concat_ws(",", F.col("user_id").cast("string"), stamp, F.col("value").cast("string")).alias("value"))


@query("meter_time", """SELECT event_id, date_trunc('second', ts) AS ts FROM events""")
def meter_time(spark, sf):
    ev = fx.table(spark, sf, "events")
    return ev.select("event_id", timefn.meter_time(F.upper(F.date_format("ts", "ddMMMyy:HH:mm:ss"))).alias("ts"))


@query("schema_union", """SELECT p_name AS name, 'M' AS f, CAST(p_size AS VARCHAR) AS size, NULL AS childseries
    FROM part UNION ALL SELECT s_name, NULL, NULL, concat('["', s_suppkey, '"]') FROM supplier""")
def schema_union(spark, sf):
    a = fx.table(spark, sf, "part").select(F.col("p_name").alias("name"), F.lit("M").alias("f"),
                                           F.col("p_size").alias("size"))
    b = fx.table(spark, sf, "supplier").select(F.col("s_name").alias("name"),
                                               F.array(F.col("s_suppkey").cast("string")).alias("childseries"))
    return elec.union_chunks(a, b)


@query("elec_growing", """SELECT p_name AS name, 'M' AS f, CAST(p_size AS VARCHAR) AS size, NULL AS childseries, NULL AS units
    FROM part UNION ALL SELECT s_name, NULL, NULL, concat('["', s_suppkey, '"]'), NULL FROM supplier
    UNION ALL SELECT c_name, 'A', NULL, NULL, c_mktsegment FROM customer""")
def elec_growing(spark, sf):
    """A managed table that three loads with different fields make wider; the middle one is run again and adds nothing."""
    table = f"elec_{uuid.uuid4().hex}"
    part = fx.table(spark, sf, "part").select(F.col("p_name").alias("name"), F.lit("M").alias("f"), F.col("p_size").alias("size"))
    supplier = fx.table(spark, sf, "supplier").select(F.col("s_name").alias("name"),
                                                      F.array(F.col("s_suppkey").cast("string")).alias("childseries"))
    customer = fx.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("units"), F.col("c_name").alias("name"), F.lit("A").alias("f"))
    warehouse.append_growing(elec.as_text(part), table)
    for chunk in (supplier, supplier, customer):
        warehouse.append_growing(elec.as_text(chunk), table, new_only=True)
    out = materialize(spark.table(table), "elec")
    warehouse.drop_tables(spark, [table], execute=True)
    return out


def file_listing(spark, sf):
    """Stand-in for a folder listing: some station-years are absent, some are empty."""
    files = weather.with_file_names(fx.station(spark, sf))
    return files.where((F.col("id") + F.col("year")) % 3 != 0).select(
        "file_name", (F.col("id") * F.col("year") % 5).alias("length"))


@query("expected_files", """SELECT callsign, count(*) AS n_expected,
    count(*) FILTER ((id + year) % 3 <> 0 AND id * year % 5 > 0) AS n_found
    FROM fx_station, (SELECT unnest(generate_series(2015, 2023)) AS year) GROUP BY callsign""", ("fx_station",))
def expected_files(spark, sf):
    return listing.expected_files(weather.with_file_names(fx.station(spark, sf)), file_listing(spark, sf), ["callsign"])


@query("isd_filename", """SELECT callsign, CAST(year AS INTEGER) AS year, concat(usaf, '-', lpad(CAST(wban AS VARCHAR), 5, '0'),
    '-', year, '.gz') AS file_name FROM fx_station, (SELECT unnest(generate_series(2015, 2023)) AS year)""",
       ("fx_station",))
def isd_filename(spark, sf):
    return weather.with_file_names(fx.station(spark, sf)).select("callsign", "year", "file_name")


FORECAST_VARS = {"click": "temp", "view": "wspd", "error": "wdir", "purchase": "sky", "signup": "temp"}


def archive_listing(spark, sf):
    ev = fx.table(spark, sf, "events")
    var = fx.pick(FORECAST_VARS, "event_type")
    code = fx.pick({k: v + vocab.FORECAST_LEVEL for k, v in vocab.FORECAST_PREFIX.items()}, "var")
    keys = ev.select(var.alias("var"), "ts", "event_id", "event_type")
    other = F.when(F.col("event_type") == "signup", F.lit("YHUZ98")).otherwise(code)
    return keys.select(F.concat(text.forecast_dir("var", "ts"), other, F.lit("_KWBN_"), F.date_format("ts", "yyyyMMddHHmm"),
                                F.lit("."), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("key"))


def _picked(agg: str) -> str:
    return f"""SELECT var, CAST(ts AS DATE) AS day, {agg}(concat('wmo/', var, strftime(ts, '/%Y/%m/%d/'), code, 'Z98_KWBN_',
        strftime(ts, '%Y%m%d%H%M'), '.', lpad(CAST(event_id AS VARCHAR), 12, '0'))) AS picked FROM (
        SELECT *, CASE event_type WHEN 'click' THEN 'temp' WHEN 'view' THEN 'wspd' WHEN 'error' THEN 'wdir' ELSE 'sky' END AS var,
        CASE event_type WHEN 'click' THEN 'YEU' WHEN 'view' THEN 'YCU' WHEN 'error' THEN 'YBU' ELSE 'YAU' END AS code
        FROM events WHERE event_type <> 'signup') GROUP BY ALL"""


@query("first_key_per_day", _picked("min"))
def first_key_per_day(spark, sf):
    return listing.first_key_per_day(archive_listing(spark, sf))


@query("newest_key_per_day", _picked("max"))
def newest_key_per_day(spark, sf):
    return listing.first_key_per_day(archive_listing(spark, sf), use_newest=True)


@query("record_json", """SELECT part, source, day, json_object('t', list(strftime(ts, '%Y-%m-%d %H:%M:%S') ORDER BY ts),
        'dem', list(dem ORDER BY ts), 'dem_fore', list(dem_fore ORDER BY ts))::VARCHAR AS record FROM (
    SELECT CASE WHEN ts <= TIMESTAMP '2024-01-20' THEN 'input' ELSE 'target' END AS part, source, ts,
        CAST(ts AS DATE) AS day, avg(val) FILTER (measure = 'purchase') AS dem, avg(val) FILTER (measure = 'click') AS dem_fore
    FROM fx_long WHERE ts > TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-25' AND measure IN ('purchase', 'click')
    GROUP BY ALL) GROUP BY ALL""", ("fx_long",))
def record_json(spark, sf):
    return matrix.window_records(fx.long(spark, sf), ["source"], "2024-01-05", "2024-01-20", "2024-01-25",
                                 {"purchase": "dem", "click": "dem_fore"})


@query("upsert_last_wins", f"""WITH old AS (SELECT ts + INTERVAL 1 DAY AS ts, source, measure, val FROM fx_long),
    upd AS (SELECT date_trunc('hour', ts) AS ts, concat('S', user_id % 10) AS source, event_type AS measure,
        max_by(value, event_id) AS val FROM events GROUP BY ALL)
    SELECT coalesce(u.ts, o.ts) AS ts, coalesce(u.source, o.source) AS source, coalesce(u.measure, o.measure) AS measure,
        CASE WHEN u.ts IS NULL THEN o.val ELSE u.val END AS val
    FROM old o FULL JOIN upd u ON o.ts = u.ts AND o.source = u.source AND o.measure = u.measure""", ("fx_long",))
def upsert_last_wins(spark, sf):
    old = fx.long(spark, sf).withColumn("ts", F.timestamp_add("DAY", F.lit(1), F.col("ts")))
    new = fx.table(spark, sf, "events").select(
        fx.hour_of().alias("ts"), F.concat(F.lit("S"), F.col("user_id") % 10).alias("source"),
        F.col("event_type").alias("measure"), F.col("value").alias("val"), "event_id")
    return upsert.upsert(old, new, ["ts", "source", "measure"], "val", "event_id")


@query("series_count", """SELECT count(*) AS n_docs, count(DISTINCT series_id) AS n_series,
    CAST(sum(n_points) AS BIGINT) AS n_points FROM fx_docs""", ("fx_docs",))
def series_count(spark, sf):
    return parsed_docs(spark, sf).agg(F.count(F.lit(1)).alias("n_docs"), F.countDistinct("series_id").alias("n_series"),
                                      F.sum(F.size("data")).alias("n_points"))


_IDS = """ids AS (SELECT abbr, row_number() OVER (ORDER BY md5(abbr)[1:2], abbr) AS id FROM (
    SELECT category_id AS abbr FROM fx_cats WHERE category_id[1] = 'S' UNION SELECT 'CAN' UNION SELECT 'MEX'))"""


def _measure_ids() -> str:
    rows = ", ".join(f"('{a}', {i})" for i, a in enumerate(vocab.measure_names(), start=1))
    return f"mids(tag, id) AS (VALUES {rows})"


@query("eba_load", f"""WITH {_IDS}, {_measure_ids()}
    SELECT 'eba' AS target, ts, CAST(i.id AS INTEGER) AS source_id, CAST(m.id AS INTEGER) AS other_id, val
    FROM fx_pts p JOIN ids i ON i.abbr = p.source JOIN mids m ON m.tag = p.tag
    WHERE NOT is_local AND measure <> 'error'
    UNION ALL SELECT 'eba_inter', ts, CAST(i.id AS INTEGER), CAST(d.id AS INTEGER), val
    FROM fx_pts p JOIN ids i ON i.abbr = p.source JOIN ids d ON d.abbr = p.nxt
    WHERE NOT is_local AND measure = 'error'""", ("fx_pts", "fx_cats"))
def eba_load(spark, sf):
    out = load.eba_with_ids(parsed_docs(spark, sf, categories=True))
    ts = F.col("ts").cast("timestamp_ntz").alias("ts")
    a = out["eba"].select(F.lit("eba").alias("target"), ts, "source_id", F.col("measure_id").alias("other_id"), "val")
    b = out["eba_inter"].select(F.lit("eba_inter").alias("target"), ts, "source_id", F.col("dest_id").alias("other_id"),
                                "val")
    return a.unionByName(b)
