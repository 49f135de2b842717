"""Joins, calendars and pivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark import fixtures as fx
from gridspark import vocab
from gridspark.catalog.base import query, r, rounded
from gridspark.catalog.source_queries import parsed_docs
from gridspark.functions import text, timefn
from gridspark.operators import align, grid
from gridspark.plans import matrix
from gridspark.sources import series_json, weather

SOURCES = [f"S{i}" for i in range(10)]


def eba_star(spark, sf):
    """The hourly fact with ids and its two dimensions."""
    rows = fx.long(spark, sf)
    sources = grid.dense_ids(rows.select(F.col("source").alias("abbr")).distinct(), "abbr").withColumn(
        "full_name", F.concat(F.lit("Region "), F.substring("abbr", 2, 9)))
    tag = fx.pick({k: v[1] for k, v in fx.TAGS.items()}, "measure")
    measures = vocab.measure_dim(spark)
    fact = (rows.withColumn("tag", tag)
            .join(sources.select(F.col("abbr").alias("source"), F.col("id").alias("source_id")), "source")
            .join(measures.select(F.col("abbr").alias("tag"), F.col("id").alias("measure_id")), "tag")
            .select("ts", "source_id", "measure_id", "val"))
    return fact, sources, measures


@query("star_eba", """SELECT ts, source AS abbr, val FROM fx_long WHERE measure = 'purchase'
    AND ts > TIMESTAMP '2024-01-03' AND ts <= TIMESTAMP '2024-01-17' ORDER BY abbr, ts""", ("fx_long",))
def star_eba(spark, sf):
    fact, sources, measures = eba_star(spark, sf)
    rows = fact.where(timefn.half_open("ts", "2024-01-03", "2024-01-17"))
    out = align.star(rows, (measures.where("full_name = 'Demand'"), "measure_id", {}),
                     (sources, "source_id", {"abbr": "abbr", "full_name": "full_name"}))
    return out.orderBy("full_name", "ts").select("ts", "abbr", "val")


@query("star_isd", """SELECT ts, w.callsign, s.state, CAST(temp AS DOUBLE) AS val FROM fx_weather w
    JOIN fx_station s ON s.callsign = w.callsign WHERE temp <> -9999 AND ts > TIMESTAMP '2024-01-03'
    AND ts <= TIMESTAMP '2024-01-17' ORDER BY callsign, ts""", ("fx_weather", "fx_station"))
def star_isd(spark, sf):
    stations = fx.station(spark, sf)
    measures = vocab.isd_measure_dim(spark)
    wide = fx.weather(spark, sf).withColumn("temp", F.nullif("temp", F.lit(-9999)))
    fact = (weather.to_long(wide, ["temp", "wind_spd"])
            .join(stations.select("callsign", F.col("id").alias("callsign_id")), "callsign")
            .join(measures.withColumnRenamed("id", "measure_id"), "measure")
            .select("ts", "callsign_id", "measure_id", "val"))
    rows = fact.where(timefn.half_open("ts", "2024-01-03", "2024-01-17") & F.col("val").isNotNull())
    out = align.star(rows, (measures.where("measure = 'temp'"), "measure_id", {}),
                     (stations, "callsign_id", {"callsign": "callsign", "state": "state"}))
    return out.orderBy("callsign", "ts").select("ts", "callsign", "state", "val")


@query("join_dedup_first", """SELECT n_name AS "CALL", r_name AS "City", CAST(min(s_suppkey + 700000) AS VARCHAR) AS "USAF",
    lpad(CAST(min_by(s_suppkey * 7 % 100000, s_suppkey) AS VARCHAR), 5, '0') AS "WBAN" FROM nation JOIN region ON r_regionkey = n_regionkey
    JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL""")
def join_dedup_first(spark, sf):
    nat = fx.table(spark, sf, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    air = nat.join(fx.table(spark, sf, "region"), "r_regionkey").select(F.col("n_name").alias("CALL"),
                                                                       F.col("r_name").alias("City"))
    s = fx.table(spark, sf, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    history = s.join(nat, "n_nationkey").select(
        F.col("n_name").alias("CALL"), (F.col("s_suppkey") + 700000).cast("string").alias("USAF"),
        F.lpad((F.col("s_suppkey") * 7 % 100000).cast("string"), 5, "0").alias("WBAN"), "s_suppkey")
    return weather.merge_stations(air, history, ["s_suppkey"]).select("CALL", "City", "USAF", "WBAN")


@query("demand_weather", """SELECT d.ts, d.val, w.* EXCLUDE (ts) FROM fx_hourly d LEFT JOIN (
    SELECT ts, max(temp) FILTER (callsign = 'K1') AS temp_k1, max(temp) FILTER (callsign = 'K2') AS temp_k2,
    max(temp) FILTER (callsign = 'K3') AS temp_k3 FROM fx_weather GROUP BY ts) w ON w.ts = d.ts WHERE series = 'purchase'""",
       ("fx_hourly", "fx_weather"))
def demand_weather(spark, sf):
    demand = fx.hourly(spark, sf).where("series = 'purchase'").select("ts", "val")
    cols = {f"temp_k{i}": F.col("callsign") == f"K{i}" for i in (1, 2, 3)}
    return align.demand_weather(demand, fx.weather(spark, sf), cols)


_PIVOT = ", ".join(f"max(val) FILTER (source = '{s}') AS \"{s}\"" for s in SOURCES)


@query("outer_align", f"SELECT ts, {_PIVOT} FROM fx_long WHERE measure = 'click' GROUP BY ts", ("fx_long",))
def outer_align(spark, sf):
    rows = align.drop_empty_series(fx.long(spark, sf).where("measure = 'click'"), ["source"], "val")
    return align.outer_align(rows, "ts", "source", "val", SOURCES)


@query("pivot_mean", f"""SELECT ts, {_PIVOT} FROM fx_long WHERE measure = 'purchase' AND ts > TIMESTAMP '2024-01-02'
    AND ts <= TIMESTAMP '2024-01-28' GROUP BY ts""", ("fx_long",))
def pivot_mean(spark, sf):
    fact, sources, measures = eba_star(spark, sf)
    return matrix.measure_record(fact, sources, measures, "Demand", "2024-01-02", "2024-01-28", SOURCES)


@query("calendar_fill", "SELECT series, ts, CAST(slot AS BIGINT) AS slot, val FROM fx_cal", ("fx_cal",))
def calendar_fill(spark, sf):
    return fx.calendar(spark, sf).select("series", "ts", "slot", "val")


@query("calendar_fill_null_key", """SELECT CAST(NULL AS VARCHAR) AS series, ts, CAST(NULL AS BIGINT) AS slot, val, 'key' AS reason FROM fx_hourly WHERE hour(ts) = 3
    UNION ALL SELECT series, ts, CAST(slot AS BIGINT), val, NULL FROM (SELECT c.series, c.ts, c.slot,
    CASE WHEN hour(c.ts) <> 3 THEN c.val END AS val, min(c.ts) FILTER (hour(c.ts) <> 3 AND h.ts IS NOT NULL) OVER (PARTITION BY c.series) AS lo,
    max(c.ts) FILTER (hour(c.ts) <> 3 AND h.ts IS NOT NULL) OVER (PARTITION BY c.series) AS hi
    FROM fx_cal c LEFT JOIN fx_hourly h ON h.series = c.series AND h.ts = c.ts) WHERE ts BETWEEN lo AND hi""", ("fx_cal", "fx_hourly"))
def calendar_fill_null_key(spark, sf):
    """Rows that lost their key are returned as rejects, beside the calendars of the others."""
    rows = fx.hourly(spark, sf).withColumn("series", F.when(F.hour("ts") != 3, F.col("series")))
    rejects = align.calendar_rejects(rows, ["series"]).withColumn("slot", F.lit(None).cast("long"))
    filled = align.calendar_fill(rows, ["series"], ["val"]).withColumn("reason", F.lit(None).cast("string"))
    names = ["series", "ts", "slot", "val", "reason"]
    return filled.select(*names).unionByName(rejects.select(*names))


@query("calendar_fill_daily", """SELECT c.series, c.ts, d.val FROM (SELECT series,
    unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS ts FROM fx_daily GROUP BY series) c
    LEFT JOIN fx_daily d ON d.series = c.series AND d.ts = c.ts""", ("fx_daily",))
def calendar_fill_daily(spark, sf):
    return align.calendar_fill(fx.daily(spark, sf), ["series"], ["val"], step=timefn.DAY).select("series", "ts", "val")


@query("dim_enrich", """SELECT 'dim' AS what, CAST(2 + row_number() OVER (ORDER BY md5(abbr)[1:2], abbr) AS INTEGER) AS id, full_name, abbr
    FROM (SELECT DISTINCT source AS abbr, concat('Region ', source[2:]) AS full_name FROM fx_docs)
    UNION ALL SELECT 'dim', 1, 'Canada (region)', 'CAN' UNION ALL SELECT 'dim', 2, 'Mexico (region)', 'MEX'
    UNION ALL SELECT 'unknown', NULL, NULL, n_name FROM nation""", ("fx_docs",))
def dim_enrich(spark, sf):
    docs = fx.docs(spark, sf)
    wanted = docs.select(text.series_id_parts("series_id")["source"].alias("abbr")).unionByName(
        fx.table(spark, sf, "nation").select(F.col("n_name").alias("abbr")))
    dim = vocab.extra_region_dim(spark)
    pairs = docs.select("name").distinct().select(F.explode(text.name_abbr_pairs("name")).alias("p")).select("p.*")
    out, unknown = align.dim_enrich(wanted, dim, pairs)
    return out.select(F.lit("dim").alias("what"), "id", "full_name", "abbr").unionByName(
        unknown.select(F.lit("unknown").alias("what"), F.lit(None).cast("int").alias("id"),
                       F.lit(None).cast("string").alias("full_name"), "abbr"))


@query("reconcile_keys", """SELECT n_name AS abbr, 'right' AS side FROM nation UNION ALL
    SELECT DISTINCT source, 'left' FROM fx_docs WHERE source NOT IN (SELECT category_id FROM fx_cats)
    UNION ALL SELECT category_id, 'right' FROM fx_cats WHERE category_id NOT IN (SELECT source FROM fx_docs)
    AND category_id[1] = 'S'""", ("fx_docs", "fx_cats"))
def reconcile_keys(spark, sf):
    used = fx.docs(spark, sf).select(text.series_id_parts("series_id")["source"].alias("abbr"))
    known = series_json.category_names(parsed_docs(spark, sf, categories=True), F.col("category_id")).select("abbr")
    names = fx.table(spark, sf, "nation").select(F.col("n_name").alias("abbr"))
    return align.reconcile_keys(used, known.unionByName(names), "abbr")


@query("input_target_windows", f"""SELECT CASE WHEN ts <= TIMESTAMP '2024-01-20' THEN 'input' ELSE 'target' END AS part, source, ts,
    avg(val) FILTER (measure = 'purchase') AS dem, avg(val) FILTER (measure = 'click') AS dem_fore,
    avg(val) FILTER (measure = 'error') AS temp
    FROM fx_long WHERE ts > TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-25'
    AND measure IN ('purchase', 'click', 'error') GROUP BY ALL""", ("fx_long",))
def input_target_windows(spark, sf):
    return align.input_target_windows(fx.long(spark, sf), "2024-01-05", "2024-01-20", "2024-01-25",
                                      {"purchase": "dem", "click": "dem_fore", "error": "temp"}, ["source"])


@query("flow_balance", f"""SELECT ts, least(source, dest) AS a, greatest(source, dest) AS b,
    {r('sum(val) FILTER (source <= dest)', 'forward', 4)}, {r('sum(val) FILTER (source > dest)', 'back', 4)},
    {r('coalesce(sum(val) FILTER (source <= dest), 0) + coalesce(sum(val) FILTER (source > dest), 0)', 'imbalance', 4)}
    FROM fx_flow WHERE source <> dest GROUP BY ALL""", ("fx_flow",))
def flow_balance(spark, sf):
    return rounded(align.flow_balance(fx.flow(spark, sf)), "forward", "back", "imbalance", places=4)
