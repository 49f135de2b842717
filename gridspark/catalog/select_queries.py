"""Filters, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark import fixtures as fx
from gridspark import schemas
from gridspark.catalog.base import query, r, rounded
from gridspark.catalog.source_queries import parsed_docs
from gridspark.functions import timefn
from gridspark.operators import select, stats
from gridspark.session import scratch_path
from gridspark.sources import series_json, weather


@query("route_series", """SELECT series_id, name, start, CASE WHEN measure = 'error' THEN 'eba_inter' ELSE 'eba' END AS target
    FROM fx_docs WHERE NOT is_local""", ("fx_docs",))
def route_series(spark, sf):
    return select.route_series(parsed_docs(spark, sf, categories=True)).select("series_id", "name", "start", "target")


@query("time_slice", """SELECT ts, source, val FROM fx_long WHERE measure = 'purchase'
    AND ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'""", ("fx_long",))
def time_slice(spark, sf):
    rows = fx.long(spark, sf)
    return rows.where((F.col("measure") == "purchase") & timefn.half_open("ts", "2024-01-10", "2024-01-20")).select(
        "ts", "source", "val")


@query("multi_like", """SELECT name, period, val FROM fx_monthly WHERE name LIKE '%Net generation%'
    AND name LIKE '%: NATION_1 :%' AND name LIKE '%: all sectors%' AND f LIKE 'M'""", ("fx_monthly",))
def multi_like(spark, sf):
    return select.multi_like(fx.monthly(spark, sf), ["name", "period", "val"],
                             ["Net generation", ": NATION_1 :", ": all sectors"], "M")


@query("project_col", "SELECT o_orderpriority FROM orders")
def project_col(spark, sf):
    return fx.table(spark, sf, "orders").select("o_orderpriority")


@query("series_pattern", """SELECT * FROM fx_hourly WHERE regexp_matches(series, '[Vv]iew|click')""", ("fx_hourly",))
def series_pattern(spark, sf):
    return fx.hourly(spark, sf).where(F.col("series").rlike("[Vv]iew|click"))


@query("keyword_subset", """SELECT DISTINCT name FROM fx_monthly WHERE regexp_matches(name, 'ECONOMY|PROMO')""",
       ("fx_monthly",))
def keyword_subset(spark, sf):
    return fx.monthly(spark, sf).where(F.col("name").rlike("ECONOMY|PROMO")).select("name").distinct()


@query("state_filter", """SELECT callsign, city, state FROM fx_station WHERE state = 'CA' AND city = 'NATION_4'""",
       ("fx_station",))
def state_filter(spark, sf):
    return fx.station(spark, sf).where((F.col("state") == "CA") & (F.col("city") == "NATION_4")).select(
        "callsign", "city", "state")


@query("hour_slice", "SELECT series, ts, val FROM fx_hourly WHERE hour(ts) = 4", ("fx_hourly",))
def hour_slice(spark, sf):
    return select.hour_slice(fx.hourly(spark, sf), 4).select("series", "ts", "val")


@query("month_hour_facets", f"""SELECT CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n,
    {r('avg(val)', 'mean')} FROM fx_hourly GROUP BY ALL""", ("fx_hourly",))
def month_hour_facets(spark, sf):
    out = fx.hourly(spark, sf).groupBy(F.month("ts").alias("month"), F.hour("ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("val").alias("mean"))
    return rounded(out, "mean")


@query("date_slice", """SELECT '1 month' AS what, series, ts, val FROM fx_daily WHERE ts >= '1997-07-01' AND ts < '1997-08-01'
    UNION ALL SELECT '2 span', series, ts, val FROM fx_daily WHERE ts >= '1998-07-01' AND ts < '1999-07-01'
    UNION ALL SELECT '3 days', series, ts, val FROM fx_daily WHERE ts >= '2000-12-20' AND ts < '2001-01-03'
    UNION ALL SELECT '4 year', series, ts, val FROM fx_daily WHERE ts >= '1996-01-01' AND ts < '1997-01-01'""",
       ("fx_daily",))
def date_slice(spark, sf):
    rows = fx.daily(spark, sf)
    spans = {"1 month": ("1997-07", None), "2 span": ("1998-07", "1999-06"), "3 days": ("2000-12-20", "2001-01-02"),
             "4 year": ("1996", None)}
    # one pass: each row carries the spans it falls into
    hits = F.array_compact(F.array(*[F.when(timefn.partial_date_slice("ts", a, b), F.lit(k)) for k, (a, b) in spans.items()]))
    return rows.select(F.explode(hits).alias("what"), "series", "ts", "val")


@query("regex_find", """SELECT series_id, name, count(*) AS n FROM fx_docs WHERE regexp_matches(series_id, 'S3')
    GROUP BY ALL""", ("fx_docs",))
def regex_find(spark, sf):
    found = select.regex_find(parsed_docs(spark, sf), "series_id", "S3", ["series_id", "name"])
    return found.groupBy("series_id", "name").agg(F.count(F.lit(1)).alias("n"))


@query("document_store", """SELECT series_id, name, start, "end", CAST(sum(n_points) AS BIGINT) AS n_points FROM fx_docs
    WHERE regexp_matches(name, 'Region 3 .*UTC') GROUP BY ALL""", ("fx_docs",))
def document_store(spark, sf):
    """Documents stored as they are, then looked up by a pattern."""
    path = scratch_path(spark, "documents")
    series_json.store_documents(parsed_docs(spark, sf), path)
    stored = spark.read.schema(schemas.SERIES_DOC).parquet(path)
    found = select.regex_find(stored, "name", "Region 3 .*UTC", ["series_id", "name", "start", "end", "data"])
    return found.groupBy("series_id", "name", "start", "end").agg(F.sum(F.size("data")).alias("n_points"))


@query("row_slice", "SELECT series, ts, CAST(rn AS BIGINT) AS rn, val FROM fx_cal WHERE rn >= 100 AND rn < 436", ("fx_cal",))
def row_slice(spark, sf):
    return select.row_slice(fx.calendar(spark, sf), ["series"], 100, 436).select("series", "ts", "rn", "val")


@query("top_series", """SELECT name, max(val) AS max_val FROM fx_monthly GROUP BY name ORDER BY max_val DESC, name LIMIT 7""",
       ("fx_monthly",))
def top_series(spark, sf):
    return select.top_series(fx.monthly(spark, sf), "name", F.col("val"), 7)


@query("rank_positions", """SELECT name, max_val, CAST(position AS INTEGER) AS position FROM (SELECT name, max(val) AS max_val,
    row_number() OVER (ORDER BY max(val) DESC, name) - 1 AS position FROM fx_monthly GROUP BY name)
    WHERE position IN (4, 6, 8, 9, 10, 11, 13)""", ("fx_monthly",))
def rank_positions(spark, sf):
    return select.rank_positions(fx.monthly(spark, sf), "name", F.col("val"), [4, 6, 8, 9, 10, 11, 13])


@query("sorted_callsigns", "SELECT callsign, state FROM fx_station ORDER BY state, callsign", ("fx_station",))
def sorted_callsigns(spark, sf):
    return weather.sorted_callsigns(fx.station(spark, sf))


@query("union_stations", """SELECT ts, callsign, CAST(temp AS INTEGER) AS temp, NULL AS city FROM fx_weather
    UNION ALL SELECT NULL, callsign, NULL, city FROM fx_station""", ("fx_weather", "fx_station"))
def union_stations(spark, sf):
    return select.union_frames(fx.weather(spark, sf).select("ts", "callsign", "temp"),
                               fx.station(spark, sf).select("callsign", "city"))


@query("dedup_rows", "SELECT DISTINCT CAST(ts AS DATE) AS day, user_id, event_type FROM events")
def dedup_rows(spark, sf):
    return fx.table(spark, sf, "events").select(F.to_date("ts").alias("day"), "user_id", "event_type").dropDuplicates()


@query("find_dups", """SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1""")
def find_dups(spark, sf):
    from gridspark.operators import quality

    return quality.find_dups(fx.table(spark, sf, "events"), ["user_id", "event_type"])


@query("distinct_levels", """SELECT 'type' AS level, trim(split_part(name, ':', 2)) AS item FROM fx_monthly GROUP BY ALL
    UNION ALL SELECT 'source', source FROM fx_docs GROUP BY ALL UNION ALL SELECT 'tag', tag FROM fx_docs GROUP BY ALL""",
       ("fx_monthly", "fx_docs"))
def distinct_levels(spark, sf):
    from gridspark.functions import text

    types = fx.monthly(spark, sf).select(F.lit("type").alias("level"), text.name_level("name", 1).alias("item"))
    parts = fx.docs(spark, sf).select(text.series_id_parts("series_id").alias("p"))
    items = parts.select(F.explode(F.array(
        F.struct(F.lit("source").alias("level"), F.col("p.source").alias("item")),
        F.struct(F.lit("tag").alias("level"), F.col("p.tag").alias("item")))).alias("x")).select("x.*")
    return types.unionByName(items).distinct()
