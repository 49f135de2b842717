"""Column functions over derived text and values."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark import fixtures as fx
from gridspark import vocab
from gridspark.catalog.base import query, r, rounded
from gridspark.catalog.source_queries import parsed_docs
from gridspark.functions import numeric, text, timefn
from gridspark.operators import select, stats
from gridspark.sources import elec, series_json, weather


@query("parse_series_id", """SELECT series_id, source, CASE WHEN measure = 'error' THEN nxt ELSE 'ALL' END AS dest, tag,
    CASE WHEN is_local THEN 'HL' ELSE 'H' END AS time_code, count(*) AS n FROM fx_docs GROUP BY ALL
    UNION ALL SELECT concat('EBA.', n_name, '.D.H'), NULL, NULL, NULL, NULL, 1 FROM nation""", ("fx_docs",))
def parse_series_id(spark, sf):
    bad = fx.table(spark, sf, "nation").select(F.concat(F.lit("EBA."), "n_name", F.lit(".D.H")).alias("series_id"))
    ids = fx.docs(spark, sf).select("series_id").unionByName(bad)
    counted = ids.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("p", text.series_id_parts("series_id")).select("series_id", "p.*", "n")


@query("parse_hour", """SELECT strftime(ts, '%Y%m%dT%HZ') AS t, date_trunc('hour', ts) AS ts, count(*) AS n
    FROM events GROUP BY ALL""")
def parse_hour(spark, sf):
    rows = fx.table(spark, sf, "events").groupBy(timefn.format_hour("ts").alias("t")).agg(F.count(F.lit(1)).alias("n"))
    return rows.select("t", timefn.parse_hour("t").cast("timestamp_ntz").alias("ts"), "n")


@query("parse_hour_offset", """SELECT concat(strftime(ts, '%Y%m%dT%H'), '-08') AS t,
    date_trunc('hour', ts) + INTERVAL 8 HOUR AS ts, count(*) AS n FROM events GROUP BY ALL""")
def parse_hour_offset(spark, sf):
    t = F.concat(F.date_format("ts", "yyyyMMdd'T'HH"), F.lit("-08"))
    rows = fx.table(spark, sf, "events").groupBy(t.alias("t")).agg(F.count(F.lit(1)).alias("n"))
    return rows.select("t", timefn.parse_hour("t").cast("timestamp_ntz").alias("ts"), "n")


@query("name_abbr", """SELECT abbr, full_name, count(*) AS n FROM (
    SELECT source AS abbr, concat('Region ', source[2:]) AS full_name FROM fx_docs UNION ALL
    SELECT nxt, concat('Region ', nxt[2:]) FROM fx_docs WHERE measure = 'error') GROUP BY ALL""", ("fx_docs",))
def name_abbr(spark, sf):
    pairs = fx.docs(spark, sf).select(F.explode(text.name_abbr_pairs("name")).alias("p")).select("p.abbr", "p.full_name")
    return pairs.groupBy("abbr", "full_name").agg(F.count(F.lit(1)).alias("n"))


@query("meta_names", """SELECT category_id AS abbr, concat('Region ', category_id[2:], ' Power Inc') AS full_name
    FROM fx_cats WHERE category_id[1] = 'S'""", ("fx_cats",))
def meta_names(spark, sf):
    return series_json.category_names(parsed_docs(spark, sf, categories=True), F.col("category_id"))


@query("zero_to_null", "SELECT series, ts, nullif(val, 0) AS val FROM fx_dirty", ("fx_dirty",))
def zero_to_null(spark, sf):
    return fx.dirty(spark, sf).select("series", "ts", numeric.zero_to_null("val").alias("val"))


@query("name_levels", """SELECT trim(split_part(name, ':', 1)) AS l0, trim(split_part(name, ':', 2)) AS l1,
    trim(split_part(name, ':', 3)) AS l2, trim(split_part(name, ':', 4)) AS l3, NULL::VARCHAR AS l4, count(*) AS n
    FROM fx_monthly GROUP BY ALL""", ("fx_monthly",))
def name_levels(spark, sf):
    levels = [text.name_level("name", i).alias(f"l{i}") for i in range(5)]
    return fx.monthly(spark, sf).groupBy(*levels).agg(F.count(F.lit(1)).alias("n"))


@query("gen_label", """SELECT name, trim(regexp_extract(name, 'Net generation : ([\\s\\w\\(\\)-]+):', 1)) AS label
    FROM fx_monthly GROUP BY ALL UNION ALL SELECT n_name, NULL FROM nation""", ("fx_monthly",))
def gen_label(spark, sf):
    names = fx.monthly(spark, sf).select("name").distinct().unionByName(
        fx.table(spark, sf, "nation").select(F.col("n_name").alias("name")))
    return names.select("name", text.generation_label("name").alias("label"))


def elec_docs(spark, sf):
    """Monthly, quarterly and annual series as one text row each: name, f, data as JSON text."""
    m = fx.monthly(spark, sf)
    year, month = F.substring("period", 1, 4), F.substring("period", 5, 2).cast("int")
    by_quarter = F.concat(year, F.lit("Q"), F.ceil(month / 3).cast("string"))
    parts = [m.select("name", "f", "period", "val")]
    for f, period in (("Q", by_quarter), ("A", year)):
        parts.append(m.groupBy("name", F.lit(f).alias("f"), period.alias("period")).agg(F.sum("val").alias("val")))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    # bounded by the periods of one series, about a hundred
    data = F.sort_array(F.collect_list(F.struct("period", F.col("val").cast("string").alias("v"))))
    packed = rows.groupBy("name", "f").agg(data.alias("d"))
    return packed.select("name", "f", F.to_json(F.transform("d", lambda x: F.array(x["period"], x["v"]))).alias("data"))


_PERIODS = """SELECT name, 'M' AS f, CAST(strptime(concat(period, '01'), '%Y%m%d') AS DATE) AS obs_date, val AS obs_val
    FROM fx_monthly UNION ALL
    SELECT name, 'Q', CAST(date_trunc('quarter', strptime(concat(period, '01'), '%Y%m%d')) AS DATE) AS d, sum(val)
    FROM fx_monthly GROUP BY name, d UNION ALL
    SELECT name, 'A', make_date(CAST(period[1:4] AS INTEGER), 1, 1) AS d, sum(val) FROM fx_monthly GROUP BY name, d"""


@query("period_explode", _PERIODS, ("fx_monthly",))
def period_explode(spark, sf):
    return elec.period_explode(elec_docs(spark, sf), ["name"])


@query("strip_quotes", """SELECT doc_id, md5(replace(replace(text, '''', ''), '"', '')) AS digest,
    CAST(length(replace(replace(text, '''', ''), '"', '')) AS INTEGER) AS n_chars FROM documents""")
def strip_quotes(spark, sf):
    clean = text.strip_quotes("text")
    return fx.table(spark, sf, "documents").select("doc_id", F.md5(clean).alias("digest"),
                                                   F.length(clean).alias("n_chars"))


@query("sinc", f"SELECT event_id, {r('CASE WHEN abs(value - 1) > 1e-16 THEN sin(value - 1) / (value - 1) ELSE 1 END', 'v')} FROM events")
def sinc(spark, sf):
    return rounded(fx.table(spark, sf, "events").select("event_id", numeric.sinc(F.col("value") - 1).alias("v")), "v")


@query("forecast_days", f"""SELECT DISTINCT o_orderdate AS day, CASE WHEN o_orderdate + INTERVAL 20 YEAR >= DATE '{vocab.FORECAST_START}'
    THEN o_orderdate + INTERVAL 20 YEAR <= DATE '2020-06-30' END AS there FROM orders""")
def forecast_days(spark, sf):
    """Whether a forecast file may exist for a day: unknown before the archive, not for the future."""
    days = fx.table(spark, sf, "orders").select(F.col("o_orderdate").alias("day")).distinct()
    later = F.expr("cast(day + INTERVAL 20 YEARS AS date)")
    return days.select("day", text.forecast_day_state(later, F.lit("2020-06-30").cast("date")).alias("there"))


@query("to_local_changes", """SELECT event_id, ts + INTERVAL 50 DAY - to_hours(CASE WHEN ts + INTERVAL 50 DAY >= TIMESTAMP '2024-03-10 10:00:00'
        THEN 7 ELSE 8 END) AS spring, ts + INTERVAL 290 DAY - to_hours(CASE WHEN ts + INTERVAL 290 DAY < TIMESTAMP '2024-11-03 09:00:00'
        THEN 7 ELSE 8 END) AS autumn FROM events""")
def to_local_changes(spark, sf):
    """Wall clock in weeks in which clocks change."""
    return fx.table(spark, sf, "events").select("event_id", *[timefn.to_local(F.expr(f"ts + INTERVAL {days} DAY")).alias(name)
                                                              for name, days in (("spring", 50), ("autumn", 290))])


@query("to_local", "SELECT event_id, ts - INTERVAL 8 HOUR AS local_ts FROM events")
def to_local(spark, sf):
    return fx.table(spark, sf, "events").select("event_id", timefn.to_local("ts").alias("local_ts"))


@query("calendar_features", f"""SELECT ts, {r('hour(ts) / 23.0', 'hour_frac')}, {r('(isodow(ts) - 1) / 6.0', 'week_frac')},
    {r("dayofyear(ts) / (364.0 + CASE WHEN year(ts) % 4 = 0 AND (year(ts) % 100 <> 0 OR year(ts) % 400 = 0) THEN 1 ELSE 0 END)", 'year_frac')},
    n FROM (SELECT ts, count(*) AS n FROM fx_hourly GROUP BY ts UNION ALL
            SELECT o_orderdate, count(*) FROM orders GROUP BY o_orderdate)""", ("fx_hourly",))
def calendar_features(spark, sf):
    a = fx.hourly(spark, sf).groupBy("ts").agg(F.count(F.lit(1)).alias("n"))
    b = fx.table(spark, sf, "orders").groupBy(F.col("o_orderdate").alias("ts")).agg(F.count(F.lit(1)).alias("n"))
    rows = a.unionByName(b).withColumns(timefn.calendar_features("ts"))
    return rounded(rows, "hour_frac", "week_frac", "year_frac")


@query("weekday_hour", """SELECT isodow(ts) >= 6 AS weekend, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n
    FROM events GROUP BY ALL""")
def weekday_hour(spark, sf):
    return fx.table(spark, sf, "events").groupBy(timefn.is_weekend("ts").alias("weekend"), F.hour("ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"))


@query("temp_shift", f"""SELECT ts, callsign, {r('32 + temp * 9 / 50.0', 'fahrenheit')},
    150.0::DOUBLE + abs(temp - 150) AS shifted FROM fx_weather WHERE temp > -900""", ("fx_weather",))
def temp_shift(spark, sf):
    rows = fx.weather(spark, sf).withColumn("temp", numeric.missing_to_null("temp")).where("temp is not null")
    out = rows.select("ts", "callsign", numeric.fahrenheit("temp").alias("fahrenheit"),
                      numeric.temp_shift("temp").alias("shifted"))
    return rounded(out, "fahrenheit")


def _values(mapping: dict[str, str]) -> str:
    return ", ".join(f"('{k}', '{v}')" for k, v in mapping.items())


@query("region_map", f"""SELECT callsign, concat(city, ', ', s.state) AS city_state, region FROM fx_station s
    LEFT JOIN (VALUES {_values(vocab.STATE_REGION)}) r(state, region) ON r.state = s.state""", ("fx_station",))
def region_map(spark, sf):
    return weather.region_map(fx.station(spark, sf)).select("callsign", "city_state", "region")


@query("measure_dim", f"""WITH d(abbr, full_name) AS (VALUES {_values(vocab.measure_names())})
    SELECT d.abbr, d.full_name, p.abbr AS back, n FROM (SELECT tag, count(*) AS n FROM fx_pts GROUP BY tag) t
    JOIN d ON d.abbr = t.tag JOIN d p ON p.full_name = d.full_name""", ("fx_pts",))
def measure_dim(spark, sf):
    tags = fx.long(spark, sf).groupBy(fx.pick({k: v[1] for k, v in fx.TAGS.items()}, "measure").alias("abbr")).agg(
        F.count(F.lit(1)).alias("n"))
    dim = vocab.measure_dim(spark)
    named = tags.join(dim.select("abbr", "full_name"), "abbr")
    return named.join(dim.select("full_name", F.col("abbr").alias("back")), "full_name").select(
        "abbr", "full_name", "back", "n")


@query("scale_by_max", f"""SELECT series, ts, {r('val / max(val) OVER (PARTITION BY series)', 'scaled')} FROM fx_hourly""",
       ("fx_hourly",))
def scale_by_max(spark, sf):
    rows = fx.hourly(spark, sf).withColumn("slot", timefn.slot_of("ts"))
    return rounded(stats.scale_by_max(rows, ["series"]).select("series", "ts", "scaled"), "scaled")


@query("state_density", f"""SELECT s.callsign, s.state, d.name AS state_name, d.density FROM fx_station s JOIN
    (VALUES {', '.join(f"('{a}', '{n}', {d}::DOUBLE)" for a, (n, d) in vocab.STATES.items())}) d(state, name, density)
    ON d.state = s.state""", ("fx_station",))
def state_density(spark, sf):
    return fx.station(spark, sf).join(vocab.state_dim(spark), "state").select(
        "callsign", "state", "state_name", "density")


@query("state_cities", f"""SELECT c.state, c.city, CAST(c.rank AS INTEGER) AS city_rank, count(*) AS n FROM fx_station s JOIN
    (VALUES {', '.join(f"('{s}', '{c}', {i + 1})" for s, cs in vocab.STATE_CITIES.items() for i, c in enumerate(cs))})
    c(state, city, rank) ON c.state = s.state GROUP BY ALL""", ("fx_station",))
def state_cities(spark, sf):
    per_state = fx.station(spark, sf).groupBy("state").agg(F.count(F.lit(1)).alias("n"))
    return vocab.city_dim(spark).join(per_state, "state").select("state", "city", "city_rank", "n")
