"""Views that give the operators grid-like inputs derived from the given tables.

Each view exists twice with one definition: as a DataFrame here and as DuckDB text in `VIEW_SQL`.
Money and values are summed as whole cents so that both engines get the same doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions import timefn
from gridspark.operators import align, grid

# event type -> (series tag, stored tag, title)
TAGS = {
    "purchase": ("D", "D", "Demand"),
    "click": ("DF", "DF", "Day-ahead demand forecast"),
    "view": ("NG", "NG", "Net generation"),
    "signup": ("NG.COL", "NG-COL", "Net generation from coal"),
    "error": ("ID", "ID", "Actual Net Interchange"),
}
# two-letter states given to nations 0..24
NATION_STATES = ["AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS",
                 "KY", "LA", "ME", "MD", "MA", "OR", "TX", "VT", "WA"]
HOUR_KEYS = ["series"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def cents(col: str) -> Column:
    return F.round(F.col(col) * 100).cast("long")


def cents_sum(col: str) -> Column:
    return F.sum(cents(col)) / F.lit(100)


def hour_of(ts: str = "ts") -> Column:
    return timefn.slot_ts(timefn.slot_of(ts), timefn.HOUR)


def pick(mapping: dict[str, str], key: str) -> Column:
    """Value of a fixed mapping as a CASE expression."""
    out = F.lit(None).cast("string")
    for k, v in mapping.items():
        out = F.when(F.col(key) == k, F.lit(v)).otherwise(out)
    return out


def long(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.groupBy(hour_of().alias("ts"), F.concat(F.lit("S"), F.col("user_id") % 10).alias("source"),
                      F.col("event_type").alias("measure")).agg(cents_sum("value").alias("val"))


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.groupBy(hour_of().alias("ts"), F.col("event_type").alias("series")).agg(cents_sum("value").alias("val"))


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    return align.calendar_fill(hourly(spark, sf), ["series"], ["val"])


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    """The hourly calendar with zeros, spikes and holes put in."""
    raw = hourly(spark, sf)
    spans = grid.series_stats(grid.with_slot(raw), ["series"])
    rn = F.col("slot") - F.col("lo")
    val = (F.when(rn % 97 == 0, F.lit(0.0)).when(rn % 113 == 0, F.col("val") * 100)
           .when(rn % 53 == 0, F.lit(None).cast("double")).otherwise(F.col("val")))
    rows = align.calendar_fill(raw, ["series"], ["val"])
    return grid.attach(rows, spans, ["series"]).select("series", grid.chunk_col(), "slot", "ts", val.alias("val"))


def daily(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.groupBy(F.col("o_orderdate").alias("ts"), F.col("o_orderpriority").alias("series")).agg(
        cents_sum("o_totalprice").alias("val"))


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Generation-like names by month: (name, f, period, val)."""
    li, part, sup, nat = (table(spark, sf, t) for t in ("lineitem", "part", "supplier", "nation"))
    rows = (li.select("l_partkey", "l_suppkey", "l_shipdate", "l_quantity")
            .join(part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
            .join(sup.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey")),
                  "l_suppkey")
            .join(nat.select("n_nationkey", "n_name"), "n_nationkey"))
    name = F.concat(F.lit("Net generation : "), "p_type", F.lit(" : "), "n_name", F.lit(" : all sectors"))
    return (rows.groupBy("p_type", "n_name", F.date_format("l_shipdate", "yyyyMM").alias("period"))
            .agg(F.sum(F.col("l_quantity").cast("long")).cast("double").alias("val"))
            .select(name.alias("name"), F.lit("M").alias("f"), "period", "val"))


def flow(spark: SparkSession, sf: str) -> DataFrame:
    li, o, c, s = (table(spark, sf, t) for t in ("lineitem", "orders", "customer", "supplier"))
    rows = (li.select("l_orderkey", "l_suppkey", "l_shipdate", "l_extendedprice")
            .join(o.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey")), "l_orderkey")
            .join(c.select("c_custkey", "c_nationkey"), "c_custkey")
            .join(s.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey"))
    return rows.groupBy(F.col("l_shipdate").alias("ts"), F.col("s_nationkey").alias("source"),
                        F.col("c_nationkey").alias("dest")).agg(cents_sum("l_extendedprice").alias("val"))


def station(spark: SparkSession, sf: str) -> DataFrame:
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    state = F.element_at(F.array(*[F.lit(x) for x in NATION_STATES]), F.col("n_nationkey") + 1)
    return (s.join(n.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey")
            .join(r.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
            .withColumn("n_nationkey", F.col("s_nationkey"))
            .select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("n_name").alias("city"),
                    state.alias("state"), F.concat(F.lit("K"), "s_suppkey").alias("callsign"),
                    (F.col("s_suppkey") + 700000).cast("int").alias("usaf"),
                    (F.col("s_suppkey") * 7 % 100000).cast("int").alias("wban"),
                    F.col("r_name").alias("continent")))


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly weather-like integers per callsign; -9999 every 20th hour of the calendar."""
    ev = table(spark, sf, "events")
    slot = timefn.slot_of("ts")
    rows = ev.groupBy(slot.alias("slot"), F.concat(F.lit("K"), F.col("user_id") % 10).alias("callsign")).agg(
        F.sum(cents("value")).alias("c"), F.count(F.lit(1)).alias("n"))
    temp = F.floor(F.col("c") / (F.col("n") * 10)).cast("int") - 100
    return rows.select(
        timefn.slot_ts("slot").alias("ts"), "callsign",
        F.when(F.col("slot") % 20 == 0, F.lit(-9999)).otherwise(temp).alias("temp"),
        F.col("n").cast("int").alias("wind_spd"),
        F.when(F.col("n") > 1, (F.col("c") % 7).cast("int")).otherwise(F.lit(-9999)).alias("precip_1hr"))


def joint(spark: SparkSession, sf: str) -> DataFrame:
    """Hole-free hourly frame: series, slot, ts, val (demand), temp (tenths), fore."""
    cal = align.calendar_fill(hourly(spark, sf), ["series"], ["val"], common=True)
    temps = (weather(spark, sf).groupBy("ts").agg(F.max(F.when(F.col("temp") > -900, F.col("temp"))).alias("t")))
    hour = F.hour("ts")
    rows = cal.join(temps, "ts", "left").select(
        "series", "slot", "ts", F.coalesce("val", 50.0 + hour).alias("val"),
        (F.coalesce("t", F.lit(175)) % 350).cast("int").alias("temp"))
    from gridspark.operators import series
    rows = series.lagged(rows, ["series"], "val", [24], "back")
    fore = 0.7 * F.col("val") + 0.3 * F.coalesce("back24", "val")
    return rows.select("series", "slot", "ts", "val", "temp", fore.alias("fore"))


def docs(spark: SparkSession, sf: str) -> DataFrame:
    """One series document per source, measure and day: series_id, name, start, end, f, data."""
    rows = long(spark, sf).withColumn("day", F.to_date("ts"))
    region = F.substring("source", 2, 9).cast("int")
    nxt = F.concat(F.lit("S"), (region + 1) % 10)
    inter = F.col("measure") == "error"
    local = F.dayofmonth("day") % 5 == 0
    here = F.concat(F.lit(" for Region "), region, F.lit(" ("), "source", F.lit(")"))
    there = F.concat(F.lit(" to Region "), (region + 1) % 10, F.lit(" ("), nxt, F.lit(")"))
    name = F.concat(pick({k: v[2] for k, v in TAGS.items()}, "measure"), here, F.when(inter, there).otherwise(""),
                    F.when(local, F.lit(", Hourly, local time")).otherwise(F.lit(", Hourly, UTC time")))
    series_id = F.concat(F.lit("EBA."), "source", F.lit("-"), F.when(inter, nxt).otherwise("ALL"), F.lit("."),
                         pick({k: v[0] for k, v in TAGS.items()}, "measure"),
                         F.when(local, F.lit(".HL")).otherwise(F.lit(".H")))
    value = F.when(F.hour("ts") != 23, F.col("val").cast("string"))
    # at most 24 pairs per document
    data = F.sort_array(F.collect_list(F.struct(timefn.format_hour("ts").alias("p"), value.alias("v"))))
    packed = rows.groupBy("source", "measure", "day").agg(data.alias("d"))
    return packed.select(
        series_id.alias("series_id"), F.lit(None).cast("string").alias("category_id"), name.alias("name"),
        F.lit("Synthetic").alias("description"), F.element_at("d.p", 1).alias("start"),
        F.element_at("d.p", -1).alias("end"), F.lit("H").alias("f"),
        F.lit(None).cast("array<string>").alias("childseries"),
        F.transform("d", lambda x: F.array(x["p"], x["v"])).alias("data"))


def category_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Category documents: one per source and one per nation (whose lower-case code is not an abbreviation)."""
    src = (table(spark, sf, "events").select((F.col("user_id") % 10).alias("k")).distinct()
           .select(F.concat(F.lit("S"), "k").alias("c"),
                   F.concat(F.lit("Region "), "k", F.lit(" Power, Inc. (S"), "k", F.lit(")")).alias("name")))
    nat = table(spark, sf, "nation").select(
        F.concat(F.lit("n"), "n_nationkey").alias("c"),
        F.concat("n_name", F.lit(" grid (n"), "n_nationkey", F.lit("x)")).alias("name"))
    rows = src.unionByName(nat)
    return rows.select(F.lit(None).cast("string").alias("series_id"), F.col("c").alias("category_id"), "name",
                       *[F.lit(None).cast("string").alias(x) for x in ("description", "start", "end", "f")],
                       F.array("c").alias("childseries"), F.lit(None).cast("array<array<string>>").alias("data"))


def _case(column: str, mapping: dict[str, str]) -> str:
    return "CASE " + column + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


_CENTS = "CAST(round({c} * 100) AS BIGINT)"


def _sum(c: str) -> str:
    return f"CAST(sum({_CENTS.format(c=c)}) AS DOUBLE) / 100"


VIEW_SQL: dict[str, tuple[list[str], str]] = {
    "fx_long": ([], f"""SELECT date_trunc('hour', ts) AS ts, concat('S', user_id % 10) AS source,
        event_type AS measure, {_sum('value')} AS val FROM events GROUP BY ALL"""),
    "fx_hourly": ([], f"""SELECT date_trunc('hour', ts) AS ts, event_type AS series, {_sum('value')} AS val
        FROM events GROUP BY ALL"""),
    "fx_cal": (["fx_hourly"], """SELECT c.series, c.ts, h.val, CAST(epoch(c.ts) / 3600 AS BIGINT) AS slot,
            row_number() OVER (PARTITION BY c.series ORDER BY c.ts) - 1 AS rn,
            count(*) OVER (PARTITION BY c.series) AS n
        FROM (SELECT series, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts
              FROM fx_hourly GROUP BY series) c
        LEFT JOIN fx_hourly h ON h.series = c.series AND h.ts = c.ts"""),
    "fx_common": (["fx_hourly"], """SELECT c.series, c.ts, h.val, CAST(epoch(c.ts) / 3600 AS BIGINT) AS slot,
            row_number() OVER (PARTITION BY c.series ORDER BY c.ts) - 1 AS rn,
            count(*) OVER (PARTITION BY c.series) AS n
        FROM (SELECT s.series, r.ts FROM (SELECT DISTINCT series FROM fx_hourly) s, (
              SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM fx_hourly) r) c
        LEFT JOIN fx_hourly h ON h.series = c.series AND h.ts = c.ts"""),
    "fx_dirty": (["fx_cal"], """SELECT series, ts, slot, rn, n, CASE WHEN rn % 97 = 0 THEN 0.0::DOUBLE
        WHEN rn % 113 = 0 THEN val * 100 WHEN rn % 53 = 0 THEN NULL ELSE val END AS val FROM fx_cal"""),
    "fx_daily": ([], f"""SELECT o_orderdate AS ts, o_orderpriority AS series, {_sum('o_totalprice')} AS val
        FROM orders GROUP BY ALL"""),
    "fx_monthly": ([], """SELECT concat('Net generation : ', p_type, ' : ', n_name, ' : all sectors') AS name,
        'M' AS f, strftime(l_shipdate, '%Y%m') AS period, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS val
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL"""),
    "fx_flow": ([], f"""SELECT l_shipdate AS ts, s_nationkey AS source, c_nationkey AS dest,
        {_sum('l_extendedprice')} AS val FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL"""),
    "fx_station": ([], f"""SELECT s_suppkey AS id, s_name AS name, n_name AS city,
        ({[x for x in NATION_STATES]})[n_nationkey + 1] AS state, concat('K', s_suppkey) AS callsign,
        CAST(s_suppkey + 700000 AS INTEGER) AS usaf, CAST(s_suppkey * 7 % 100000 AS INTEGER) AS wban,
        r_name AS continent FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey"""),
    "fx_weather": ([], f"""SELECT make_timestamp(slot * 3600000000) AS ts, callsign,
        CASE WHEN slot % 20 = 0 THEN -9999 ELSE CAST(c // (n * 10) AS INTEGER) - 100 END AS temp,
        CAST(n AS INTEGER) AS wind_spd, CASE WHEN n > 1 THEN CAST(c % 7 AS INTEGER) ELSE -9999 END AS precip_1hr
        FROM (SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS slot, concat('K', user_id % 10) AS callsign,
              CAST(sum({_CENTS.format(c='value')}) AS BIGINT) AS c, count(*) AS n FROM events GROUP BY ALL)"""),
    "fx_joint": (["fx_hourly", "fx_weather"], """SELECT *, 0.7 * val + 0.3 * coalesce(
            lag(val, 24) OVER (PARTITION BY series ORDER BY ts), val) AS fore FROM (
        SELECT c.series, c.ts, CAST(epoch(c.ts) / 3600 AS BIGINT) AS slot,
            row_number() OVER (PARTITION BY c.series ORDER BY c.ts) - 1 AS rn,
            count(*) OVER (PARTITION BY c.series) AS n,
            coalesce(h.val, 50.0 + hour(c.ts))::DOUBLE AS val, CAST(coalesce(w.t, 175) % 350 AS INTEGER) AS temp
        FROM (SELECT s.series, r.ts FROM (SELECT DISTINCT series FROM fx_hourly) s, (
              SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM fx_hourly) r) c
        LEFT JOIN fx_hourly h ON h.series = c.series AND h.ts = c.ts
        LEFT JOIN (SELECT ts, max(temp) AS t FROM fx_weather WHERE temp > -900 GROUP BY ts) w ON w.ts = c.ts)"""),
    "fx_pts": (["fx_long"], f"""SELECT ts, source, measure, CASE WHEN hour(ts) <> 23 THEN val END AS val,
        CAST(ts AS DATE) AS day, concat('S', (CAST(source[2:] AS INTEGER) + 1) % 10) AS nxt,
        day(ts) % 5 = 0 AS is_local,
        concat('EBA.', source, '-', CASE WHEN measure = 'error' THEN
            concat('S', (CAST(source[2:] AS INTEGER) + 1) % 10) ELSE 'ALL' END, '.',
            {_case('measure', {k: v[0] for k, v in TAGS.items()})},
            CASE WHEN day(ts) % 5 = 0 THEN '.HL' ELSE '.H' END) AS series_id,
        concat({_case('measure', {k: v[2] for k, v in TAGS.items()})}, ' for Region ', source[2:], ' (', source, ')',
            CASE WHEN measure = 'error' THEN concat(' to Region ', (CAST(source[2:] AS INTEGER) + 1) % 10, ' (S',
                (CAST(source[2:] AS INTEGER) + 1) % 10, ')') ELSE '' END,
            CASE WHEN day(ts) % 5 = 0 THEN ', Hourly, local time' ELSE ', Hourly, UTC time' END) AS name,
        {_case('measure', {k: v[1] for k, v in TAGS.items()})} AS tag FROM fx_long"""),
    "fx_docs": (["fx_pts"], """SELECT source, measure, day, series_id, name, tag, nxt, is_local,
        strftime(min(ts), '%Y%m%dT%HZ') AS start, strftime(max(ts), '%Y%m%dT%HZ') AS "end", count(*) AS n_points
        FROM fx_pts GROUP BY ALL"""),
    "fx_cats": ([], """SELECT concat('S', k) AS category_id, concat('Region ', k, ' Power, Inc. (S', k, ')') AS name
        FROM (SELECT DISTINCT user_id % 10 AS k FROM events) UNION ALL
        SELECT concat('n', n_nationkey), concat(n_name, ' grid (n', n_nationkey, 'x)') FROM nation"""),
}


def with_views(body: str, *views: str) -> str:
    """Prefix a DuckDB query with the views it needs, in order."""
    order: list[str] = []

    def add(name: str) -> None:
        for dep in VIEW_SQL[name][0]:
            add(dep)
        if name not in order:
            order.append(name)

    for v in views:
        add(v)
    ctes = [f"{v} AS ({VIEW_SQL[v][1]})" for v in order]
    head = body.lstrip()
    if not ctes:
        return head
    if head[:5].upper() == "WITH ":
        rest = head[5:]
        if rest[:10].upper() == "RECURSIVE ":
            return "WITH RECURSIVE " + ", ".join(ctes) + ", " + rest[10:]
        return "WITH " + ", ".join(ctes) + ", " + rest
    return "WITH " + ", ".join(ctes) + " " + head
