"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark import fixtures as fx
from gridspark.catalog.base import query, r, rounded
from gridspark.catalog.scalar_queries import elec_docs
from gridspark.functions import text, timefn
from gridspark.operators import quality, select, stats
from gridspark.sources import elec

TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("type_counts", """SELECT trim(split_part(name, ':', 1)) AS series_type, count(*) AS n FROM (
    SELECT name FROM fx_monthly UNION ALL SELECT concat(p_type, ' : ', p_brand) FROM part) GROUP BY ALL""", ("fx_monthly",))
def type_counts(spark, sf):
    return stats.type_counts(_typed_names(spark, sf))


def _typed_names(spark, sf):
    parts = fx.table(spark, sf, "part").select(F.concat("p_type", F.lit(" : "), "p_brand").alias("name"))
    return fx.monthly(spark, sf).select("name").unionByName(parts)


@query("type_counts_containing", """WITH t AS (SELECT split_part(p_name, ' ', 1) AS series_type, count(*) AS n FROM part GROUP BY ALL
    UNION ALL SELECT p_name, count(*) FROM part GROUP BY ALL)
    SELECT a.series_type, CAST(sum(b.n) AS BIGINT) AS n FROM (SELECT series_type, sum(n) FROM t GROUP BY ALL) a
    JOIN (SELECT series_type, sum(n) AS n FROM t GROUP BY ALL) b ON contains(b.series_type, a.series_type) GROUP BY ALL""")
def type_counts_containing(spark, sf):
    part = fx.table(spark, sf, "part")
    names = part.select(F.split("p_name", " ")[0].alias("name")).unionByName(part.select(F.col("p_name").alias("name")))
    return stats.type_counts_containing(names)


@query("series_max", """SELECT name, max(val) AS max_val FROM fx_monthly WHERE period[1:4] = '1998' GROUP BY name
    ORDER BY max_val DESC, name""", ("fx_monthly",))
def series_max(spark, sf):
    rows = fx.monthly(spark, sf).withColumn("ts", timefn.period_start("period", "f").cast("timestamp_ntz"))
    return stats.series_max(rows, ["name"], year=1998)


@query("series_stats", f"""SELECT series, count(*) AS n_rows, {r('avg(val)', 'mean')}, {r('stddev_samp(val)', 'std')},
    min(val) AS min_val, max(val) AS max_val FROM fx_cal GROUP BY series""", ("fx_cal",))
def series_stats(spark, sf):
    return rounded(stats.series_stats(fx.calendar(spark, sf), ["series"]), "mean", "std")


@query("gen_by_source", """SELECT trim(split_part(name, ':', 2)) AS label, max(val) AS max_val, sum(val) AS total FROM fx_monthly
    WHERE name LIKE '%Net generation%' AND name LIKE '%: NATION_3 :%' AND name LIKE '%: all sectors%' AND f LIKE 'M'
    GROUP BY ALL ORDER BY max_val DESC""", ("fx_monthly",))
def gen_by_source(spark, sf):
    rows = select.multi_like(fx.monthly(spark, sf), ["name", "val"], ["Net generation", ": NATION_3 :", ": all sectors"], "M")
    return (rows.groupBy(text.generation_label("name").alias("label"))
            .agg(F.max("val").alias("max_val"), F.sum("val").alias("total")).orderBy(F.desc("max_val"), "label"))


def annual(spark, sf):
    """elec_gen-like rows: ELEC.GEN.{fuel}-{state}-99.A at December 31st; fuel ALL is the total."""
    m = fx.monthly(spark, sf)
    fuel, place = text.name_level("name", 1), F.regexp_replace(text.name_level("name", 2), "NATION_", "")
    date = F.make_date(F.substring("period", 1, 4).cast("int"), F.lit(12), F.lit(31))
    rows = m.select(fuel.alias("fuel"), place.alias("place"), date.alias("obs_date"), "val")
    both = rows.select(F.explode(F.array("fuel", F.lit("ALL"))).alias("fuel"), "place", "obs_date", "val")
    sums = both.groupBy("fuel", "place", "obs_date").agg(F.sum("val").alias("obs_val"))
    return sums.select(F.concat(F.lit("ELEC.GEN."), "fuel", F.lit("-"), "place", F.lit("-99.A")).alias("series_id"),
                       "obs_date", "obs_val")


_FUELS = [*TYPES, "ALL"]
_CELL = ", ".join(f"sum(val) FILTER (trim(split_part(name, ':', 2)) = '{t}') AS \"{t}\"" for t in TYPES)
_MATRIX = f"""SELECT replace(trim(split_part(name, ':', 3)), 'NATION_', '') AS state, {_CELL}, sum(val) AS "ALL"
    FROM fx_monthly WHERE period[1:4] = '1999' GROUP BY ALL"""


@query("state_fuel_pivot", _MATRIX, ("fx_monthly",))
def state_fuel_pivot(spark, sf):
    return stats.state_fuel_pivot(stats.elec_gen_rows(annual(spark, sf)), 1999, _FUELS)


_SHARES = ", ".join(r(f'"{t}" / "ALL"', f'"{t}"') for t in TYPES)


@query("fuel_share", f"SELECT state, {_SHARES} FROM ({_MATRIX})", ("fx_monthly",))
def fuel_share(spark, sf):
    return rounded(stats.fuel_share(state_fuel_pivot(spark, sf), TYPES), *TYPES)


@query("minmax_fill", f"""SELECT source, max_val, {r('(coalesce(max_val, lo) - lo) / (hi - lo)', 'shade')} FROM (
    SELECT *, round(min(max_val) OVER (), 2) AS lo, round(max(max_val) OVER (), 2) AS hi FROM (
    SELECT source, CASE WHEN source <> 3 THEN max(val) END AS max_val FROM fx_flow GROUP BY source))
    WHERE source NOT IN (7, 11)""", ("fx_flow",))
def minmax_fill(spark, sf):
    rows = fx.flow(spark, sf).groupBy("source").agg(F.max("val").alias("max_val"))
    rows = rows.withColumn("max_val", F.when(F.col("source") != 3, F.col("max_val")))
    return rounded(stats.minmax_fill(rows, "max_val", "source", [7, 11]), "shade")


@query("sector_series", """SELECT trim(split_part(name, ':', 2)) AS sector, CAST(strptime(concat(period, '01'), '%Y%m%d') AS DATE)
    AS obs_date, val AS obs_val FROM fx_monthly WHERE name LIKE '%: NATION_5 :%'""", ("fx_monthly",))
def sector_series(spark, sf):
    docs = select.multi_like(elec_docs(spark, sf), ["name", "data", "f"], [": NATION_5 :"], "M")
    rows = elec.period_explode(docs, ["name"])
    return rows.select(text.name_level("name", 1).alias("sector"), "obs_date", "obs_val")


def _wide(spark, sf):
    cells = {m: F.max(F.when(F.col("series") == m, F.col("val"))).alias(m) for m in fx.TAGS}
    return fx.hourly(spark, sf).groupBy("ts").agg(*cells.values())


_NAMES = list(fx.TAGS)
_CELLS = ", ".join(f"max(val) FILTER (series = '{m}') AS {m}" for m in _NAMES)


@query("corr_matrix", f"WITH w AS (SELECT ts, {_CELLS} FROM fx_hourly GROUP BY ts) " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})', 'r')} FROM w" for a in _NAMES for b in _NAMES), ("fx_hourly",))
def corr_matrix(spark, sf):
    return rounded(stats.corr_matrix(_wide(spark, sf), _NAMES), "r")


@query("corr_series", f"""SELECT a.s AS a, b.s AS b, {r('corr(a.v, b.v)', 'r')} FROM (SELECT concat('S', user_id % 40) AS s, date_trunc('hour', ts) AS ts,
    sum(value) AS v FROM events GROUP BY ALL) a JOIN (SELECT concat('S', user_id % 40) AS s, date_trunc('hour', ts) AS ts, sum(value) AS v
    FROM events GROUP BY ALL) b ON a.ts = b.ts GROUP BY ALL""")
def corr_series(spark, sf):
    """Correlations of all pairs of a long frame's series, by blocks."""
    rows = (fx.table(spark, sf, "events").groupBy(F.concat(F.lit("S"), F.col("user_id") % 40).alias("s"), fx.hour_of().alias("ts"))
            .agg(F.sum("value").alias("v")))
    return rounded(stats.corr_series(rows, "s", "ts", "v", block=16), "r")


@query("rmse", f"""SELECT series, {r('sqrt(sum((fore - val) ** 2) / count(*))', 'rmse')} FROM fx_joint GROUP BY series""",
       ("fx_joint",))
def rmse(spark, sf):
    out = fx.joint(spark, sf).groupBy("series").agg(stats.rmse(F.col("fore"), F.col("val")).alias("rmse"))
    return rounded(out, "rmse")


@query("mape", f"""SELECT series, {r('avg(abs(1 - fore / val))', 'mape')}, {r('avg(abs(1 - fore / (val + 1e-16)))', 'mape_eps')}
    FROM fx_joint WHERE val <> 0 GROUP BY series""", ("fx_joint",))
def mape(spark, sf):
    p, a = F.col("fore"), F.col("val")
    out = fx.joint(spark, sf).where("val <> 0").groupBy("series").agg(
        stats.mape(p, a).alias("mape"), stats.mape(p, a, 1e-16).alias("mape_eps"))
    return rounded(out, "mape", "mape_eps")


@query("quality_counts", """SELECT series, count(*) AS n_rows, count(*) FILTER (val IS NULL) AS n_null,
    count(*) FILTER (val - mu > 4 * sd) AS n_high, count(*) FILTER (val = 0) AS n_zero FROM (
    SELECT *, avg(val) OVER (PARTITION BY series) AS mu, stddev_samp(val) OVER (PARTITION BY series) AS sd FROM fx_dirty)
    GROUP BY series""", ("fx_dirty",))
def quality_counts(spark, sf):
    return quality.quality_counts(fx.dirty(spark, sf), ["series"])


@query("season_profile", f"""SELECT series, CAST(isodow(ts) >= 6 AS INTEGER) AS weekend, CAST(hour(ts) AS INTEGER) AS hour,
    {r('avg(val)', 'mean')} FROM fx_joint GROUP BY ALL""", ("fx_joint",))
def season_profile(spark, sf):
    return rounded(stats.season_profile(fx.joint(spark, sf), ["series"]), "mean")
