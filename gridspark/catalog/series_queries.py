"""Cleaning and time-series operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark import fixtures as fx
from gridspark.catalog.align_queries import SOURCES
from gridspark.catalog.base import query, r, rounded
from gridspark.functions import timefn
from gridspark.operators import align, grid, quality, series, stats

K = ["series"]


def _remove_na_sql(w: int) -> str:
    return f"""SELECT d.series, d.ts, {r(f'''coalesce(last_value(d.val IGNORE NULLS) OVER (PARTITION BY d.series, d.rn % {w}
        ORDER BY d.rn ROWS UNBOUNDED PRECEDING), t.wrapped)''', 'val')} FROM fx_dirty d LEFT JOIN (
        SELECT series, rn - (n - {w}) AS i0, coalesce(val, mean) AS wrapped FROM (
            SELECT *, avg(val) OVER (PARTITION BY series) AS mean FROM fx_dirty) WHERE rn >= n - {w}) t
        ON t.series = d.series AND t.i0 = d.rn % {w}"""


def _extremes_sql(w: int) -> str:
    return f"""WITH m AS (SELECT *, coalesce(val - avg(val) OVER p > 4 * stddev_samp(val) OVER p OR val = 0, false) AS bad
        FROM fx_dirty WINDOW p AS (PARTITION BY series)),
        c AS (SELECT *, last_value(CASE WHEN NOT bad THEN {{'v': val}} END IGNORE NULLS) OVER (
            PARTITION BY series, rn % {w} ORDER BY rn ROWS UNBOUNDED PRECEDING) AS kept FROM m)
        SELECT c.series, c.ts, {r('CASE WHEN kept IS NULL THEN t.val ELSE kept.v END', 'val')} FROM c LEFT JOIN (
        SELECT series, rn - (n - {w}) AS i0, val FROM m WHERE rn >= n - {w}) t
        ON t.series = c.series AND t.i0 = c.rn % {w}"""


@query("remove_na", _remove_na_sql(24), ("fx_dirty",))
def remove_na(spark, sf):
    return rounded(quality.remove_na(fx.dirty(spark, sf), K, window=24).select("series", "ts", "val"), "val")


@query("remove_na_neighbour", _remove_na_sql(2), ("fx_dirty",))
def remove_na_neighbour(spark, sf):
    return rounded(quality.remove_na(fx.dirty(spark, sf), K, window=2).select("series", "ts", "val"), "val")


@query("avg_extremes", _extremes_sql(24), ("fx_dirty",))
def avg_extremes(spark, sf):
    return rounded(quality.avg_extremes(fx.dirty(spark, sf), K, window=24).select("series", "ts", "val"), "val")


@query("avg_extremes_neighbour", _extremes_sql(2), ("fx_dirty",))
def avg_extremes_neighbour(spark, sf):
    return rounded(quality.avg_extremes(fx.dirty(spark, sf), K, window=2).select("series", "ts", "val"), "val")


def _both_sql(w: int) -> str:
    back = f"last_value(val IGNORE NULLS) OVER (PARTITION BY series, rn % {w} ORDER BY rn ROWS UNBOUNDED PRECEDING)"
    ahead = f"""first_value(val IGNORE NULLS) OVER (PARTITION BY series, rn % {w} ORDER BY rn
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""
    return f"""SELECT series, ts, {r('(coalesce(a, b) + coalesce(b, a)) / 2', 'val')} FROM (
        SELECT series, ts, {back} AS a, {ahead} AS b FROM fx_dirty)"""


@query("remove_na_both", _both_sql(24), ("fx_dirty",))
def remove_na_both(spark, sf):
    return rounded(quality.remove_na(fx.dirty(spark, sf), K, window=24, side="both").select("series", "ts", "val"), "val")


@query("moving_avg", f"""SELECT series, ts, {r('''CASE WHEN rn >= 6 AND rn < n - 6 THEN sum(val) OVER (PARTITION BY series ORDER BY rn
    ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING) / 12 ELSE 0 END''', 'smooth')} FROM fx_joint""", ("fx_joint",))
def moving_avg(spark, sf):
    out = series.moving_avg(fx.joint(spark, sf), K, width=6)
    return rounded(out.select("series", "ts", "smooth"), "smooth")


@query("moving_avg_holes", f"""SELECT series, ts, {r('''CASE WHEN rn >= 6 AND rn < n - 6 THEN avg(val) OVER (PARTITION BY series ORDER BY rn
    ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING) ELSE 0 END''', 'smooth')} FROM fx_dirty""", ("fx_dirty",))
def moving_avg_holes(spark, sf):
    out = series.moving_avg(fx.dirty(spark, sf), K, width=6)
    return rounded(out.select("series", "ts", "smooth"), "smooth")


def _decompose_sql(p: int) -> str:
    even = p % 2 == 0
    taps = p if even else p - 1
    total = f"sum(val) OVER (PARTITION BY series ORDER BY rn ROWS {taps} PRECEDING)"
    if even:
        total = f"({total} - (val + lag(val, {p}) OVER (PARTITION BY series ORDER BY rn)) / 2)"
    return f"""WITH t AS (SELECT *, CASE WHEN rn >= {taps} THEN {total} / {p} END AS trend, avg(val) OVER (PARTITION BY series) AS mu
        FROM fx_joint), s AS (SELECT series, slot % {p} AS phase, avg(val - trend) AS m FROM t GROUP BY ALL),
        c AS (SELECT *, m - avg(m) OVER (PARTITION BY series) AS seasonal FROM s)
        SELECT t.series, t.ts, {r('trend / mu', 'trend')}, {r('seasonal / mu', 'seasonal')},
        {r('(val - trend - seasonal) / mu', 'residual')} FROM t JOIN c ON c.series = t.series AND c.phase = t.slot % {p}"""


@query("seasonal_decompose", _decompose_sql(24), ("fx_joint",))
def seasonal_decompose(spark, sf):
    out = series.seasonal_decompose(fx.joint(spark, sf), K, period=24)
    return rounded(out.select("series", "ts", "trend", "seasonal", "residual"), "trend", "seasonal", "residual")


@query("seasonal_decompose_weekly", _decompose_sql(7), ("fx_joint",))
def seasonal_decompose_weekly(spark, sf):
    out = series.seasonal_decompose(fx.joint(spark, sf), K, period=7)
    return rounded(out.select("series", "ts", "trend", "seasonal", "residual"), "trend", "seasonal", "residual")


@query("acf", f"""WITH x AS (SELECT series, row_number() OVER (PARTITION BY series ORDER BY rn) AS i,
        val - avg(val) OVER (PARTITION BY series) AS c FROM fx_dirty WHERE val IS NOT NULL),
    z AS (SELECT series, sum(c * c) AS v, count(*) AS n FROM x GROUP BY series)
    SELECT a.series, CAST(k AS INTEGER) AS lag, {r('sum(a.c * b.c) / any_value(z.v)', 'acf')},
    {r('1.96 / sqrt(any_value(z.n))', 'band')} FROM x a, (SELECT unnest(range(0, 25)) AS k) l, x b, z
    WHERE b.series = a.series AND b.i = a.i - k AND z.series = a.series GROUP BY a.series, k""", ("fx_dirty",))
def acf(spark, sf):
    return rounded(series.acf(fx.dirty(spark, sf), K, nlags=24), "acf", "band")


def _pacf_sql(nlags: int) -> str:
    """For each lag k, remove 1 and lags 1..k-1 from lag k over t >= k; the coefficient is what is left against x."""
    lags = ", ".join(f"lag(val, {k}) OVER p AS l{k}" for k in range(1, nlags + 1))
    ctes = [f"""x AS (SELECT series, val AS y, 1.0::DOUBLE AS l0, row_number() OVER p - 1 AS i, {lags} FROM fx_dirty
        WHERE val IS NOT NULL WINDOW p AS (PARTITION BY series ORDER BY rn))"""]
    out = ["SELECT DISTINCT series, 0 AS lag, 1.0::DOUBLE AS pacf FROM x"]
    for k in range(1, nlags + 1):
        source = f"(SELECT * FROM x WHERE i >= {k})"
        for j in range(k):
            left = ", ".join(f"""l{c} - l{j} * (sum(l{c} * l{j}) OVER (PARTITION BY series)
                / sum(l{j} * l{j}) OVER (PARTITION BY series)) AS l{c}""" for c in range(j + 1, k + 1))
            ctes.append(f"k{k}_{j} AS (SELECT series, y, {left} FROM {source})")
            source = f"k{k}_{j}"
        out.append(f"SELECT series, {k}, {r(f'sum(y * l{k}) / sum(l{k} * l{k})', 'pacf')} FROM {source} GROUP BY series")
    return f"WITH {', '.join(ctes)} {' UNION ALL '.join(out)}"


@query("pacf", _pacf_sql(12), ("fx_dirty",))
def pacf(spark, sf):
    return rounded(series.pacf(fx.dirty(spark, sf), K, nlags=12), "pacf")


@query("persistence", f"""SELECT series, part, count(back) AS n, {r('avg(abs(1 - back / val)) FILTER (val <> 0)', 'mape')} FROM (
    SELECT series, val, CASE WHEN rn < n // 2 THEN 'train' ELSE 'test' END AS part,
    CASE WHEN rn < n // 2 OR rn >= n // 2 + 24 THEN lag(val, 24) OVER (PARTITION BY series ORDER BY rn) END AS back
    FROM fx_joint) GROUP BY ALL""", ("fx_joint",))
def persistence(spark, sf):
    rows = series.persistence(fx.joint(spark, sf), K)
    out = rows.groupBy("series", "part").agg(F.count("persist").alias("n"),
                                             stats.mape(F.col("persist"), F.col("val")).alias("mape"))
    return rounded(out, "mape")


@query("day_level", """SELECT series, ts, first_value(val) OVER (PARTITION BY series, slot // 24 ORDER BY rn) AS level
    FROM fx_joint""", ("fx_joint",))
def day_level(spark, sf):
    return series.day_level(fx.joint(spark, sf), K).select("series", "ts", "level")


@query("day_grad", f"""SELECT series, ts, {r('''(last_value(val) OVER w - first_value(val) OVER w) / 23 * (slot % 24)''', 'grad')}
    FROM fx_joint WINDOW w AS (PARTITION BY series, slot // 24 ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
       ("fx_joint",))
def day_grad(spark, sf):
    return rounded(series.day_grad(fx.joint(spark, sf), K).select("series", "ts", "grad"), "grad")


@query("run_boundaries", f"""SELECT CAST(run_id AS BIGINT) AS run_id, event_type, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_rows,
    {r('sum(value)', 'total', 4)} FROM (SELECT *, sum(s) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) - 1 AS run_id
    FROM (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER (ORDER BY ts, event_id) THEN 1 ELSE 0 END AS s
    FROM events)) GROUP BY ALL""")
def run_boundaries(spark, sf):
    ev = fx.table(spark, sf, "events").select("ts", "event_id", "event_type", "value")
    runs = series.run_boundaries(ev, "event_type", ["ts", "event_id"])
    return rounded(series.run_series(runs, "event_type", "ts", "value"), "total", places=4)


@query("meter_runs", f"""SELECT CAST(run_id AS BIGINT) AS run_id, user_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_rows,
    {r('sum(value)', 'total', 4)} FROM (SELECT *, sum(s) OVER (ORDER BY user_id, ts, event_id ROWS UNBOUNDED PRECEDING) - 1 AS run_id
    FROM (SELECT *, CASE WHEN user_id IS DISTINCT FROM lag(user_id) OVER (ORDER BY user_id, ts, event_id)
        OR lag(event_id) OVER (ORDER BY user_id, ts, event_id) IS NULL THEN 1 ELSE 0 END AS s FROM events)) GROUP BY ALL""")
def meter_runs(spark, sf):
    """Readings sorted by meter and time: one run per meter, the last reading included."""
    ev = fx.table(spark, sf, "events").select("ts", "event_id", "user_id", "value")
    runs = series.run_boundaries(ev, "user_id", ["user_id", "ts", "event_id"])
    return rounded(series.run_series(runs, "user_id", "ts", "value"), "total", places=4)


_QUARTERS = f"""q AS (SELECT concat('S', user_id % 10) AS source, time_bucket(INTERVAL 15 MINUTE, ts) AS ts,
    CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS val FROM events GROUP BY ALL)"""


@query("meter_pivot", f"""WITH {_QUARTERS} SELECT c.ts, {", ".join(f"max(val) FILTER (source = '{s}') AS " + chr(34) + s + chr(34) for s in SOURCES)}
    FROM (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 15 MINUTE)) AS ts FROM q) c LEFT JOIN q ON q.ts = c.ts GROUP BY c.ts""")
def meter_pivot(spark, sf):
    ev = fx.table(spark, sf, "events")
    quarter = timefn.slot_ts(timefn.slot_of("ts", timefn.QUARTER_HOUR), timefn.QUARTER_HOUR)
    rows = ev.groupBy(F.concat(F.lit("S"), F.col("user_id") % 10).alias("source"), quarter.alias("ts")).agg(
        fx.cents_sum("value").alias("val"))
    full = align.calendar_fill(rows, ["source"], ["val"], step=timefn.QUARTER_HOUR, common=True)
    return align.outer_align(full, "ts", "source", "val", SOURCES)


@query("identity_residual", f"""SELECT ts, source, demand, generation, interchange, {r('demand - (generation - interchange)', 'residual', 4)}
    FROM (SELECT ts, source, sum(val) FILTER (measure = 'purchase') AS demand, sum(val) FILTER (measure = 'view') AS generation,
    sum(val) FILTER (measure = 'error') AS interchange FROM fx_long WHERE measure IN ('purchase', 'view', 'error') GROUP BY ALL)""",
       ("fx_long",))
def identity_residual(spark, sf):
    out = quality.identity_residual(fx.long(spark, sf), ["ts", "source"], "purchase", "view", "error")
    return rounded(out, "residual", places=4)


@query("pct_error", f"""SELECT series, ts, {r('fore / val - 1', 'pct')}, {r('fore - val', 'err')} FROM fx_joint WHERE val <> 0""",
       ("fx_joint",))
def pct_error(spark, sf):
    rows = fx.joint(spark, sf).where("val <> 0")
    out = rows.select("series", "ts", series.pct_error(F.col("fore"), F.col("val")).alias("pct"),
                      (F.col("fore") - F.col("val")).alias("err"))
    return rounded(out, "pct", "err")


@query("lag_features", f"""SELECT series, ts, {r('val - lag(val, 1) OVER w', 'd1')}, {r('lag(val, 24) OVER w - lag(val, 25) OVER w', 'd_day')},
    lag(val, 168) OVER w AS l_week FROM fx_joint WINDOW w AS (PARTITION BY series ORDER BY rn)""", ("fx_joint",))
def lag_features(spark, sf):
    out = series.lag_features(fx.joint(spark, sf), K)
    return rounded(out.select("series", "ts", "d1", "d_day", "l_week"), "d1", "d_day")


@query("seq_windows", f"""SELECT series, ts, {r('x[1] + 2 * x[24]', 'x_mark')}, {r('list_sum(x)', 'x_sum')}, {r('y[1] + 2 * y[24]', 'y_mark')},
    {r('list_sum(y)', 'y_sum')} FROM (SELECT *, list(temp) OVER (PARTITION BY series ORDER BY rn ROWS BETWEEN CURRENT ROW AND 23 FOLLOWING) AS x,
    list(val) OVER (PARTITION BY series ORDER BY rn ROWS BETWEEN 24 FOLLOWING AND 47 FOLLOWING) AS y FROM fx_joint)
    WHERE rn % 24 = 0 AND rn + 47 < n""", ("fx_joint",))
def seq_windows(spark, sf):
    w = series.seq_windows(fx.joint(spark, sf), K, "temp", "val", 24)

    def total(c):
        return F.aggregate(c, F.lit(0.0), lambda a, v: a + v)

    out = w.select("series", timefn.slot_ts("slot").alias("ts"),
                   (F.col("x")[0] + 2 * F.col("x")[23]).cast("double").alias("x_mark"), total("x").alias("x_sum"),
                   (F.col("y")[0] + 2 * F.col("y")[23]).alias("y_mark"), total("y").alias("y_sum"))
    return rounded(out, "x_mark", "x_sum", "y_mark", "y_sum")


@query("sample_windows", """WITH p AS (SELECT series, min(slot) AS lo, count(*) AS n FROM fx_joint GROUP BY series),
    s AS (SELECT series, k AS sample, lo + CAST('0x' || md5(concat_ws('-', series, k, 7653))[1:8] AS BIGINT) % (n - 48) AS start
          FROM p, (SELECT unnest(range(0, 200)) AS k))
    SELECT s.series, CAST(sample AS INTEGER) AS sample, CAST(slot - start AS INTEGER) AS step, ts, val, temp
    FROM s JOIN fx_joint j ON j.series = s.series AND j.slot >= start AND j.slot < start + 48""", ("fx_joint",))
def sample_windows(spark, sf):
    return series.sample_windows(fx.joint(spark, sf), K, 200, 48).select("series", "sample", "step", "ts", "val", "temp")


@query("sample_windows_short", """WITH p AS (SELECT series, min(slot) AS lo, count(*) AS n FROM fx_joint WHERE series <> 'view' OR ts < TIMESTAMP '2024-01-02 06:00:00' GROUP BY series),
    s AS (SELECT series, k AS sample, lo + CAST('0x' || md5(concat_ws('-', series, k, 7653))[1:8] AS BIGINT) % (n - 48) AS start
          FROM p, (SELECT unnest(range(0, 9)) AS k) WHERE n > 48)
    SELECT s.series, CAST(sample AS INTEGER) AS sample, CAST(slot - start AS INTEGER) AS step, ts, val
    FROM s JOIN fx_joint j ON j.series = s.series AND j.slot >= start AND j.slot < start + 48
    UNION ALL SELECT series, NULL, NULL, NULL, NULL FROM p WHERE n < 48""", ("fx_joint",))
def sample_windows_short(spark, sf):
    """A series shorter than the window stays, with NULLs."""
    rows = fx.joint(spark, sf).where("series <> 'view' or ts < timestamp_ntz '2024-01-02 06:00:00'")
    return series.sample_windows(rows, K, 9, 48).select("series", "sample", "step", "ts", "val")


@query("sample_days", """WITH p AS (SELECT series, min(slot) AS lo, max(slot) AS hi FROM fx_joint
        WHERE ts > TIMESTAMP '2024-01-03 05:00:00' AND ts <= TIMESTAMP '2024-01-27' GROUP BY series),
    q AS (SELECT series, hi, CAST(ceil(lo / 24.0) * 24 AS BIGINT) AS f FROM p),
    s AS (SELECT series, k AS sample, f + CAST('0x' || md5(concat_ws('-', series, k, 11))[1:8] AS BIGINT) % ((hi + 1 - 24 - f + 23) // 24) * 24 AS start
          FROM q, (SELECT unnest(range(0, 40)) AS k))
    SELECT s.series, CAST(sample AS INTEGER) AS sample, min(ts) AS first_ts, count(*) AS n FROM s
    JOIN fx_joint j ON j.series = s.series AND j.slot >= start AND j.slot < start + 24 GROUP BY ALL""", ("fx_joint",))
def sample_days(spark, sf):
    """The dataset definition: a date span, a seed, and whole days drawn from it."""
    out = series.sample_windows(fx.joint(spark, sf), K, 40, 24, seed=11, every=24, after="2024-01-03 05:00:00",
                                until="2024-01-27")
    return out.groupBy("series", "sample").agg(F.min("ts").alias("first_ts"), F.count(F.lit(1)).alias("n"))


@query("block_score", f"""SELECT series, ts, {r('0.5 * val + 0.5 * avg(val) OVER (PARTITION BY series, slot // 24) + 0.1 * temp', 'pred')}
    FROM fx_joint""", ("fx_joint",))
def block_score(spark, sf):
    def model(x):
        return 0.5 * x[..., 0] + 0.5 * x[..., 0].mean(axis=1, keepdims=True) + 0.1 * x[..., 1]

    out = series.block_score(fx.joint(spark, sf), K, ["val", "temp"], model)
    return rounded(out.select("series", timefn.slot_ts("slot").alias("ts"), "pred"), "pred")


@query("block_score_partial", f"""SELECT series, ts, {r('''CASE WHEN count(*) OVER (PARTITION BY series, slot // 24) = 24 THEN
    0.5 * val + 0.5 * avg(val) OVER (PARTITION BY series, slot // 24) + 0.1 * temp END''', 'pred')}
    FROM fx_joint WHERE ts >= TIMESTAMP '2024-01-01 05:00:00' AND ts < TIMESTAMP '2024-01-29 17:00:00'""", ("fx_joint",))
def block_score_partial(spark, sf):
    """The first and the last day are incomplete: their rows stay, unscored."""
    def model(x):
        return 0.5 * x[..., 0] + 0.5 * x[..., 0].mean(axis=1, keepdims=True) + 0.1 * x[..., 1]

    out = series.block_score(fx.joint(spark, sf).where(timefn.half_open("ts", "2024-01-01 04:00:00", "2024-01-29 16:00:00")), K, ["val", "temp"], model)
    return rounded(out.select("series", timefn.slot_ts("slot").alias("ts"), "pred"), "pred")


@query("minmax_train", f"""SELECT series, ts, part, {r('(val - lo) / (hi - lo)', 'scaled')}, val AS back FROM (SELECT *,
    CASE WHEN rn < n // 2 THEN 'train' ELSE 'test' END AS part, min(val) FILTER (rn < n // 2) OVER (PARTITION BY series) AS lo,
    max(val) FILTER (rn < n // 2) OVER (PARTITION BY series) AS hi FROM fx_joint)""", ("fx_joint",))
def minmax_train(spark, sf):
    rows = series.minmax_train(fx.joint(spark, sf), K)
    back = series.minmax_inverse(F.col("scaled"), F.col("train_min"), F.col("train_max"))
    return rounded(rows.select("series", "ts", "part", "scaled", F.round(back, 2).alias("back")), "scaled")


@query("time_split", """SELECT series, part, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM (SELECT *,
    CASE WHEN rn < floor(n * 0.9) THEN 'train' ELSE 'test' END AS part FROM fx_joint) GROUP BY ALL""", ("fx_joint",))
def time_split(spark, sf):
    rows = series.split_half(fx.joint(spark, sf), K, ratio=0.9)
    return rows.groupBy("series", "part").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"),
                                              F.max("ts").alias("last_ts"))


@query("day_of_hour", """SELECT series, ts, val FROM fx_joint WHERE hour(ts) = 4""", ("fx_joint",))
def day_of_hour(spark, sf):
    """One hour of each day as a daily series on a daily calendar."""
    rows = fx.joint(spark, sf).where(F.hour("ts") == 4).select("series", "ts", "val")
    out = align.calendar_fill(rows, K, ["val"], step=timefn.DAY)
    return out.select("series", F.timestamp_add("HOUR", F.lit(4), F.col("ts")).alias("ts"), "val")
