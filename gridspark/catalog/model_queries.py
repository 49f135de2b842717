"""Forecasting models and their scores."""

from __future__ import annotations

from math import pi

from pyspark.sql import functions as F

from gridspark import fixtures as fx
from gridspark.catalog.base import query, r, rounded
from gridspark.functions import timefn
from gridspark.models import localdays, features, fourier, score, smoothing, spectral, temp_response
from gridspark.models.smoothing import Params
from gridspark.operators import grid, quality, series, stats

K = ["series"]
NINIT = 14 * 24
RATES = Params(alpha=0.1, beta=0.1, g00=0.1, g01=0.02, g10=0.02, g11=0.1)
TEMP_RATES = Params(alpha=0.15, beta=0.15, g00=0.05, g01=0.04, g10=0.01, g11=0.05, An=0.6, Ap=0.4, Tn=150.0, Tp=200.0)
_PHASE = {"annual": "dayofyear(ts) / 365.0", "weekly": "((isodow(ts) - 1) * 24 + hour(ts)) / 168.0", "daily": "hour(ts) / 24.0"}


def _fit_sql(view: str, n_max: dict[str, int], places: int) -> str:
    parts = [f"SELECT series, 'mean' AS period, 0 AS n, {r('avg(val)', 'a', places)}, 0.0::DOUBLE AS b FROM {view} GROUP BY series"]
    for p, top in n_max.items():
        angle = f"2 * {pi!r}::DOUBLE * k * {_PHASE[p]}"
        parts.append(f"""SELECT series, '{p}', k, {r(f'2 * sum(cos({angle}) * val) / count(*)', 'a', places)},
            {r(f'2 * sum(sin({angle}) * val) / count(*)', 'b', places)}
            FROM {view}, (SELECT CAST(unnest(range(1, {top + 1})) AS INTEGER) AS k) GROUP BY series, k""")
    return " UNION ALL ".join(parts)


DAILY_TERMS = {"annual": 3, "weekly": 2}
HOURLY_TERMS = {"weekly": 2, "daily": 3}


@query("fourier_fit", _fit_sql("fx_daily", DAILY_TERMS, 3), ("fx_daily",))
def fourier_fit(spark, sf):
    return rounded(fourier.fit(fx.daily(spark, sf), K, DAILY_TERMS), "a", "b", places=3)


@query("fourier_fit_hourly", _fit_sql("fx_joint", HOURLY_TERMS, 5), ("fx_joint",))
def fourier_fit_hourly(spark, sf):
    return rounded(fourier.fit(fx.joint(spark, sf), K, HOURLY_TERMS), "a", "b", places=5)


def _predict_sql() -> str:
    cells = []
    for p, top in HOURLY_TERMS.items():
        for k in range(1, top + 1):
            angle = f"2 * {pi!r}::DOUBLE * {k} * {_PHASE[p]}"
            for fn in ("cos", "sin"):
                cells.append(f"2 * avg(val * {fn}({angle})) OVER (PARTITION BY series) * {fn}({angle})")
    return f"SELECT series, ts, {r('avg(val) OVER (PARTITION BY series) + ' + ' + '.join(cells), 'fourier', 5)} FROM fx_joint"


@query("fourier_predict", _predict_sql(), ("fx_joint",))
def fourier_predict(spark, sf):
    rows = fx.joint(spark, sf)
    out = fourier.predict(rows, fourier.fit(rows, K, HOURLY_TERMS), K, HOURLY_TERMS)
    return rounded(out.select("series", "ts", "fourier"), "fourier", places=5)


def rate_grid(base: Params) -> list[Params]:
    from dataclasses import replace

    return [replace(base, alpha=a, beta=b, g00=g, g11=g) for a in (0.05, 0.15, 0.4) for b in (0.0, 0.05, 0.15)
            for g in (0.02, 0.1, 0.3)]


_T = "{a0} + 0.4 * greatest(temp - 200, 0) + 0.6 * greatest(150 - temp, 0)"


@query("temp_response", f"SELECT series, ts, {r(_T.format(a0='100'), 'pred')} FROM fx_joint", ("fx_joint",))
def temp_response_q(spark, sf):
    lit = F.lit
    pred = temp_response.response(F.col("temp"), lit(0.4), lit(0.6), lit(200.0), lit(150.0), lit(100.0))
    return rounded(fx.joint(spark, sf).select("series", "ts", pred.alias("pred")), "pred")


@query("temp_response_abs", f"SELECT series, ts, {r('100 + 0.4 * abs(temp - 150)', 'pred')} FROM fx_joint", ("fx_joint",))
def temp_response_abs(spark, sf):
    pred = temp_response.response_abs(F.col("temp"), F.lit(100.0), F.lit(0.4), F.lit(150.0))
    return rounded(fx.joint(spark, sf).select("series", "ts", pred.alias("pred")), "pred")


@query("temp_gradient", f"""WITH e AS (SELECT *, {_T.format(a0='100')} - val AS err FROM fx_joint)
    SELECT series, {r('avg(err)', 'd_a0')}, {r('sum(greatest(temp - 200, 0) * err) / count(*)', 'd_ap', 4)},
    {r('sum(greatest(150 - temp, 0) * err) / count(*)', 'd_an', 4)},
    {r('coalesce(-0.4 * sum(err) FILTER (temp > 200), 0) / count(*)', 'd_tp')},
    {r('coalesce(0.6 * sum(err) FILTER (temp < 150), 0) / count(*)', 'd_tn')}, {r('avg(err * err)', 'cost', 3)}
    FROM e GROUP BY series""", ("fx_joint",))
def temp_gradient(spark, sf):
    params = {"a0": 100.0, "ap": 0.4, "an": 0.6, "tp": 200.0, "tn": 150.0}
    rows = fx.joint(spark, sf).withColumns({k: F.lit(v) for k, v in params.items()})
    out = temp_response.gradient(rows, K)
    out = rounded(out, "d_a0", "d_tp", "d_tn")
    return rounded(rounded(out, "d_ap", "d_an", places=4), "cost", places=3)


def _descent_sql(alpha: float, nmax: int, rtol: float = 1e-6, rows: str = "fx_joint") -> str:
    def total(expr: str) -> str:
        return f"list_sum(list_transform(range(1, len(t) + 1), lambda i: {expr}))"

    hot, cold = "greatest(t[i] - tp, 0)", "greatest(tn - t[i], 0)"
    return f"""WITH RECURSIVE g AS (SELECT series, CAST(temp AS DOUBLE) AS t, count(*) AS n, sum(val) AS y, sum(val * val) AS y2,
        min(val) AS lo, max(val) AS hi FROM {rows} GROUP BY series, temp),
    p AS (SELECT series, list(t ORDER BY t) AS t, list(n ORDER BY t) AS n, list(y ORDER BY t) AS y, CAST(sum(n) AS DOUBLE) AS m, sum(y2) AS y2,
        sum(y) / sum(n) AS a0, 0.5 * (max(hi) - min(lo)) / greatest(max(t) - min(t), 1) AS slope, sum(n * t) / sum(n) AS mt FROM g GROUP BY series),
    w AS (SELECT series, t, n, y, m, y2, 0 AS steps, a0, slope AS ap, slope AS an, mt AS tp, mt AS tn, NULL::DOUBLE AS previous,
            NULL::DOUBLE AS cost, false AS done FROM p
        UNION ALL
        SELECT series, t, n, y, m, y2, steps + 1, a0 - {alpha} * da0, ap - {alpha} * dap, an - {alpha} * dan, tp - {alpha} * dtp, tn - {alpha} * dtn,
            now, NULL::DOUBLE, CASE WHEN previous IS NULL THEN false ELSE abs(1 - previous / now) < {rtol} END
        FROM (SELECT *, (list_sum(list_transform(range(1, len(t) + 1), lambda i: n[i] * q[i] * q[i] - 2 * q[i] * y[i])) + y2) / m AS now,
            {total('err[i]')} / m AS da0, {total(f'{hot} * err[i]')} / m AS dap, {total(f'{cold} * err[i]')} / m AS dan,
            {total('CASE WHEN t[i] > tp THEN -ap * err[i] ELSE 0 END')} / m AS dtp,
            {total('CASE WHEN t[i] < tn THEN an * err[i] ELSE 0 END')} / m AS dtn
            FROM (SELECT *, list_transform(range(1, len(t) + 1), lambda i: n[i] * q[i] - y[i]) AS err FROM (
                SELECT *, list_transform(range(1, len(t) + 1), lambda i: a0 + ap * {hot} + an * {cold}) AS q
                FROM w WHERE NOT done AND steps <= {nmax}))))
    -- a row holds the parameters after `steps` steps and the cost before its last step; the step that sees the stop
    -- is one too many, so the row before it is the answer
    SELECT a.series, {", ".join(r(f'a.{c}', c, 4) for c in ('a0', 'ap', 'an', 'tp', 'tn'))}, {r('b.previous', 'cost', 4)}, a.steps
    FROM w a JOIN w b ON b.series = a.series AND b.steps = a.steps + 1 WHERE b.done OR b.steps = {nmax + 1}"""


@query("temp_fit", _descent_sql(1e-4, 200), ("fx_joint",))
def temp_fit(spark, sf):
    out = temp_response.fit(fx.joint(spark, sf), K, alpha=1e-4, nmax=200)
    return rounded(out, *temp_response.PARAMS, "cost", places=4)


_QUARTERS = "(SELECT series, val, temp + 0.25 * (slot % 4) AS temp FROM fx_joint)"


@query("temp_fit_fraction", _descent_sql(1e-4, 200, rows=_QUARTERS), ("fx_joint",))
def temp_fit_fraction(spark, sf):
    """Temperatures with a fraction of their unit."""
    rows = fx.joint(spark, sf).withColumn("temp", F.col("temp") + 0.25 * (F.col("slot") % 4))
    return rounded(temp_response.fit(rows, K, alpha=1e-4, nmax=200), *temp_response.PARAMS, "cost", places=4)


def _init_sql(temp: bool) -> str:
    resid = "val - (0.4 * greatest(temp - 200, 0) + 0.6 * greatest(150 - temp, 0))" if temp else "val"
    level = "first_value(y) OVER w" if temp else "avg(y) OVER p"
    return f"""i0 AS (SELECT series, rn, ts, {resid} AS y FROM fx_joint WHERE rn < {NINIT}),
    i1 AS (SELECT *, {level} AS lv, (last_value(y) OVER w - first_value(y) OVER w) / {NINIT} AS b FROM i0
        WINDOW w AS (PARTITION BY series ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING),
        p AS (PARTITION BY series)),
    i2 AS (SELECT series, lv, b, CAST(isodow(ts) >= 6 AS INTEGER) AS weekend, CAST(hour(ts) AS INTEGER) AS hour,
        avg(y - lv - b * rn) AS s FROM i1 GROUP BY ALL)"""


_INIT_OUT = f"SELECT series, {r('lv', 'lv')}, {r('b', 'b')}, weekend, hour, {r('s', 's')} FROM i2"


@query("smooth_init", f"WITH {_init_sql(False)} {_INIT_OUT}", ("fx_joint",))
def smooth_init(spark, sf):
    state = smoothing.init_state(fx.joint(spark, sf), K, ninit=NINIT)
    return rounded(smoothing.profile_rows(state, K), "lv", "b", "s")


@query("smooth_init_temp", f"WITH {_init_sql(True)} {_INIT_OUT}", ("fx_joint",))
def smooth_init_temp(spark, sf):
    state = smoothing.init_state(fx.joint(spark, sf), K, temp="temp", params=TEMP_RATES, ninit=NINIT)
    return rounded(smoothing.profile_rows(state, K), "lv", "b", "s")


@query("dayahead_static", f"""WITH {_init_sql(False)} SELECT j.series, ts, {r('lv + b * (slot % 24) + s', 'pred')} FROM fx_joint j
    JOIN i2 ON i2.series = j.series AND i2.hour = hour(ts) AND i2.weekend = CAST(isodow(ts) >= 6 AS INTEGER)""", ("fx_joint",))
def dayahead_static(spark, sf):
    rows = fx.joint(spark, sf)
    out = smoothing.dayahead_static(rows, smoothing.init_state(rows, K, ninit=NINIT), K)
    return rounded(out.select("series", "ts", "pred"), "pred")


_STATE0 = """st AS (SELECT series, any_value(lv) AS lv, any_value(b) AS b, list(s ORDER BY hour) FILTER (weekend = 0) AS s0,
    list(s ORDER BY hour) FILTER (weekend = 1) AS s1 FROM i2 GROUP BY series)"""


def _walk_ctes(p: Params, temp: bool, cands: list[Params] | None = None, name: str = "walk", own: str | None = None,
               hours: str = "fx_joint") -> str:
    """`d`: whole days as lists; `walk`: state after each day, with that day's prediction and trend. With `cands`
    every series is walked once per candidate, whose rates are carried along as columns. `own` names a table of candidates by
    series; then only the walk is returned, under `name`. `hours` are the rows walked; a day with a missing one corrects nothing."""
    tpart = "0.4 * greatest(temp - 200, 0) + 0.6 * greatest(150 - temp, 0)" if temp else "0.0::DOUBLE"
    el = "eps[1]" if temp else "list_avg(eps)"
    rates = {n: f"{getattr(p, n)}::DOUBLE" for n in ("alpha", "beta", "g00", "g01", "g10", "g11")}
    carry, carry_w, source = "", "", "st"
    if cands or own:
        carry = "cand, alpha, beta, g00, g11, "
        carry_w = "w.cand, w.alpha, w.beta, w.g00, w.g11, "
        rates |= {n: n for n in ("alpha", "beta", "g00", "g11")}
        source = f"st JOIN {own} USING (series)"
    if cands:
        rows = ", ".join(f"({i}, {c.alpha}::DOUBLE, {c.beta}::DOUBLE, {c.g00}::DOUBLE, {c.g11}::DOUBLE)"
                         for i, c in enumerate(cands))
        source = f"st, (VALUES {rows}) c(cand, alpha, beta, g00, g11)"
    flat = "(eps[i] - el - eb * (i - 1))"
    days = f"""{_init_sql(temp)}, {_STATE0},
    d AS (SELECT series, rn // 24 AS day, list(val - ({tpart}) ORDER BY rn) AS y, list(({tpart}) ORDER BY rn) AS tt,
        list(ts ORDER BY rn) AS tss, list(val ORDER BY rn) AS vs, any_value(isodow(ts) >= 6) AS we FROM {hours} GROUP BY ALL HAVING count(*) = 24),
    """
    return f"""{"" if own else days}{name} AS (
        SELECT series, {carry}CAST({NINIT // 24 - 1} AS BIGINT) AS day, lv, b, s0, s1, CAST([] AS DOUBLE[]) AS pred, CAST([] AS DOUBLE[]) AS trend
        FROM {source}
        UNION ALL
        SELECT series, {carry}day, lv + {rates['alpha']} * el AS lv, b + {rates['beta']} * eb AS b,
            list_transform(range(1, 25), lambda i: s0[i] + (CASE WHEN we THEN {rates['g01']} ELSE {rates['g00']} END) * {flat}) AS s0,
            list_transform(range(1, 25), lambda i: s1[i] + (CASE WHEN we THEN {rates['g11']} ELSE {rates['g10']} END) * {flat}) AS s1, pred, trend
        FROM (SELECT *, (eps[24] - eps[1]) / 24 AS eb FROM (SELECT *, {el} AS el FROM (
            SELECT *, list_transform(range(1, 25), lambda i: CASE WHEN len(list_filter(y, lambda v: v IS NULL)) > 0 THEN 0 ELSE y[i] - pred[i] END) AS eps FROM (
            SELECT w.series, {carry_w}d.day, w.lv, w.b, w.s0, w.s1, d.y, d.we,
                list_transform(range(1, 25), lambda i: w.lv + w.b * (i - 1)) AS trend,
                list_transform(range(1, 25), lambda i: w.lv + w.b * (i - 1) + (CASE WHEN d.we THEN w.s1[i] ELSE w.s0[i] END)) AS pred
            FROM {name} w JOIN d ON d.series = w.series AND d.day = w.day + 1)))))"""


_HOURS = "(SELECT unnest(range(1, 25)) AS i)"


def _walk_sql(p: Params, temp: bool, columns: str, hours: str = "fx_joint") -> str:
    return f"""WITH RECURSIVE {_walk_ctes(p, temp, hours=hours)} SELECT w.series, d.tss[i] AS ts, {columns} FROM walk w
    JOIN d ON d.series = w.series AND d.day = w.day, {_HOURS} WHERE w.day >= {NINIT // 24}"""


_PRED = f"d.vs[i] AS val, {r('w.pred[i] + d.tt[i]', 'pred', 5)}"


@query("walk_forward", _walk_sql(RATES, False, _PRED), ("fx_joint",))
def walk_forward(spark, sf):
    out = smoothing.walk_forward(fx.joint(spark, sf), K, RATES, ninit=NINIT)
    return rounded(smoothing.wall_ts(out).select("series", "ts", "val", "pred"), "pred", places=5)


_HOLES = f"(SELECT * REPLACE (CASE WHEN rn < {NINIT} OR rn % 53 <> 7 THEN val END AS val) FROM fx_joint)"


@query("walk_forward_holes", _walk_sql(RATES, False, f"d.vs[i] AS val, {r('w.pred[i]', 'pred', 5)}", _HOLES), ("fx_joint",))
def walk_forward_holes(spark, sf):
    """Hours are missing after the first stretch: their days are predicted but correct nothing."""
    rows = fx.joint(spark, sf)
    spans = grid.series_stats(rows, K).withColumnsRenamed({"lo": "begin", "hi": "end"})
    place = F.col("slot") - F.col("begin")
    holed = rows.join(spans, K).withColumn("val", F.when((place < NINIT) | (place % 53 != 7), F.col("val"))).drop("begin", "end")
    out = smoothing.walk_forward(holed, K, RATES, ninit=NINIT)
    return rounded(smoothing.wall_ts(out).select("series", "ts", "val", "pred"), "pred", places=5)


@query("walk_forward_temp", _walk_sql(TEMP_RATES, True, _PRED), ("fx_joint",))
def walk_forward_temp(spark, sf):
    out = smoothing.walk_forward(fx.joint(spark, sf), K, TEMP_RATES, temp="temp", ninit=NINIT)
    return rounded(smoothing.wall_ts(out).select("series", "ts", "val", "pred"), "pred", places=5)


#: Days by which the fixture is moved into the weeks of a clock change.
SHIFTS = {"spring": 50, "autumn": 290}


def _local_sql(shift: int, p: Params = RATES) -> str:
    """The walk over local days of US Pacific time in 2024: lists of 23, 24 or 25 hours with their clock times."""
    def season(kind: int) -> str:
        rate = f"CASE WHEN we THEN {getattr(p, f'g{kind}1')} ELSE {getattr(p, f'g{kind}0')} END"
        left = "(eps[i] - el - eb * (i - 1))"
        return f"""list_transform(range(1, 25), lambda k: s{kind}[k] + ({rate}) * coalesce(list_avg(list_transform(
            list_filter(range(1, n + 1), lambda i: hs[i] = k - 1), lambda i: {left})), 0)) AS s{kind}"""

    return f"""WITH RECURSIVE u AS (SELECT series, ts + INTERVAL {shift} DAY AS ts, val FROM fx_joint),
    m AS (SELECT *, CAST(lts AS DATE) AS day, CAST(hour(lts) AS INTEGER) AS hour FROM (SELECT *, ts - to_hours(CASE
        WHEN ts >= TIMESTAMP '2024-03-10 10:00:00' AND ts < TIMESTAMP '2024-11-03 09:00:00' THEN 7 ELSE 8 END) AS lts FROM u)),
    w AS (SELECT m.*, date_diff('day', first, day) AS dn, row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS pos, isodow(day) >= 6 AS we
        FROM m JOIN (SELECT series, min(day) FILTER (hour = 0) AS first FROM m GROUP BY series) USING (series) WHERE day >= first),
    i1 AS (SELECT *, avg(val) OVER p AS lv, (last_value(val) OVER q - first_value(val) OVER q) / count(*) OVER p AS b FROM w
        WHERE dn < {NINIT // 24} WINDOW p AS (PARTITION BY series),
        q AS (PARTITION BY series ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
    i2 AS (SELECT series, lv, b, we, hour, avg(val - lv - b * pos) AS s FROM i1 GROUP BY ALL),
    st AS (SELECT series, any_value(lv) AS lv, any_value(b) AS b, list(s ORDER BY hour) FILTER (NOT we) AS s0,
        list(s ORDER BY hour) FILTER (we) AS s1 FROM i2 GROUP BY series),
    d AS (SELECT series, dn, list(val ORDER BY ts) AS y, list(hour ORDER BY ts) AS hs, list(ts ORDER BY ts) AS tss, any_value(we) AS we,
        count(*) AS n FROM w WHERE dn >= {NINIT // 24} GROUP BY ALL),
    walk AS (
        SELECT series, CAST({NINIT // 24 - 1} AS BIGINT) AS dn, lv, b, s0, s1, CAST([] AS DOUBLE[]) AS pred FROM st
        UNION ALL
        SELECT series, dn, lv + {p.alpha} * el, b + {p.beta} * eb, {season(0)}, {season(1)}, pred
        FROM (SELECT *, list_avg(eps) AS el, (eps[n] - eps[1]) / n AS eb FROM (
            SELECT *, list_transform(range(1, n + 1), lambda i: y[i] - pred[i]) AS eps FROM (
            SELECT w.series, d.dn, w.lv, w.b, w.s0, w.s1, d.y, d.hs, d.we, d.n, list_transform(range(1, d.n + 1), lambda i: w.lv + w.b * (i - 1)
                + CASE WHEN d.we THEN w.s1[d.hs[i] + 1] ELSE w.s0[d.hs[i] + 1] END) AS pred
            FROM walk w JOIN d ON d.series = w.series AND d.dn = w.dn + 1))))
    SELECT series, ts, hour, val, {r('pred', 'pred', 5)} FROM (SELECT w.series, unnest(d.tss) AS ts, unnest(d.hs) AS hour, unnest(d.y) AS val,
        unnest(w.pred) AS pred FROM walk w JOIN d ON d.series = w.series AND d.dn = w.dn)"""


def _walk_local(spark, sf, shift: int):
    rows = fx.joint(spark, sf).withColumn("slot", F.col("slot") + 24 * shift)
    out = localdays.walk_forward_local(rows, K, "US/Pacific", RATES, init_days=NINIT // 24)
    return rounded(smoothing.wall_ts(out).select("series", "ts", "hour", "val", "pred"), "pred", places=5)


@query("walk_forward_local_spring", _local_sql(SHIFTS["spring"]), ("fx_joint",))
def walk_forward_local_spring(spark, sf):
    """Local days across a day of 23 hours."""
    return _walk_local(spark, sf, SHIFTS["spring"])


@query("walk_forward_local_autumn", _local_sql(SHIFTS["autumn"]), ("fx_joint",))
def walk_forward_local_autumn(spark, sf):
    """Local days across a day of 25 hours."""
    return _walk_local(spark, sf, SHIFTS["autumn"])


@query("walk_components", _walk_sql(TEMP_RATES, True, ", ".join([
    r("w.trend[i]", "trend", 5), r("w.pred[i]", "trend_season", 5), r("d.y[i]", "net", 5)])), ("fx_joint",))
def walk_components(spark, sf):
    """Trend, trend with season, and demand less its temperature response, as the update loop leaves them."""
    out = smoothing.walk_forward(fx.joint(spark, sf), K, TEMP_RATES, temp="temp", ninit=NINIT)
    out = smoothing.wall_ts(out).select("series", "ts", "trend", (F.col("trend") + F.col("season")).alias("trend_season"),
                                        (F.col("val") - F.col("temp_part")).alias("net"))
    return rounded(out, "trend", "trend_season", "net", places=5)


@query("onestep", f"""WITH RECURSIVE {_init_sql(False)}, {_STATE0},
    d AS (SELECT series, rn, ts, val, CAST(hour(ts) AS INTEGER) + 1 AS h, isodow(ts) >= 6 AS we FROM fx_joint),
    walk AS (
        SELECT series, CAST({NINIT - 1} AS BIGINT) AS rn, NULL::TIMESTAMP AS ts, NULL::DOUBLE AS val, lv, b, s0, s1, NULL::DOUBLE AS pred FROM st
        UNION ALL
        SELECT series, rn, ts, val, lv + b + {RATES.alpha} * eps, b + {RATES.beta} * eps,
            list_transform(range(1, 25), lambda i: s0[i] + CASE WHEN i = h THEN (CASE WHEN we THEN {RATES.g01} ELSE {RATES.g00} END) * eps ELSE 0 END),
            list_transform(range(1, 25), lambda i: s1[i] + CASE WHEN i = h THEN (CASE WHEN we THEN {RATES.g11} ELSE {RATES.g10} END) * eps ELSE 0 END), pred
        FROM (SELECT *, val - pred AS eps FROM (SELECT w.series, d.rn, d.ts, d.val, d.h, d.we, w.lv, w.b, w.s0, w.s1,
            w.lv + (CASE WHEN d.we THEN w.s1[d.h] ELSE w.s0[d.h] END) AS pred FROM walk w JOIN d ON d.series = w.series AND d.rn = w.rn + 1)))
    SELECT series, ts, val, {r('pred', 'pred', 4)} FROM walk WHERE rn >= {NINIT}""", ("fx_joint",))
def onestep(spark, sf):
    out = smoothing.walk_forward(fx.joint(spark, sf), K, RATES, ninit=NINIT, mode="hour")
    return rounded(smoothing.wall_ts(out).select("series", "ts", "val", "pred"), "pred", places=4)


def _search_sql() -> str:
    candidates = rate_grid(RATES)
    fixed = ", ".join(f"{getattr(RATES, n)}::DOUBLE AS \"{n}\"" for n in ("g01", "g10", "An", "Ap", "Tn", "Tp"))
    return f"""WITH RECURSIVE {_walk_ctes(RATES, False, candidates)},
    e AS (SELECT w.series, w.cand, w.alpha, w.beta, w.g00, w.g11, sqrt(sum((w.pred[i] - d.vs[i]) ** 2) / count(*)) AS e FROM walk w
        JOIN d ON d.series = w.series AND d.day = w.day, {_HOURS} WHERE w.day >= {NINIT // 24} GROUP BY ALL)
    SELECT series, cand, {r('e', 'rmse', 4)}, alpha, beta, g00, g11, {fixed} FROM e
    QUALIFY row_number() OVER (PARTITION BY series ORDER BY e, cand) = 1"""


@query("rate_search", _search_sql(), ("fx_joint",))
def rate_search(spark, sf):
    out = smoothing.rate_search(fx.joint(spark, sf), K, rate_grid(RATES), ninit=NINIT)
    return rounded(out, "rmse", places=4)


_REFINED = ("alpha", "beta", "g00", "g11")
REFINED_ROUNDS, REFINED_LR, REFINED_ETA = 2, 0.05, 0.001


def _refined_sql() -> str:
    """The best of the grid, then rounds of finite differences: q0, q1, ... hold each series' present set, its best and their costs."""
    def nudge(n: str) -> str:
        return f"(CASE WHEN n_{n} = 0 THEN {REFINED_ETA} ELSE {REFINED_ETA} * n_{n} END)"

    def step(i: int, n: str) -> str:
        slope = f"((js[{i + 2}] - js[1]) / {nudge(n)})"
        to = f"n_{n} - lr * ({slope} - trunc({slope}))"
        return f"CASE WHEN {to} > 1 THEN least(n_{n} + 0.5 * (1 - n_{n}), 0.99) WHEN {to} < 0 THEN 0.25 * n_{n} ELSE {to} END"

    fixed = ", ".join(f"{getattr(RATES, n)}::DOUBLE AS \"{n}\"" for n in ("g01", "g10", "An", "Ap", "Tn", "Tp"))
    parts = [_walk_ctes(RATES, False, rate_grid(RATES)), f"""e AS (SELECT w.series, w.cand, w.alpha, w.beta, w.g00, w.g11,
        sqrt(sum((w.pred[i] - d.vs[i]) ** 2) / count(*)) AS e FROM walk w JOIN d ON d.series = w.series AND d.day = w.day, {_HOURS}
        WHERE w.day >= {NINIT // 24} GROUP BY ALL),
    q0 AS (SELECT series, {", ".join(f"{n} AS n_{n}, {n} AS b_{n}" for n in _REFINED)}, NULL::DOUBLE AS cost, {REFINED_LR}::DOUBLE AS lr FROM e
        QUALIFY row_number() OVER (PARTITION BY series ORDER BY e, cand) = 1)"""]
    for t in range(REFINED_ROUNDS + 1):
        nudged = ", ".join(f"n_{n} + CASE WHEN cand = {i} THEN {nudge(n)} ELSE 0 END AS {n}" for i, n in enumerate(_REFINED, 1))
        better, back = "cost IS NULL OR js[1] < cost", "js[1] > 1.2 * cost"
        moves = ", ".join([*(f"CASE WHEN NOT ({better}) AND {back} THEN b_{n} ELSE {step(i, n)} END AS n_{n}" for i, n in enumerate(_REFINED)),
                           *(f"CASE WHEN {better} THEN n_{n} ELSE b_{n} END AS b_{n}" for n in _REFINED)])
        parts += [f"c{t} AS (SELECT series, cand, {nudged} FROM q{t}, (SELECT unnest(range({1 if t == REFINED_ROUNDS else 1 + len(_REFINED)})) AS cand))",
                  _walk_ctes(RATES, False, name=f"walk{t}", own=f"c{t}"),
                  f"""j{t} AS (SELECT series, list(e ORDER BY cand) AS js FROM (SELECT w.series, w.cand,
        sqrt(sum((w.pred[i] - d.vs[i]) ** 2) / count(*)) AS e FROM walk{t} w JOIN d ON d.series = w.series AND d.day = w.day, {_HOURS}
        WHERE w.day >= {NINIT // 24} GROUP BY ALL) GROUP BY series)""",
                  f"""q{t + 1} AS (SELECT series, {moves}, CASE WHEN {better} THEN js[1] ELSE cost END AS cost,
        CASE WHEN NOT ({better}) AND {back} THEN 0.8 * lr ELSE lr END AS lr FROM q{t} JOIN j{t} USING (series))"""]
    return f"""WITH RECURSIVE {", ".join(parts)} SELECT series, {r('cost', 'rmse', 4)}, {REFINED_ROUNDS + 1} AS rounds,
        {", ".join(r(f'b_{n}', n, 4) for n in _REFINED)}, {fixed} FROM q{REFINED_ROUNDS + 1}"""


@query("rate_search_refined", _refined_sql(), ("fx_joint",))
def rate_search_refined(spark, sf):
    """Descent of each series from its best set of the grid."""
    rows = fx.joint(spark, sf)
    best = smoothing.rate_search(rows, K, rate_grid(RATES), ninit=NINIT)
    out = smoothing.rate_search_refined(rows, K, best, list(_REFINED), REFINED_ROUNDS, ninit=NINIT, lr=REFINED_LR, eta=REFINED_ETA, rtol=0.0)
    return rounded(out, "rmse", *_REFINED, places=4)


@query("rate_gradient", f"""WITH g AS (SELECT *, first_value(eps) OVER w AS level,
        (last_value(eps) OVER w - first_value(eps) OVER w) / 23 * (slot % 24) AS grad FROM (
            SELECT *, fore - val AS eps, CAST(isodow(ts) >= 6 AS INTEGER) AS we FROM fx_joint)
        WINDOW w AS (PARTITION BY series, slot // 24 ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
    b AS (SELECT *, lag(level, 24) OVER p AS lb, lag(grad, 24) OVER p AS gb, lag(we, 24) OVER p AS wb,
        lag(eps - level - grad, 24) OVER p AS eb FROM g WINDOW p AS (PARTITION BY series ORDER BY rn))
    SELECT series, {r(f'sum(eps * lb) FILTER (rn >= {NINIT + 24}) / (max(n) - {NINIT})', 'd_alpha', 4)},
    {r(f'sum(eps * gb) FILTER (rn >= {NINIT + 24}) / (max(n) - {NINIT})', 'd_beta', 4)},
    {", ".join(r(f'coalesce(sum(eb) FILTER (rn >= {NINIT + 24} AND we = {i} AND wb = {j}), 0) / (max(n) - {NINIT})', f'd_g{i}{j}') for i in (0, 1) for j in (0, 1))},
    {r(f'coalesce(sum((temp - 200) * eps) FILTER (rn >= {NINIT} AND temp > 200), 0) / (max(n) - {NINIT})', '"d_Ap"', 4)},
    {r(f'coalesce(sum((150 - temp) * eps) FILTER (rn >= {NINIT} AND temp < 150), 0) / (max(n) - {NINIT})', '"d_An"', 4)},
    {r(f'coalesce(-0.4 * sum(eps) FILTER (rn >= {NINIT} AND temp > 200), 0) / (max(n) - {NINIT})', '"d_Tp"')},
    {r(f'coalesce(0.6 * sum(eps) FILTER (rn >= {NINIT} AND temp < 150), 0) / (max(n) - {NINIT})', '"d_Tn"')}
    FROM b GROUP BY series""", ("fx_joint",))
def rate_gradient(spark, sf):
    out = smoothing.rate_gradient(fx.joint(spark, sf), K, TEMP_RATES, pred="fore", ninit=NINIT)
    out = rounded(out, "d_g00", "d_g01", "d_g10", "d_g11", "d_Tp", "d_Tn")
    return rounded(out, "d_alpha", "d_beta", "d_Ap", "d_An", places=4)


def _detrend_sql(segment: int, width: float, smooth: int) -> str:
    """The same filter with a plain discrete transform per segment (even lengths), one step per peak."""
    wave = f"2 * {pi!r}::DOUBLE * (((j - n // 2) * m) % n) / n"
    sign = "(CASE WHEN abs(j - n // 2) % 2 = 0 THEN 1 ELSE -1 END)"
    steps, last = [], "p0"
    centres = [0.0] + [s * f for f in [1.0, 2.0] + [i / 7 for i in range(1, 6)] for s in (1, -1)]
    for i, f in enumerate(centres, start=1):
        dist, w = f"abs(j - n // 2 - ({f!r}::DOUBLE * n / 24))", f"({width}::DOUBLE * n / 24)"

        def part(c: str) -> str:
            return f"(CASE WHEN {dist} < {w} - 1e-9 THEN {c}[j + 1] - m{c} ELSE 0 END)"

        steps.append(f"""q{i} AS (SELECT *, list_avg(list_transform(ring, lambda j: rr[j + 1])) AS mrr,
                list_avg(list_transform(ring, lambda j: ri[j + 1])) AS mri FROM (
                SELECT *, list_filter(range(0, n), lambda j: {dist} < 1.5 * {w} - 1e-9 AND {dist} >= {w} - 1e-9) AS ring FROM {last})),
            p{i} AS (SELECT series, g, n, x, tss, list_transform(range(0, n), lambda j: rr[j + 1] - {part('rr')}) AS rr,
                list_transform(range(0, n), lambda j: ri[j + 1] - {part('ri')}) AS ri,
                list_transform(range(0, n), lambda j: tr[j + 1] + {part('rr')}) AS tr,
                list_transform(range(0, n), lambda j: ti[j + 1] + {part('ri')}) AS ti FROM q{i})""")
        last = f"p{i}"

    def smoothed(t: str, rest: str) -> str:
        return f"""list_transform(range(0, n), lambda j: {t}[j + 1] + CASE WHEN j >= {smooth} AND j < n - {smooth}
            THEN list_sum({rest}[j - {smooth} + 2 : j + {smooth} + 1]) / {2 * smooth} ELSE 0 END)"""

    return f"""WITH seg AS (SELECT series, least(rn // {segment}, greatest(n // {segment}, 1) - 1) AS g, count(*) AS n, list(val ORDER BY slot) AS x, list(ts ORDER BY slot) AS tss
        FROM fx_joint GROUP BY ALL),
    p0 AS (SELECT *, list_transform(range(0, n), lambda j: {sign} * list_sum(list_transform(range(0, n), lambda m: x[m + 1] * cos({wave})))) AS rr,
        list_transform(range(0, n), lambda j: -{sign} * list_sum(list_transform(range(0, n), lambda m: x[m + 1] * sin({wave})))) AS ri,
        list_transform(range(0, n), lambda j: 0.0::DOUBLE) AS tr, list_transform(range(0, n), lambda j: 0.0::DOUBLE) AS ti FROM seg),
    {", ".join(steps)},
    f AS (SELECT *, {smoothed('tr', 'rr')} AS fr, {smoothed('ti', 'ri')} AS fi FROM {last}),
    o AS (SELECT *, list_transform(range(0, n), lambda m: list_sum(list_transform(range(0, n), lambda j:
        {sign} * (fr[j + 1] * cos({wave}) - fi[j + 1] * sin({wave})))) / n) AS trend FROM f)
    SELECT series, tss[i + 1] AS ts, x[i + 1] AS val, {r('trend[i + 1]', 'trend', 5)}, {r('x[i + 1] - trend[i + 1]', 'detrend', 5)}
    FROM (SELECT *, unnest(range(0, n)) AS i FROM o)"""


@query("fft_detrend", _detrend_sql(720, 0.2, 10), ("fx_joint",))
def fft_detrend(spark, sf):
    out = spectral.fft_detrend(fx.joint(spark, sf), K, width=0.2, smooth=10, segment=720)
    return rounded(smoothing.wall_ts(out).select("series", "ts", "val", "trend", "detrend"), "trend", "detrend", places=5)


_BINS = [0, 1, 4, 9, 30, 60]


@query("power_bins", f"""WITH k AS (SELECT CAST(unnest({_BINS}) AS INTEGER) AS bin),
    z AS (SELECT series, bin, any_value(n) AS n, sum(val * val) AS e, sum(val * cos(2 * {pi!r}::DOUBLE * ((rn * bin) % n) / n)) AS re,
        sum(val * sin(2 * {pi!r}::DOUBLE * ((rn * bin) % n) / n)) AS im FROM fx_joint, k GROUP BY series, bin)
    SELECT series, bin, {r('bin * 24.0 / n', 'freq')}, {r('(re * re + im * im) / (n * e)', 'power', 8)} FROM z""", ("fx_joint",))
def power_bins(spark, sf):
    out = spectral.power_bins(fx.joint(spark, sf), K, _BINS)
    return rounded(rounded(out, "freq"), "power", places=8)


def _regression_steps() -> str:
    """Least squares by Gram-Schmidt: each regressor is removed from all later columns with weights from the training
    rows, on every row; what is left of the target is the prediction's error."""
    cols = ["one", *features.FEATURES, "y"]
    steps = [f"""g0 AS (SELECT *, part = 'train' AS fit, 1.0::DOUBLE AS one, val AS y FROM (SELECT series, ts, val, rn,
        CASE WHEN rn < n // 2 THEN 'train' ELSE 'test' END AS part, hour(ts) / 23.0::DOUBLE AS hour_frac,
        (isodow(ts) - 1) / 6.0::DOUBLE AS week_frac, dayofyear(ts) / (364.0::DOUBLE + CASE WHEN year(ts) % 4 = 0 AND
        (year(ts) % 100 <> 0 OR year(ts) % 400 = 0) THEN 1 ELSE 0 END) AS year_frac, CAST(temp AS DOUBLE) AS temp,
        lag(val, 24) OVER p AS l_day, lag(val, 24) OVER p - lag(val, 25) OVER p AS d_day, lag(val, 168) OVER p AS l_week
        FROM fx_joint WINDOW p AS (PARTITION BY series ORDER BY rn)) WHERE l_week IS NOT NULL)"""]
    for i, c in enumerate(cols[:-1], start=1):
        left = ", ".join(f"""{o} - {c} * (sum({o} * {c}) FILTER (fit) OVER (PARTITION BY series)
            / sum({c} * {c}) FILTER (fit) OVER (PARTITION BY series)) AS {o}""" for o in cols[i:])
        steps.append(f"g{i} AS (SELECT series, ts, part, fit, val, {left} FROM g{i - 1})")
    return ", ".join([*steps, f"learned AS (SELECT * FROM g{len(cols) - 1})"])


def _regression_sql() -> str:
    return f"""WITH {_regression_steps()} SELECT series, part, count(*) AS n, {r('sqrt(sum(y * y) / count(*))', 'rmse', 4)},
        {r('avg(abs(y / val)) FILTER (val <> 0)', 'mape', 4)} FROM learned GROUP BY ALL"""


@query("lag_regression", _regression_sql(), ("fx_joint",))
def lag_regression(spark, sf):
    rows = features.lag_regression(fx.joint(spark, sf), K).where("pred is not null")
    out = rows.groupBy("series", "part").agg(F.count(F.lit(1)).alias("n"),
                                             stats.rmse(F.col("pred"), F.col("val")).alias("rmse"),
                                             stats.mape(F.col("pred"), F.col("val")).alias("mape"))
    return rounded(out, "rmse", "mape", places=4)


_SCORED = """s AS (SELECT series, ts, rn, val, CASE WHEN rn < n // 2 THEN 'train' ELSE 'test' END AS part, fore,
        CASE WHEN rn < n // 2 OR rn >= n // 2 + 24 THEN lag(val, 24) OVER (PARTITION BY series ORDER BY rn) END AS persist FROM fx_joint),
    l AS (SELECT *, 'utility' AS method, fore AS pred FROM s UNION ALL SELECT *, 'persistence', persist FROM s)"""


def _score_sql(group: str) -> str:
    return f"""WITH {_SCORED} SELECT {group}, method, count(*) AS n, {r('sqrt(sum((pred - val) ** 2) / count(*))', 'rmse')},
        {r('avg(abs(1 - pred / val)) FILTER (val <> 0)', 'mape')} FROM l WHERE pred IS NOT NULL GROUP BY ALL"""


_METHODS = {"fore": "utility", "persist": "persistence"}


@query("scoreboard", _score_sql("series, part"), ("fx_joint",))
def scoreboard(spark, sf):
    rows = series.persistence(fx.joint(spark, sf), K)
    return rounded(score.scoreboard(rows, ["series", "part"], "val", _METHODS), "rmse", "mape")


@query("scoreboard_by_hour", _score_sql("CAST(hour(ts) AS INTEGER) AS hour"), ("fx_joint",))
def scoreboard_by_hour(spark, sf):
    rows = series.persistence(fx.joint(spark, sf), K).withColumn("hour", F.hour("ts"))
    return rounded(score.scoreboard(rows, ["hour"], "val", _METHODS), "rmse", "mape")


def _models_sql(group: str) -> str:
    return f"""WITH RECURSIVE {_walk_ctes(RATES, False)}, {_regression_steps()},
    base AS (SELECT *, CASE WHEN rn < n // 2 THEN 'train' ELSE 'test' END AS part,
        CASE WHEN rn < n // 2 OR rn >= n // 2 + 24 THEN lag(val, 24) OVER (PARTITION BY series ORDER BY rn) END AS persist FROM fx_joint),
    smooth AS (SELECT w.series, d.tss[i] AS ts, w.pred[i] AS pred FROM walk w JOIN d ON d.series = w.series AND d.day = w.day, {_HOURS}
        WHERE w.day >= {NINIT // 24}),
    l AS (SELECT series, ts, rn, part, val, 'persistence' AS method, persist AS pred FROM base
        UNION ALL SELECT series, ts, rn, part, val, 'utility', fore FROM base
        UNION ALL SELECT b.series, b.ts, rn, b.part, b.val, 'smoothing', m.pred FROM base b JOIN smooth m ON m.series = b.series AND m.ts = b.ts
        UNION ALL SELECT b.series, b.ts, rn, b.part, b.val, 'regression', b.val - g.y FROM base b JOIN learned g ON g.series = b.series AND g.ts = b.ts)
    SELECT {group}, method, count(*) AS n, {r('sqrt(sum((pred - val) ** 2) / count(*))', 'rmse', 4)},
        {r('avg(abs(1 - pred / val)) FILTER (val <> 0)', 'mape', 4)} FROM l WHERE pred IS NOT NULL AND rn >= {NINIT} GROUP BY ALL"""


def _models(spark, sf, by=None):
    from gridspark.plans import forecast

    out = forecast.day_ahead_scores(fx.joint(spark, sf), K, RATES, NINIT, forecast="fore", regress="temp", by=by)
    return rounded(out, "rmse", "mape", places=4)


@query("scoreboard_models", _models_sql("series, part"), ("fx_joint",))
def scoreboard_models(spark, sf):
    """Utility, persistence, smoothing and lag regression over the same hours, per series and half."""
    return _models(spark, sf)


@query("scoreboard_models_by_hour", _models_sql("CAST(hour(ts) AS INTEGER) AS hour"), ("fx_joint",))
def scoreboard_models_by_hour(spark, sf):
    return _models(spark, sf, [F.hour("ts").alias("hour")])


def _clean_forecast_sql() -> str:
    from gridspark.catalog.series_queries import _extremes_sql, _remove_na_sql

    filled = _remove_na_sql(24).replace("fx_dirty", "fx_common")
    averaged = _extremes_sql(24).replace("fx_dirty", "filled_at")
    walk = _walk_ctes(RATES, False).replace("fx_joint", "clean")
    return f"""WITH RECURSIVE filled AS ({filled}),
    filled_at AS (SELECT f.series, f.ts, f.val, c.rn, c.n FROM filled f JOIN fx_common c ON c.series = f.series AND c.ts = f.ts),
    averaged AS ({averaged}),
    clean AS (SELECT a.series, a.ts, a.val, c.rn, c.n, 0 AS temp FROM averaged a JOIN fx_common c ON c.series = a.series AND c.ts = a.ts),
    {walk},
    model AS (SELECT w.series, d.tss[i] AS ts, w.pred[i] AS pred FROM walk w JOIN d ON d.series = w.series AND d.day = w.day, {_HOURS}
        WHERE w.day >= {NINIT // 24}),
    base AS (SELECT *, CASE WHEN rn < n // 2 THEN 'train' ELSE 'test' END AS part,
        CASE WHEN rn < n // 2 OR rn >= n // 2 + 24 THEN lag(val, 24) OVER (PARTITION BY series ORDER BY rn) END AS persist FROM clean),
    l AS (SELECT b.series, part, val, 'persistence' AS method, persist AS pred FROM base b WHERE rn >= {NINIT}
        UNION ALL SELECT b.series, part, val, 'smoothing', m.pred FROM base b JOIN model m ON m.series = b.series AND m.ts = b.ts)
    SELECT series, part, method, count(*) AS n, {r('sqrt(sum((pred - val) ** 2) / count(*))', 'rmse', 4)},
        {r('avg(abs(1 - pred / val)) FILTER (val <> 0)', 'mape', 4)} FROM l WHERE pred IS NOT NULL GROUP BY ALL"""


@query("clean_forecast_scores", _clean_forecast_sql(), ("fx_common",))
def clean_forecast_scores(spark, sf):
    """Raw hourly rows cleaned, forecast and scored in one plan."""
    from gridspark.plans import forecast

    clean = forecast.clean(fx.hourly(spark, sf), K, {"val": 24}, common=True)
    out = forecast.day_ahead_scores(clean, K, RATES, NINIT)
    return rounded(out, "rmse", "mape", places=4)
