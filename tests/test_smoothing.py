from dataclasses import asdict, replace

import numpy as np
import pandas as pd
import pytest
from helpers import MONDAY, frame, same, values
from pyspark.sql import functions as F

from gridspark.models import features, smoothing, temp_response
from gridspark.models.smoothing import Params

K = ["series"]
P = Params(alpha=0.2, beta=0.05, g00=0.3, g01=0.05, g10=0.02, g11=0.25, An=0.5, Ap=0.8, Tn=150.0, Tp=200.0)


def data(days=42, seed=2, n=3):
    rng = np.random.default_rng(seed)
    t = np.arange(days * 24)
    weekend = (t // 24) % 7 >= 5
    y = {f"s{i}": list(100 + 0.01 * t + (10 - 5 * weekend) * np.sin(2 * np.pi * t / 24) + rng.normal(0, 2, len(t)))
         for i in range(n)}
    temp = {k: [int(v) for v in rng.integers(100, 260, len(t))] for k in y}
    return y, temp


def loop_walk(y, t, p, ninit, with_temp, hourly=False):
    """One series, one step at a time, state kept as plain numbers."""
    y = np.array([np.nan if v is None else v for v in y])
    tt = np.array([p.Ap * max(v - p.Tp, 0) + p.An * max(p.Tn - v, 0) for v in t]) if with_temp else np.zeros(len(y))
    net = y - tt
    day_type = [(d % 7 >= 5) * 1 for d in range(len(y) // 24)]
    lv = net[0] if with_temp else net[:ninit].mean()
    b = (net[ninit - 1] - net[0]) / ninit
    s = np.zeros((2, 24))
    for w in (0, 1):
        for h in range(24):
            s[w, h] = np.mean([net[i] - lv - b * i for i in range(ninit) if day_type[i // 24] == w and i % 24 == h])
    g = np.array([[p.g00, p.g01], [p.g10, p.g11]])
    out = []
    for d in range(ninit // 24, len(y) // 24):
        w, day = day_type[d], net[d * 24:(d + 1) * 24]
        if hourly:
            for h in range(24):
                pred = lv + s[w, h]
                eps = 0.0 if np.isnan(day[h]) else day[h] - pred
                lv, b = lv + b + p.alpha * eps, b + p.beta * eps
                s[:, h] += g[:, w] * eps
                out.append(pred + tt[d * 24 + h])
            continue
        pred = lv + b * np.arange(24) + s[w]
        out += list(pred + tt[d * 24:(d + 1) * 24])
        eps = day - pred
        if np.isnan(eps).any():
            continue
        first = eps[0] if with_temp else eps.mean()
        slope = ((eps - first)[-1] - (eps - first)[0]) / 24
        flat = eps - first - slope * np.arange(24)
        lv, b = lv + p.alpha * first, b + p.beta * slope
        s = s + g[:, [w]] * flat
    return out


@pytest.mark.parametrize("mode", ["day", "hour"])
@pytest.mark.parametrize("with_temp", [False, True])
@pytest.mark.parametrize("size", [48, 168, 16128])
def test_walk_forward_is_the_loop(spark, mode, with_temp, size):
    y, temp = data()
    y["s1"][30 * 24 + 5] = None
    p = P if with_temp else replace(P, An=0.0, Ap=0.0)
    df = frame(spark, y, temp=temp)
    out = smoothing.walk_forward(df, K, p, temp="temp" if with_temp else None, ninit=14 * 24, mode=mode, size=size)
    want = {k: loop_walk(y[k], temp[k], p, 14 * 24, with_temp, mode == "hour") for k in y}
    same(values(out, "pred"), want, 1e-7)
    parts = out.withColumn("sum", F.col("trend") + F.col("season") + F.col("temp_part"))
    if mode == "day":
        same(values(parts, "sum"), want, 1e-7)


def test_walk_starts_at_the_first_midnight(spark):
    y, _ = data(30, n=1)
    late = frame(spark, {"s0": y["s0"][7:]}, start=MONDAY + 7)
    got = values(smoothing.walk_forward(late, K, P, ninit=7 * 24), "slot")["s0"]
    assert got[0] == MONDAY + 8 * 24 and got[-1] == MONDAY + 30 * 24 - 1


def test_rate_search_finds_the_grid_minimum(spark):
    y, temp = data(35, n=2)
    grid = [replace(P, alpha=a, beta=b, An=an) for a in (0.05, 0.5) for b in (0.0, 0.3) for an in (0.0, 0.5)]
    best = smoothing.rate_search(frame(spark, y, temp=temp), K, grid, temp="temp", ninit=14 * 24, size=168).collect()
    for row in best:
        scores = [np.sqrt(np.mean((np.array(loop_walk(y[row.series], temp[row.series], p, 14 * 24, True))
                                   - y[row.series][14 * 24:]) ** 2)) for p in grid]
        assert row.cand == int(np.argmin(scores)) and abs(row.rmse - min(scores)) < 1e-7
        assert row.An == grid[row.cand].An


def test_refined_search_never_gets_worse(spark):
    y, _ = data(35, n=2)
    df = frame(spark, y)
    start = [Params()]
    base = {r.series: r.rmse for r in smoothing.rate_search(df, K, start, ninit=14 * 24).collect()}
    fine = smoothing.rate_search(df, K, smoothing.neighbours(Params()), ninit=14 * 24).collect()
    assert all(r.rmse <= base[r.series] + 1e-12 for r in fine)


def test_clip_params():
    p = smoothing.clip_params(Params(alpha=1.5, beta=-1.0, An=-2.0, Tn=260.0, Tp=20.0))
    assert (p.alpha, p.beta, p.An, p.Tn, p.Tp) == (1.0, 0.0, 0.0, 200.0, 100.0)
    assert list(asdict(p)) == smoothing.PARAM_NAMES


def raw_temp_rows(seed=4, n=400):
    rng = np.random.default_rng(seed)
    t = rng.integers(50, 300, n)
    y = 20 + 0.3 * np.maximum(t - 210, 0) + 0.5 * np.maximum(140 - t, 0) + rng.normal(0, 1, n)
    return t, y


def cost(t, y, p):
    a0, ap, an, tp, tn = p
    err = a0 + ap * np.maximum(t - tp, 0) + an * np.maximum(tn - t, 0) - y
    return 0.5 * np.mean(err**2)


def test_temp_gradient_against_finite_differences(spark):
    t, y = raw_temp_rows()
    p = [18.0, 0.2, 0.4, 200.5, 150.5]
    rows = spark.createDataFrame([("a", int(a), float(b)) for a, b in zip(t, y)], "series string, temp int, val double")
    rows = rows.withColumns({n: F.lit(v) for n, v in zip(temp_response.PARAMS, p)})
    got = temp_response.gradient(rows, K).collect()[0]
    for i, n in enumerate(temp_response.PARAMS):
        up, down = list(p), list(p)
        up[i] += 1e-4
        down[i] -= 1e-4
        assert abs((cost(t, y, up) - cost(t, y, down)) / 2e-4 - got["d_" + n]) < 1e-3 * max(1, abs(got["d_" + n]))


def test_temp_fit_is_descent_over_the_raw_rows(spark):
    t, y = raw_temp_rows()
    alpha, rtol, nmax = 1e-4, 1e-6, 50
    slope = 0.5 * (y.max() - y.min()) / (t.max() - t.min())
    p = np.array([y.mean(), slope, slope, t.mean(), t.mean()])
    last = 2 * cost(t, y, p)
    for _ in range(nmax):
        a0, ap, an, tp, tn = p
        err = a0 + ap * np.maximum(t - tp, 0) + an * np.maximum(tn - t, 0) - y
        p = p - alpha * np.array([err.sum(), ((t - tp) * err)[t > tp].sum(), ((tn - t) * err)[t < tn].sum(),
                                  -ap * err[t > tp].sum(), an * err[t < tn].sum()]) / len(t)
        now = 2 * cost(t, y, p)
        if abs(1 - last / now) < rtol:
            break
        last = now
    rows = spark.createDataFrame([("a", int(a), float(b)) for a, b in zip(t, y)], "series string, temp int, val double")
    got = temp_response.fit(rows, K, alpha=alpha, rtol=rtol, nmax=nmax).collect()[0]
    np.testing.assert_allclose([got[n] for n in temp_response.PARAMS], p, rtol=1e-6)


def test_linear_fit_matches_least_squares(spark):
    y, temp = data(35, n=2)
    rows = features.joint_features(frame(spark, y, temp=temp), K, size=168).dropna()
    coefs = {r.series: r.coef for r in features.fit_linear(rows, K, "val", ["temp", "l_day", "l_week"]).collect()}
    pdf = rows.toPandas()
    for k, g in pdf.groupby("series"):
        x = np.column_stack([np.ones(len(g)), g[["temp", "l_day", "l_week"]].to_numpy(float)])
        want = np.linalg.lstsq(x, g["val"].to_numpy(), rcond=None)[0]
        np.testing.assert_allclose(x @ coefs[k], x @ want, rtol=1e-5)


def test_boosted_trees_train_on_all_series(spark):
    y, temp = data(21, n=2)
    rows = features.joint_features(frame(spark, y, temp=temp), K)
    model = features.gbt_forecaster(rows, "val", maxIter=2, maxDepth=3)
    assert model.transform(rows.dropna()).where("pred is not null").count() > 0


def test_holes_at_the_ends_of_the_first_stretch(spark):
    y, _ = data()
    ninit = 14 * 24
    y["s1"][ninit - 1] = y["s1"][0] = None
    y["s2"][:ninit] = [None] * ninit
    df = frame(spark, y)
    state = {r.series: r for r in smoothing.init_state(df, K, ninit=ninit).collect()}
    assert abs(state["s1"].b - (y["s1"][ninit - 2] - y["s1"][1]) / (ninit - 2)) < 1e-12 and state["s2"].lv is None
    walk = smoothing.walk_forward(df, K, P, ninit=ninit)
    assert walk.count() == 3 * (42 * 24 - ninit)
    assert walk.where("pred is null").select("series").distinct().collect() == [("s2",)]
    best = {r.series: r.rmse for r in smoothing.rate_search(df, K, [P, replace(P, alpha=0.4)], ninit=ninit).collect()}
    assert set(best) == {"s0", "s1", "s2"} and best["s2"] is None and best["s1"] > 0


@pytest.mark.parametrize("level", ["mean", "first"])
@pytest.mark.parametrize("weekend", [0, 1])
def test_a_day_in_two_matrices(level, weekend):
    """The maps against the correction written out."""
    rng = np.random.default_rng(5)
    p = np.array([getattr(P, n) for n in smoothing.PARAM_NAMES])
    state, y, k = rng.normal(size=smoothing.STATE), rng.normal(size=24), np.arange(24)
    pred, after = smoothing.day_step(state, y, weekend, p, level)
    s = state[2:].reshape(2, 24)
    np.testing.assert_allclose(pred, state[0] + state[1] * k + s[weekend])
    e = y - pred
    off = e.mean() if level == "mean" else e[0]
    rise = (e[-1] - e[0]) / 24
    np.testing.assert_allclose(after[:2], [state[0] + P.alpha * off, state[1] + P.beta * rise])
    rest = e - off - rise * k
    np.testing.assert_allclose(after[2:26], s[0] + p[2 + weekend] * rest)
    np.testing.assert_allclose(after[26:], s[1] + p[4 + weekend] * rest)


def test_start_states_equal_the_aggregation(spark):
    y, temp = data(21)
    y["s1"][3] = y["s1"][100] = None
    df = frame(spark, y, temp=temp)
    for p, t in [(P, None), (replace(P, An=0.6, Ap=0.4, Tn=150.0, Tp=200.0), "temp")]:
        want = {r.series: r for r in smoothing.init_state(df, K, temp=t, params=p, ninit=14 * 24).collect()}
        for k, r in want.items():
            values_ = np.array([np.nan if v is None else v for v in y[k][:14 * 24]], float)
            got = smoothing.start_states(values_, np.array(temp[k][:14 * 24], float), r["first"] // 24,
                                         np.array([[getattr(p, n) for n in smoothing.PARAM_NAMES]]), t is not None)[0]
            np.testing.assert_allclose(got, [r.lv, r.b, *r.s[0], *r.s[1]], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("level,hole", [("mean", False), ("first", True)])
def test_candidates_at_once_equal_one_by_one(level, hole):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"slot": np.arange(24 * 9) + 24 * 19723, "y": rng.normal(50, 5, 24 * 9), "t": rng.uniform(0, 300, 24 * 9)})
    if hole:
        pdf.loc[60, "y"] = np.nan
    sets = np.abs(rng.normal(0.2, 0.1, (4, 10)))
    sets[:, 8:] = 150, 200
    states = rng.normal(size=(4, smoothing.STATE))
    maps = smoothing.chunk_maps(pdf, sets, "day", level)
    sse, n = smoothing.chunk_scores(pdf, states, sets, "day", level)
    for i, p in enumerate(sets):
        np.testing.assert_allclose(maps[i], smoothing.chunk_map(pdf, p, "day", level), atol=1e-9)
        err = smoothing.chunk_predict(pdf, states[i], p, "day", level)[:, 0] - pdf["y"].to_numpy()
        np.testing.assert_allclose([sse[i], n[i]], [np.nansum(err ** 2), np.isfinite(err).sum()])


@pytest.mark.parametrize("temp_col", [None, "temp"])
def test_refined_search_against_a_plain_loop(spark, temp_col):
    y, temp = data(28, n=2)
    y["s9"] = [None] * len(y["s0"])
    temp["s9"] = temp["s0"]
    df, ninit, rounds = frame(spark, y, temp=temp), 14 * 24, 4
    begin = Params(An=0.5, Ap=0.3, Tn=140.0, Tp=190.0) if temp_col else Params()
    names = ["alpha", "g00", "Ap", "Tp"] if temp_col else ["alpha", "beta", "g00", "g11"]
    got = {r.series: r for r in smoothing.rate_search_refined(df, K, begin, names, rounds, temp=temp_col, ninit=ninit, lr=0.2, size=168).collect()}
    assert got["s9"].rmse is None and got["s9"].alpha is None
    level = "first" if temp_col else "mean"
    for k in ("s0", "s1"):
        v, t = np.array(y[k], float), np.array(temp[k], float)

        def cost(p):
            p = np.array([getattr(p, n) for n in smoothing.PARAM_NAMES])
            state = smoothing.start_states(v[:ninit], t[:ninit], 19723, p[None], temp_col is not None)[0]
            net, errors = v - (smoothing.temp_values(t, p) if temp_col else 0), []
            for d in range(14, 28):
                pred, state = smoothing.day_step(state, net[24 * d:24 * d + 24], int(d % 7 >= 5), p, level)
                errors.append(net[24 * d:24 * d + 24] - pred)
            return float(np.sqrt(np.mean(np.square(errors))))

        now, best, low, lr = begin, begin, None, 0.2
        first = cost(begin)
        for turn in range(rounds + 1):
            j = cost(now)
            if low is None or j < low:
                best, low = now, j
            elif j > 1.2 * low:
                now, lr = best, 0.8 * lr
                continue
            if turn == rounds:
                break
            moved = {}
            for n in names:
                at = getattr(now, n)
                slope = (cost(replace(now, **{n: at + (0.001 * at or 0.001)})) - j) / (0.001 * at or 0.001)
                moved[n] = smoothing.within_limits(n, at - lr * (np.fmod(slope, 1) if n in smoothing.PARAM_NAMES[:6] else slope), at)
            now = replace(now, **moved)
        assert got[k].rmse <= first and got[k].rmse == pytest.approx(low, rel=1e-6)
        for n in smoothing.PARAM_NAMES:
            assert got[k][n] == pytest.approx(getattr(best, n), rel=1e-4, abs=1e-6)


@pytest.mark.parametrize("holes", [[], [0], [3, 4, 23], list(range(24))])
def test_a_day_of_hourly_steps_is_one_map(holes):
    rng = np.random.default_rng(5)
    y, p = rng.normal(50, 5, 24), np.abs(rng.normal(0.2, 0.1, 10))
    y[holes] = np.nan
    for state in (rng.normal(size=smoothing.STATE), rng.normal(size=(3, smoothing.STATE))):
        for weekend in (0, 1):
            want = smoothing.hour_steps(state, y, weekend, p)
            for got, plain in zip(smoothing.hourly_day_step(state, y, weekend, p, "mean"), want):
                np.testing.assert_allclose(got, plain, rtol=1e-9, atol=1e-9)
