import numpy as np
import pytest
from helpers import MONDAY, frame, same, values
from pyspark.sql import functions as F

from gridspark.models import fourier, spectral
from gridspark.operators import grid, series

K = ["series"]


def data(n=150, seed=1):
    rng = np.random.default_rng(seed)
    return {f"s{i}": list(np.sin(np.arange(n) / 4) * 3 + rng.normal(10, 1, n)) for i in range(3)}


@pytest.mark.parametrize("size", [24, 16128])
def test_moving_avg(spark, size):
    d, w = data(), 6
    want = {}
    for k, x in d.items():
        c, y = np.cumsum(x), np.zeros(len(x))
        y[w:-w] = (c[2 * w:] - c[:-2 * w]) / (2 * w)
        want[k] = list(y)
    same(values(series.moving_avg(frame(spark, d), K, width=w, size=size), "smooth"), want)


@pytest.mark.parametrize("period,size", [(24, 48), (7, 24), (24, 16128)])
def test_seasonal_decompose(spark, period, size):
    d, want = data(), {"trend": {}, "seasonal": {}, "residual": {}}
    for k, x in d.items():
        x = np.asarray(x)
        taps = np.r_[0.5, np.ones(period - 1), 0.5] / period if period % 2 == 0 else np.ones(period) / period
        m = len(taps)
        trend = np.full(len(x), np.nan)
        for t in range(m - 1, len(x)):
            trend[t] = (taps * x[t - m + 1:t + 1][::-1]).sum()
        rest = x - trend
        phase = np.array([np.nanmean(rest[i::period]) for i in range(period)])
        season = np.tile(phase - phase.mean(), len(x) // period + 1)[:len(x)]
        for name, v in (("trend", trend), ("seasonal", season), ("residual", rest - season)):
            want[name][k] = list(v / x.mean())
    out = series.seasonal_decompose(frame(spark, d), K, period=period, size=size).cache()
    for name in want:
        same(values(out, name), want[name])


@pytest.mark.parametrize("size", [5, 24, 16128])
def test_acf_and_pacf(spark, size):
    d = data()
    d["s0"][5] = d["s0"][70] = None
    d["s1"][30:61] = [None] * 31  # whole chunks without a value
    d["s2"] = [v + 1e6 for v in d["s2"]]
    acf = values(series.acf(frame(spark, d), K, nlags=8, size=size), "acf", "lag")
    pacf = values(series.pacf(frame(spark, d), K, nlags=8, size=size), "pacf", "lag")
    for k, x in d.items():
        x = np.array([v for v in x if v is not None])
        c = x - x.mean()
        np.testing.assert_allclose(acf[k], [(c[i:] * c[:len(c) - i]).sum() / (c * c).sum() for i in range(9)], rtol=1e-9)
        want = [1.0]
        for lag in range(1, 9):
            rows = np.column_stack([np.ones(len(x) - lag)] + [x[lag - j:len(x) - j] for j in range(1, lag + 1)])
            want.append(np.linalg.lstsq(rows, x[lag:], rcond=None)[0][-1])
        np.testing.assert_allclose(pacf[k], want, rtol=1e-6, atol=1e-8)


@pytest.mark.parametrize("size", [24, 16128])
def test_correlations_shuffle_twice(spark, size):
    plan = series.acf(frame(spark, data()), K, nlags=8, size=size)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2
    odd = frame(spark, {"none": [None, None], "one": [3.0], "flat": [2.5] * 30})
    assert {(r.series, r.lag, r.acf) for r in series.acf(odd, K, nlags=2, size=size).collect()} == {
        ("one", 0, None), ("flat", 0, None), ("flat", 1, None), ("flat", 2, None)}


@pytest.mark.parametrize("size", [24, 16128])
def test_lags_windows_and_scaling(spark, size):
    d = data(96)
    df = frame(spark, d)
    lagged = series.lagged(df, K, "val", [1, 24], size=size)
    assert lagged.count() == 3 * 96
    same(values(lagged, "lag_24"), {k: [None] * 24 + x[:-24] for k, x in d.items()})
    win = series.seq_windows(df, K, "val", "val", 10, size=size).where("series = 's1'").orderBy("slot").collect()
    assert [r.slot - MONDAY for r in win] == list(range(0, 77, 10))
    assert win[2].x == d["s1"][20:30] and win[2].y == d["s1"][30:40]
    win = series.seq_windows(df, K, "val", "slot", 10, offset=4, stride=3, label_length=2, size=size)
    win = win.where("series = 's1'").orderBy("slot").collect()
    assert [r.slot - MONDAY for r in win] == list(range(0, 87, 3))
    assert all(r.x == d["s1"][i:i + 10] and r.y == [MONDAY + i + 4, MONDAY + i + 5] for r, i in zip(win, range(0, 87, 3)))
    scaled = series.minmax_train(df, K, size=size)
    back = scaled.withColumn("back", series.minmax_inverse(F.col("scaled"), F.col("train_min"), F.col("train_max")))
    same(values(back, "back"), d)
    train = scaled.where("part = 'train'").agg(F.min("scaled"), F.max("scaled")).collect()[0]
    assert tuple(train) == (0.0, 1.0)


def test_day_level_and_slope_rebuild_a_piecewise_line(spark):
    x = [d * 10.0 + 2.0 * d * h for d in range(6) for h in range(24)]
    rows = series.day_grad(series.day_level(frame(spark, {"a": x}), K), K)
    same(values(rows.withColumn("sum", F.col("level") + F.col("grad")), "sum"), {"a": x})


def test_row_index_and_dense_ids(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 1000).alias("o"))
    out = grid.row_index(rows, ["k"], ["o"], F.floor(F.col("o") / 50)).toPandas()
    for _, g in out.groupby("k"):
        g = g.sort_values("o")
        assert list(g["rn"]) == list(range(len(g)))
    names = spark.range(500).select(F.concat(F.lit("n"), "id").alias("name"))
    ids = sorted(r.id for r in grid.dense_ids(names, "name").select("id").collect())
    assert ids == list(range(1, 501))


def test_run_boundaries_with_empty_chunks_and_null_labels(spark):
    labels = ["a", "a", "b", "b", "b", None, None, "a", "a", "c"]
    places = [0, 1, 2, 13, 14, 15, 40, 41, 42, 55]
    rows = spark.createDataFrame(list(zip(places, labels)), "pos int, label string")
    out = series.run_boundaries(rows, "label", ["pos"], F.floor(F.col("pos") / 10)).orderBy("pos").collect()
    assert [r.run_id for r in out] == [0, 0, 1, 1, 1, 2, 2, 3, 3, 4]
    ranges = series.run_boundaries(rows, "label", ["pos"]).orderBy("pos").collect()
    assert [(r.run_id, r.starts) for r in ranges] == [(r.run_id, r.starts) for r in out]


def test_sample_windows_repeat_and_stay_inside(spark):
    df = frame(spark, data(60))
    a = series.sample_windows(df, K, 5, 12, seed=1).select("series", "sample", "step", "val")
    b = series.sample_windows(df, K, 5, 12, seed=1).select("series", "sample", "step", "val")
    assert a.count() == 3 * 5 * 12
    assert a.exceptAll(b).count() == 0


@pytest.mark.parametrize("shape", ["square", "sinc"])
def test_fft_detrend_parts_add_up_and_flatten_the_day(spark, shape):
    n = 28 * 24
    t = np.arange(n)
    x = list(100 + 20 * np.sin(2 * np.pi * t / 24) + np.random.default_rng(0).normal(0, 1, n))
    hole = list(x)
    hole[3] = None
    out = spectral.fft_detrend(frame(spark, {"a": x, "hole": hole}), K, segment=n, width=0.15, smooth=5,
                               shape=shape)
    got = {c: values(out.where("series = 'a'"), c)["a"] for c in ("trend", "detrend")}
    np.testing.assert_allclose(np.add(got["trend"], got["detrend"]), x, rtol=1e-9)
    if shape == "square":
        assert np.std(got["detrend"]) < 3 and abs(np.mean(got["trend"]) - 100) < 1
    assert all(v is None or v != v for v in values(out.where("series = 'hole'"), "trend")["hole"])


def test_detrend_cuts_from_the_series_own_start(spark):
    """One span that crosses a multiple of the segment length is transformed whole; the rest of a long one joins its last piece."""
    rng = np.random.default_rng(1)
    x = list(50 + rng.normal(0, 5, 100))
    whole = spectral.fft_detrend(frame(spark, {"a": x}), K, segment=64, width=0.3, smooth=3)
    want = spectral.detrend_segment(np.array(x), 0.3, "square", 3, 24)
    np.testing.assert_allclose(values(whole, "trend")["a"], want, rtol=1e-9)
    two = values(spectral.fft_detrend(frame(spark, {"a": x}), K, segment=40, width=0.3, smooth=3), "trend")["a"]
    np.testing.assert_allclose(two[:40], spectral.detrend_segment(np.array(x[:40]), 0.3, "square", 3, 24), rtol=1e-9)
    np.testing.assert_allclose(two[40:], spectral.detrend_segment(np.array(x[40:]), 0.3, "square", 3, 24), rtol=1e-9)
    short = spectral.fft_detrend(frame(spark, {"a": x[:7]}), K)
    assert all(v is not None and np.isfinite(v) for v in values(short, "trend")["a"])


def test_square_filter_against_the_stated_steps():
    """The reference's sequence written out on the shifted spectrum, with whole bins."""
    rng = np.random.default_rng(3)
    n, spd, width, smooth = 14 * 24, 24, 0.2, 4
    x = rng.normal(50, 5, n) + 10 * np.cos(2 * np.pi * np.arange(n) / 24)
    days = n / spd
    freq = (np.arange(n) - n // 2) / days
    spec = np.fft.ifftshift(np.fft.fft(np.fft.fftshift(x)))
    total, rest = np.zeros(n, complex), spec.copy()
    for centre in [0, 1, -1, 2, -2] + [s * i / 7 for i in range(1, 6) for s in (1, -1)]:
        inside = np.abs(freq - centre) < width - 1e-12
        ring = (np.abs(freq - centre) < 1.5 * width - 1e-12) & ~inside
        part = np.where(inside, rest - rest[ring].mean(), 0)
        total, rest = total + part, rest - part
    c, sm = np.cumsum(rest), np.zeros(n, complex)
    sm[smooth:-smooth] = (c[2 * smooth:] - c[:-2 * smooth]) / (2 * smooth)
    want = np.real(np.fft.fftshift(np.fft.ifft(np.fft.fftshift(total + sm))))
    np.testing.assert_allclose(spectral.detrend_segment(x, width, "square", smooth, spd), want, rtol=1e-9)


def test_fourier_recovers_a_daily_wave(spark):
    x = [5 + 3 * np.cos(2 * np.pi * h / 24) for h in range(24 * 14)]
    df = frame(spark, {"a": x})
    coefs = fourier.fit(df, K, {"daily": 2})
    same(values(fourier.predict(df, coefs, K, {"daily": 2}, size=48), "fourier"), {"a": x})


def test_power_bins_match_fft(spark):
    d = data(120)
    got = spectral.power_bins(frame(spark, d), K, [0, 3, 7], size=24)
    for r in got.collect():
        spec = np.abs(np.fft.fft(d[r.series])) ** 2
        assert abs(r.power - spec[r.bin] / spec.sum()) < 1e-12
