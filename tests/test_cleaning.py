import numpy as np
import pytest
from helpers import MONDAY, frame, loop_avg_extremes, loop_remove_na, messy, same, values
from pyspark.sql import functions as F

from gridspark.functions import timefn
from gridspark.operators import align, quality

K = ["series"]


def random_series(seed):
    rng = np.random.default_rng(seed)
    out = {f"s{i}": messy(rng, int(n)) for i, n in enumerate(rng.integers(30, 200, 40))}
    out["all_missing_class"] = [None if i % 3 == 1 else float(i + 1) for i in range(60)]
    return out


# chunks of 7 and 24 rows force every look-back across several chunks
@pytest.mark.parametrize("window,size", [(2, 7), (3, 24), (24, 24), (24, 16128), (5, 16)])
def test_remove_na_is_the_loop(spark, window, size):
    data = random_series(window * 100 + size)
    got = quality.remove_na(frame(spark, data), K, window=window, size=size)
    same(values(got, "val"), {k: loop_remove_na(v, window) for k, v in data.items()})


@pytest.mark.parametrize("window,size", [(2, 7), (3, 24), (24, 24), (24, 16128), (5, 16)])
def test_avg_extremes_is_the_loop(spark, window, size):
    data = random_series(window * 10 + size)
    got = quality.avg_extremes(frame(spark, data), K, window=window, size=size)
    same(values(got, "val"), {k: loop_avg_extremes(v, window) for k, v in data.items()})


def test_cleaners_in_a_chain_keep_one_partitioning(spark):
    data = random_series(5)
    rows = frame(spark, data).select("series", "ts", "val")
    clean = quality.avg_extremes(quality.remove_na(align.calendar_fill(rows, K, ["val"], size=24), K, window=3, size=24),
                                 K, window=3, size=24)
    same(values(clean, "val"), {k: loop_avg_extremes(loop_remove_na(v, 3), 3) for k, v in data.items()})


@pytest.mark.parametrize("size", [4, 10, 16128])
@pytest.mark.parametrize("common", [False, True])
def test_calendar_fill(spark, size, common):
    data = {"a": {3: 1.0, 4: 2.0, 37: 3.0}, "b": {0: 5.0, 20: 6.0}, "c": {11: 7.0}}
    rows = spark.createDataFrame([(k, MONDAY + s, v) for k, d in data.items() for s, v in d.items()],
                                 "series string, slot long, val double").withColumn("ts", timefn.slot_ts("slot"))
    got = values(align.calendar_fill(rows.select("series", "ts", "val"), K, ["val"], common=common, size=size), "val")
    for k, d in data.items():
        lo, hi = (0, 37) if common else (min(d), max(d))
        assert got[k] == [d.get(i) for i in range(lo, hi + 1)]


def test_calendar_keeps_repeated_rows(spark):
    rows = spark.createDataFrame([("a", 0, 1.0), ("a", 2, 2.0), ("a", 2, 3.0), ("a", 4, 4.0)],
                                 "series string, slot long, val double").withColumn("ts", timefn.slot_ts("slot"))
    out = align.calendar_fill(rows.select("series", "ts", "val"), K, ["val"]).select("slot", "val").collect()
    assert sorted((r.slot, r.val if r.val is not None else -1) for r in out) == [
        (0, 1.0), (1, -1), (2, 2.0), (2, 3.0), (3, -1), (4, 4.0)]


def test_quality_counts_and_residual(spark):
    data = {"a": [1.0, None, 0.0] + [2.0] * 60 + [500.0]}
    row = quality.quality_counts(frame(spark, data), K, size=8).collect()[0]
    assert (row.n_rows, row.n_null, row.n_high, row.n_zero) == (64, 1, 1, 1)
    facts = spark.createDataFrame([("t", "D", 10.0), ("t", "NG", 7.0), ("t", "TI", -3.0)],
                                  "ts string, measure string, val double")
    assert quality.identity_residual(facts, ["ts"], "D", "NG", "TI").collect()[0].residual == 0.0
    assert quality.identity_residual(facts, ["ts"], "D", "NG", "TI", code_sign=True).collect()[0].residual == 20.0


def test_wall_clock_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "US/Pacific")
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00' AS ts")
        row = df.select(timefn.slot_of("ts").alias("s"), timefn.slot_ts(timefn.slot_of("ts")).cast("string").alias("t")).collect()[0]
        assert row.s == (19792 * 24 + 2) and row.t == "2024-03-10 02:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("window,size", [(2, 7), (24, 24), (5, 16128)])
def test_remove_na_both_sides(spark, window, size):
    data = random_series(window + size)
    want = {}
    for k, x in data.items():
        y = list(x)
        for i, v in enumerate(x):
            if v is None:
                before = next((x[j] for j in range(i, -1, -window) if x[j] is not None), None)
                after = next((x[j] for j in range(i, len(x), window) if x[j] is not None), None)
                have = [n for n in (before, after) if n is not None]
                y[i] = sum(have) / len(have) if have else None
        want[k] = y
    got = quality.remove_na(frame(spark, data), K, window=window, side="both", size=size)
    same(values(got, "val"), want)
