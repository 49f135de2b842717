import numpy as np
import pytest
from helpers import MONDAY, frame, values
from pyspark.sql import functions as F

from gridspark.models import smoothing
from gridspark.models.smoothing import Params
from gridspark.session import scratch_path
from gridspark.streaming import dayahead, hourly, merge, refresh

K = ["series"]


def feed(df, path, parts):
    """Write the frames as files of increasing age order, one per micro-batch."""
    for i, cond in enumerate(parts):
        df.where(cond).coalesce(1).write.parquet(f"{path}/part={i}")
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path + "/part=*")


def test_refresh_is_order_free_and_idempotent(spark):
    rows = spark.createDataFrame([("a", 1.0, 1), ("a", 2.0, 5), ("a", 3.0, 3), ("b", 4.0, 2), ("b", 9.0, 1)],
                                 "k string, val double, version int")
    src, out, cp = (scratch_path(spark, n) for n in ("src", "out", "cp"))
    stream = feed(rows, src, [F.col("version") == v for v in (5, 1, 3, 2)])
    refresh.refresh(stream, out, cp, ["k"], "val", "version").awaitTermination()
    want = {"a": 2.0, "b": 4.0}
    assert {r.k: r.val for r in refresh.read_current(spark, out, ["k"], "val", "version").collect()} == want
    # a repeated batch overwrites its folder
    refresh._newest(rows.where("version = 1"), ["k"], "val", "version").write.mode("overwrite").parquet(f"{out}/batch=1")
    assert {r.k: r.val for r in refresh.read_current(spark, out, ["k"], "val", "version").collect()} == want
    for _ in range(2):  # the second time there is nothing to merge
        refresh.compact(spark, out, ["k"], "val", "version")
    assert {r.k: r.val for r in refresh.read_current(spark, out, ["k"], "val", "version").collect()} == want
    # the snapshot is read, not the folders that it holds; later batches still count
    rows.where("k = 'b'").drop("k").selectExpr("'z' AS k", "val", "version").write.mode("overwrite").parquet(f"{out}/batch=0")
    rows.limit(1).selectExpr("'b' AS k", "7.0D AS val", "9 AS version").write.parquet(f"{out}/batch=4")
    for _ in range(2):
        assert {r.k: r.val for r in refresh.read_current(spark, out, ["k"], "val", "version").collect()} == want | {"b": 7.0}
        refresh.compact(spark, out, ["k"], "val", "version")


def test_hourly_quality_over_batches_equals_the_table(spark):
    rows = spark.range(500).select(
        (F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 97)).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 3).cast("string").alias("kind"),
        F.when(F.col("id") % 11 == 0, F.lit(None).cast("double")).otherwise((F.col("id") % 5).cast("double")).alias("value"))
    src, out, cp = (scratch_path(spark, n) for n in ("src", "out", "cp"))
    hour = F.hour("ts")
    # the last hours come first, and one hour is spread over two batches
    stream = feed(rows, src, [hour >= 9, (hour < 4) | (F.minute("ts") < 10) & (hour < 9), (hour >= 4) & (hour < 9) & (F.minute("ts") >= 10)])
    hourly.write_hours(stream, ["kind"], out, cp).awaitTermination()
    want = hourly.hourly_quality(rows, ["kind"])
    for _ in range(2):
        got = hourly.read_hours(spark, out, ["kind"])
        assert got.count() == want.count()
        assert got.select(*want.columns).exceptAll(want).count() == 0
        hourly.compact_hours(spark, out, ["kind"])


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1), (1, 0, 2)])
def test_merged_batches_leave_the_table_of_one_load(spark, order):
    rows = spark.range(600).select(
        (F.timestamp_seconds(F.lit(1704067200) + (F.col("id") % 97) * 3600 * 20)).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 7 > 0, (F.col("id") % 3).cast("string")).alias("k"), F.col("id").cast("double").alias("val"),
        (F.col("id") * 7 % 600).alias("version"))
    src, cp, table = scratch_path(spark, "src"), scratch_path(spark, "cp"), f"merge_{'_'.join(map(str, order))}"
    stream = feed(rows, src, [f"pmod(xxhash64(val), 3) = {i}" for i in order])
    merge.create(spark, table, stream, ["ts", "k"], "val", "version")
    merge.merge_stream(stream, table, cp, ["ts", "k"], "val", "version").awaitTermination()
    want = sorted(map(str, rows.groupBy("ts", "k").agg(F.max_by("val", "version").alias("val"), F.max("version").alias("version")).collect()))

    def table_rows():
        return sorted(map(str, spark.table(table).drop("month").collect()))

    assert table_rows() == want
    assert [r.batch for r in spark.table(table + merge.LEDGER).orderBy("batch").collect()] == [0, 1, 2]
    # an old batch merged again, and a whole run without its checkpoint
    merge.merge_batch(rows.where("pmod(xxhash64(val), 3) = 1"), table, ["ts", "k"], "val", "version")
    assert table_rows() == want
    merge.merge_stream(stream, table, scratch_path(spark, "cp"), ["ts", "k"], "val", "version").awaitTermination()
    assert table_rows() == want and spark.table(table + merge.LEDGER).count() == 3
    for name in (table, table + merge.LEDGER):
        spark.sql(f"DROP TABLE {name}")


def test_final_late_and_open_rows_are_all_rows(spark):
    rows = spark.range(500).select(
        (F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 97)).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 3).cast("string").alias("kind"), F.when(F.col("id") % 11 > 0, F.col("id") % 5).cast("double").alias("value"))
    src, final, out = (scratch_path(spark, n) for n in ("src", "final", "out"))
    # hours 0 to 3 in two parts; a part of hour 1 and all of hour 5 come after their windows have closed
    late = "hour(ts) = 1 and minute(ts) < 20 or hour(ts) = 5"
    stream = feed(rows, src, [f"hour(ts) < 4 and not ({late})", f"hour(ts) >= 4 and hour(ts) < 10 and not ({late})", "hour(ts) = 10", late,
                              "hour(ts) > 10"])
    hourly.write_final_hours(stream, ["kind"], final, scratch_path(spark, "cp"), "2 hours").awaitTermination()
    hourly.write_hours(stream, ["kind"], out, scratch_path(spark, "cp")).awaitTermination()
    reached = rows.agg(F.expr("max(ts) - INTERVAL 2 HOURS")).first()[0]
    got = hourly.settled_hours(spark, final, out, ["kind"], reached).collect()
    want = {(r.ts, r.kind): r.n_rows for r in hourly.hourly_quality(rows, ["kind"]).collect()}
    assert {(r.ts, r.kind): r.n_final + r.n_late + r.n_open for r in got} == want
    for r in got:
        assert (r.n_late > 0) == (r.ts.hour in (1, 5)) and (r.n_open > 0) == (r.ts.hour + 1 > reached.hour)
        assert r.ts.hour != 5 or r.n_final == 0
    ends = spark.read.parquet(final)
    assert ends.groupBy("ts", "kind").count().where("count > 1").count() == 0


@pytest.fixture
def store(spark):
    for key, value in dayahead.STORE.items():
        spark.conf.set(key, value)
    yield
    for key in dayahead.STORE:
        spark.conf.unset(key)


def run_online(spark, rows, states, parts, params, **options):
    """Predictions (series, slot, pred) of the online model over a stream cut into `parts`, and the checkpoint's folder."""
    src, out, cp = (scratch_path(spark, n) for n in ("src", "out", "cp"))
    online = dayahead.online_dayahead(feed(rows, src, parts), states, K, params, **options)
    (online.writeStream.format("parquet").option("path", out).option("checkpointLocation", cp)
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(online.schema).parquet(out), cp


def loop_online(y, params, state, last_closed):
    """Predictions by day of one series of whole days, from the second day to the one after `last_closed`."""
    p = np.array([getattr(params, n) for n in smoothing.PARAM_NAMES])
    out = []
    y = np.array([np.nan if v is None else v for v in y] + [np.nan] * 24 * (last_closed + 1))
    for d in range(last_closed + 1):
        day = y[24 * d:24 * d + 24]
        if state is None:
            state = np.r_[np.nanmean(day), np.zeros(smoothing.STATE - 1)]
        _, state = smoothing.day_step(state, day, int(d % 7 >= 5), p, "mean")
        out += smoothing.day_step(state, np.full(24, np.nan), int((d + 1) % 7 >= 5), p, "mean")[0].tolist()
    return out


def between(a, b):
    return f"slot - {MONDAY} >= {a} and slot - {MONDAY} < {b}"


@pytest.mark.parametrize("cuts", [[10**9], [100, 250, 10**9], [30, 31, 60, 200, 10**9]])
@pytest.mark.parametrize("gap", [(), (3, 4), (2, 6, 12)])
def test_online_dayahead_whatever_the_cut(spark, store, cuts, gap):
    """Days without rows are predicted too; a series that falls silent closes its days; one has no start state."""
    rng = np.random.default_rng(7)
    y = {f"s{i}": list(50 + rng.normal(0, 5, 24 * 14)) for i in range(3)}
    y = {k: [None if h // 24 in gap else x for h, x in enumerate(v)] for k, v in y.items()}
    y["s2"] = y["s2"][:24 * 8 + 5]
    rows = frame(spark, y).where("val is not null").select("series", "slot", "val")
    start = np.r_[50.0, 0.1, rng.normal(0, 1, 48)]
    states = spark.createDataFrame([("s0", start.tolist()), ("s2", start.tolist())], "series string, state array<double>")
    p = Params(alpha=0.2, beta=0.05)
    edges = [0, *cuts]
    got, _ = run_online(spark, rows, states, [between(a, b) for a, b in zip(edges, edges[1:])], p, delay="1 day")
    a = values(got, "pred")
    # the watermark ends a day before the last row: day 12 has passed, day 13 is complete
    for k, silent in (("s0", False), ("s1", False), ("s2", True)):
        # the watermark ends within day 12, which closes if it is complete, and day 13 after it
        last = 11 if silent or 12 in gap else 13
        want = loop_online(y[k], p, None if k == "s1" else start, last)
        np.testing.assert_allclose(a[k], want, rtol=1e-9)


def test_online_dayahead_out_of_order(spark, store):
    rng = np.random.default_rng(3)
    y = {"a": list(50 + rng.normal(0, 5, 24 * 10))}
    rows = frame(spark, y).select("series", "slot", "val")
    shuffled = [f"{between(0, 48)} and pmod(xxhash64(slot), 3) = {i}" for i in range(3)]
    shuffled += [f"{between(48, 96)} and slot % 2 = {i}" for i in range(2)] + [between(96, 10**9)]
    states = spark.createDataFrame([], "series string, state array<double>")
    got, _ = run_online(spark, rows, states, shuffled, Params(alpha=0.2), delay="3 days")
    np.testing.assert_allclose(values(got, "pred")["a"], loop_online(y["a"], Params(alpha=0.2), None, 9), rtol=1e-9)


def test_online_state_expires(spark, store):
    """A series silent for longer than `idle_days` leaves no state; when it comes back it starts anew."""
    rng = np.random.default_rng(5)
    quiet = [x if h // 24 < 3 or h // 24 >= 12 else None for h, x in enumerate(50 + rng.normal(0, 5, 24 * 15))]
    y = {"on": list(50 + rng.normal(0, 5, 24 * 23)), "back": quiet, "gone": quiet[:24 * 3]}
    rows = frame(spark, y).where("val is not null").select("series", "slot", "val")
    states = spark.createDataFrame([], "series string, state array<double>")
    p = Params(alpha=0.2)
    results = []
    for cuts in ([0, 10**9], [0, 60, 200, 300, 10**9]):
        got, cp = run_online(spark, rows, states, [between(a, b) for a, b in zip(cuts, cuts[1:])], p, delay="1 day", idle_days=4)
        left = spark.read.format("statestore").option("stateVarName", "model").load(cp).selectExpr("key.series").collect()
        assert [r.series for r in left] == ["on"]
        results.append(values(got, "pred"))
    assert results[0] == results[1]
    first = loop_online(quiet, p, None, 6)                            # days 0 to 2, then four silent ones
    again = loop_online(quiet[24 * 12:], p, None, 6)
    assert results[0]["gone"] == pytest.approx(first)
    np.testing.assert_allclose(results[0]["back"][:len(first)], first)
    weekend = [values(got, "slot")["back"][len(first)], len(results[0]["back"])]
    assert weekend == [MONDAY + 13 * 24, len(first) + len(again)]
