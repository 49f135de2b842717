"""Streams run to completion over the tables' own files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridspark import fixtures as fx
from gridspark.catalog.base import query, r, rounded
from gridspark.catalog.model_queries import NINIT, RATES, _walk_ctes
from gridspark.models import smoothing
from gridspark.operators import grid
from gridspark.session import materialize, scratch_path
from gridspark.streaming import dayahead, hourly, merge, refresh


def streaming_session(spark):
    """A session of the same cluster whose streams use the state store that the event-time model needs."""
    other = spark.newSession()
    for key, value in {**dayahead.STORE, "spark.sql.session.timeZone": "UTC"}.items():
        other.conf.set(key, value)
    return other


def event_stream(spark, sf):
    schema = fx.table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


@query("stream_hourly", f"""SELECT date_trunc('hour', ts) AS ts, event_type, count(*) AS n_rows, 0::BIGINT AS n_null,
    count(*) FILTER (value = 0) AS n_zero, {r('sum(value)', 'total', 4)} FROM events GROUP BY ALL""")
def stream_hourly(spark, sf):
    path, checkpoint = scratch_path(spark, "hourly"), scratch_path(spark, "hourly-checkpoint")
    hourly.write_hours(event_stream(spark, sf), ["event_type"], path, checkpoint).awaitTermination()
    return rounded(hourly.read_hours(spark, path, ["event_type"]), "total", places=4)


@query("hourly_quality", f"""SELECT date_trunc('hour', ts) AS ts, event_type, count(*) AS n_rows, 0::BIGINT AS n_null,
    count(*) FILTER (value = 0) AS n_zero, {r('sum(value)', 'total', 4)} FROM events GROUP BY ALL""")
def hourly_batch(spark, sf):
    return rounded(hourly.hourly_quality(fx.table(spark, sf, "events"), ["event_type"]), "total", places=4)


@query("stream_refresh", """SELECT date_trunc('hour', ts) AS ts, event_type, max_by(value, event_id) AS val FROM events GROUP BY ALL""")
def stream_refresh(spark, sf):
    path, checkpoint = scratch_path(spark, "refresh"), scratch_path(spark, "refresh-checkpoint")
    rows = event_stream(spark, sf).select(fx.hour_of().alias("ts"), "event_type", F.col("value").alias("val"), "event_id")
    refresh.refresh(rows, path, checkpoint, ["ts", "event_type"], "val", "event_id").awaitTermination()
    return refresh.read_current(spark, path, ["ts", "event_type"], "val", "event_id")


@query("stream_merge", """SELECT date_trunc('hour', ts) AS ts, event_type, max_by(value, event_id) AS val, max(event_id) AS event_id
    FROM events GROUP BY ALL""")
def stream_merge(spark, sf):
    """The newest value of each hour, merged batch by batch into a table by month."""
    table, keys = f"merged_{uuid.uuid4().hex}", ["ts", "event_type"]
    rows = event_stream(spark, sf).select(fx.hour_of().alias("ts"), "event_type", F.col("value").alias("val"), "event_id")
    merge.create(spark, table, rows, keys, "val", "event_id")
    merge.merge_stream(rows, table, scratch_path(spark, "merge-checkpoint"), keys, "val", "event_id").awaitTermination()
    out = materialize(spark.table(table).drop("month"), "merged")
    for name in (table, table + merge.LEDGER):
        spark.sql(f"DROP TABLE {name}")
    return out


@query("stream_windows", f"""SELECT date_trunc('hour', ts) AS ts, event_type, CASE WHEN passed THEN count(*) ELSE 0 END AS n_final,
    0::BIGINT AS n_late, CASE WHEN passed THEN 0 ELSE count(*) END AS n_open, {r('sum(value)', 'total', 4)}
    FROM (SELECT *, date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR AS passed FROM events)
    GROUP BY date_trunc('hour', ts), event_type, passed""")
def stream_windows(spark, sf):
    """Hours by event-time windows: final ones, late rows and hours still open."""
    final, path = scratch_path(spark, "final-hours"), scratch_path(spark, "all-hours")
    events = event_stream(spark, sf)
    hourly.write_final_hours(events, ["event_type"], final, scratch_path(spark, "final-checkpoint")).awaitTermination()
    hourly.write_hours(events, ["event_type"], path, scratch_path(spark, "all-checkpoint")).awaitTermination()
    reached = fx.table(spark, sf, "events").agg(F.expr("max(ts) - INTERVAL 2 HOURS")).first()[0]
    return rounded(hourly.settled_hours(spark, final, path, ["event_type"], reached), "total", places=4)


@query("stream_dayahead", f"""WITH RECURSIVE {_walk_ctes(RATES, False)}, z AS (SELECT min(ts) AS origin FROM fx_joint)
    SELECT series, origin + to_days(CAST(day + 1 AS INTEGER)) + to_hours(i - 1) AS ts, {r('''lv + b * (i - 1) +
        CASE WHEN isodow(origin + to_days(CAST(day + 1 AS INTEGER))) >= 6 THEN s1[i] ELSE s0[i] END''', 'pred', 5)}
    FROM walk, z, (SELECT unnest(range(1, 25)) AS i) WHERE day >= {NINIT // 24}""", ("fx_joint",))
def stream_dayahead(spark, sf):
    """Day-ahead predictions emitted by the online model over the hours after the initial stretch."""
    rows = fx.joint(spark, sf)
    state = smoothing.init_state(rows, ["series"], ninit=NINIT)
    later = grid.attach(rows, state.select("series", "lo", "hi", "first"), ["series"])
    feed, source = later.where(F.col("slot") >= F.col("first") + NINIT).select("series", "slot", "val"), scratch_path(spark, "hours-feed")
    feed.write.parquet(source)
    states = materialize(state.select("series", smoothing.state_array().alias("state")), "start-states")
    stream = streaming_session(spark).readStream.schema(feed.schema).parquet(source)
    path, checkpoint = scratch_path(spark, "dayahead"), scratch_path(spark, "dayahead-checkpoint")
    out = dayahead.online_dayahead(stream, states, ["series"], RATES)
    (out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    result = spark.read.schema(out.schema).parquet(path)
    return rounded(smoothing.wall_ts(result).select("series", "ts", "pred"), "pred", places=5)
