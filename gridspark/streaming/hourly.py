"""Hourly aggregates of a raw event stream with quality counters (extension)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridspark.streaming import batches


def hourly_quality(events: DataFrame, keys: list[str], val: str = "value", ts: str = "ts") -> DataFrame:
    """Hours of a table: rows, NULLs, zeros, sum."""
    v = F.col(val)
    return (events.groupBy(F.date_trunc("hour", ts).cast("timestamp_ntz").alias("ts"), *keys)
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(v.isNull()).alias("n_null"),
                 F.count_if(v == 0).alias("n_zero"), F.sum(v).alias("total")))


def write_hours(events: DataFrame, keys: list[str], path: str, checkpoint: str, val: str = "value",
                ts: str = "ts") -> StreamingQuery:
    """Write each micro-batch's share of its hours under its batch number; read with `read_hours`.

    All four figures add up over batches, so the stream keeps no state, needs no watermark and loses no late row.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batches.write_batch(hourly_quality(batch, keys, val, ts), path, batch_id)

    return (events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _add_up(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy("ts", *keys).agg(*[F.sum(c).alias(c) for c in ("n_rows", "n_null", "n_zero", "total")])


def read_hours(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Every hour over all batches."""
    return _add_up(batches.read_batches(spark, path), keys)


def compact_hours(spark: SparkSession, path: str, keys: list[str]) -> None:
    """Merge all batches but the newest into a snapshot that `read_hours` uses from then on."""
    batches.compact(spark, path, lambda rows: _add_up(rows, keys))


def write_final_hours(events: DataFrame, keys: list[str], path: str, checkpoint: str, delay: str = "2 hours", val: str = "value",
                      ts: str = "ts") -> StreamingQuery:
    """Hours by event-time windows, each given out once, when the watermark (`delay` behind the latest row) has passed it.

    Rows that come later are no part of it; `write_hours` over the same stream counts them, see `settled_hours`.
    """
    v = F.col(val)
    rows = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    hours = (rows.groupBy(F.window("_ts", "1 hour").alias("_w"), *keys)
             .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(v.isNull()).alias("n_null"),
                  F.count_if(v == 0).alias("n_zero"), F.sum(v).alias("total"))
             .select(F.col("_w.start").cast("timestamp_ntz").alias("ts"), *keys, "n_rows", "n_null", "n_zero", "total"))
    return (hours.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def settled_hours(spark: SparkSession, final: str, path: str, keys: list[str], watermark: datetime) -> DataFrame:
    """ts, keys, n_final, n_late, n_open, total: every hour's rows as the final windows counted them, as they came too late for
    that, or as they wait in an hour still open.

    `path` holds the hours of all rows (`write_hours`), `final` the final ones; `watermark` is the time that the
    windows have reached. Final, late and open rows together are all rows.
    """
    every = read_hours(spark, path, keys)
    schema = every.select("ts", *keys, "n_rows").schema
    done = spark.read.schema(schema).parquet(final).withColumnRenamed("n_rows", "n_final")
    rows = every.join(done, ["ts", *keys], "left").withColumn("n_final", F.coalesce("n_final", F.lit(0)))
    passed = F.timestamp_add("HOUR", F.lit(1), F.col("ts")) <= F.lit(watermark).cast("timestamp_ntz")
    rest = F.col("n_rows") - F.col("n_final")
    return rows.select("ts", *keys, "n_final", F.when(passed, rest).otherwise(0).alias("n_late"), F.when(passed, 0).otherwise(rest).alias("n_open"),
                       "total")
