"""Work on long series without ever putting one series into one task.

A series is cut into chunks of consecutive grid steps. Bounded look-back or look-ahead (lags, moving
windows) copies the few rows at a chunk's edge into its neighbour. Unbounded look-back (last valid value,
row numbers) summarises each chunk, scans the summaries, and finishes inside the chunk. Every shuffle of
observations is on (series, chunk), so one series with a third of all rows is spread like any other.

Frames keep their chunk number in a column named after the chunk size. An operator that finds it reuses the
partitioning its input already has, so a chain such as calendar -> cleaning -> scaling shuffles the rows once.

Columns used throughout: the series keys, `slot` (grid step number, see `timefn.slot_of`) and the chunk number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridspark.functions import timefn

# 96 weeks of hours: a whole number of days and weeks, so day blocks never straddle two chunks
CHUNK = 96 * 168


def with_slot(df: DataFrame, ts: str = "ts", step: int = timefn.HOUR) -> DataFrame:
    return df.withColumn("slot", timefn.slot_of(ts, step))


def chunk_of(slot: Column, size: int) -> Column:
    return F.floor(slot / size).cast("long")


def chunk_col(size: int = CHUNK) -> str:
    return f"chunk_{size}"


def with_chunk(df: DataFrame, size: int = CHUNK) -> DataFrame:
    """Add the chunk number unless the frame carries it already."""
    name = chunk_col(size)
    return df if name in df.columns else df.withColumn(name, chunk_of(F.col("slot"), size))


def series_stats(df: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    """One row per series: first and last slot (`lo`, `hi`) and the given aggregates, combined map-side."""
    return df.groupBy(*keys).agg(F.min("slot").alias("lo"), F.max("slot").alias("hi"), *aggs)


def spread(stats: DataFrame, size: int = CHUNK, before: int = 0, after: int = 0) -> DataFrame:
    """One row per series and chunk between `lo` and `hi`, widened by the steps that `with_halo` copies."""
    first, last = chunk_of(F.col("lo") - after, size), chunk_of(F.col("hi") + before, size)
    return stats.withColumn(chunk_col(size), F.explode(F.sequence(first, last)))


def attach(df: DataFrame, stats: DataFrame, keys: list[str], size: int = CHUNK, before: int = 0, after: int = 0,
           windowed: bool = False) -> DataFrame:
    """Give each observation its series' row of `stats`; joins on (series, chunk), never on the series alone.

    `windowed` says that a window over (series, chunk) follows: then the rows have to be shuffled by these keys
    in any case, and hashing the small side (one row per chunk) spares sorting them twice.
    """
    small = spread(stats, size, before, after)
    if windowed:
        small = small.hint("shuffle_hash")
    return with_chunk(df, size).join(small, [*keys, chunk_col(size)])


def with_halo(df: DataFrame, before: int, after: int = 0, size: int = CHUNK) -> DataFrame:
    """Copy edge rows to the neighbouring chunks that look `before` steps back or `after` steps ahead.

    Sets the chunk number and `own`; run windows over `halo_window`, then keep the `own_rows`.
    The slots must be consecutive within a series (see `align.calendar_fill`).
    """
    s, name = F.col("slot"), chunk_col(size)
    first, last = chunk_of(s - after, size), chunk_of(s + before, size)
    return (df.drop(name).withColumn(name, F.explode(F.sequence(first, last)))
            .withColumn("own", F.col(name) == chunk_of(s, size)))


def halo_window(keys: list[str], size: int = CHUNK) -> W:
    return W.partitionBy(*keys, chunk_col(size)).orderBy("slot")


def own_rows(df: DataFrame) -> DataFrame:
    return df.where("own").drop("own")


def row_index(df: DataFrame, keys: list[str], order: list[str], chunk: Column, out: str = "rn") -> DataFrame:
    """0-based position of each row within its series.

    `chunk` must grow with `order` (for example the day of the timestamp). Chunk sizes are counted first and
    summed up; rows are numbered only inside their chunk.
    """
    df = df.withColumn("chunk", chunk)
    before = W.partitionBy(*keys).orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = (df.groupBy(*keys, "chunk").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
               .drop("n"))
    inside = W.partitionBy(*keys, "chunk").orderBy(*order)
    return (df.join(offsets.hint("shuffle_hash"), [*keys, "chunk"])
            .withColumn(out, F.col("offset") + F.row_number().over(inside) - 1)
            .drop("offset", "chunk"))


def dense_ids(df: DataFrame, name: str, out: str = "id", start: int = 1) -> DataFrame:
    """Consecutive ids for distinct names, ordered by (first two hex digits of md5, name).

    Names are numbered inside their hash bucket; only the bucket counts (at most 256 rows) meet in one task.
    """
    df = df.withColumn("bucket", F.substring(F.md5(F.col(name)), 1, 2))
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (df.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
               .drop("n"))
    inside = W.partitionBy("bucket").orderBy(name)
    return (df.join(offsets, "bucket")
            .withColumn(out, (F.col("offset") + F.row_number().over(inside) + start - 1).cast("int"))
            .drop("offset", "bucket"))
