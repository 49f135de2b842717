"""Find and repair bad observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridspark.operators import grid


def find_dups(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def high_or_zero(val: Column, mean: Column, std: Column, sigmas: float = 4.0) -> Column:
    """Above the mean by more than `sigmas` sample deviations, or exactly 0; NULL counts as neither."""
    return F.coalesce((val - mean > sigmas * std) | (val == 0), F.lit(False))


def quality_counts(df: DataFrame, keys: list[str], val: str = "val", sigmas: float = 4.0,
                   size: int = grid.CHUNK) -> DataFrame:
    """Per series: rows, NULLs, zeros and high outliers. Needs `slot`."""
    v = F.col(val)
    stats = grid.series_stats(df, keys, F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"))
    rows = grid.attach(df, stats, keys, size)
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(v.isNull()).alias("n_null"),
        F.count_if(v - F.col("mean") > sigmas * F.col("std")).alias("n_high"),
        F.count_if(v == 0).alias("n_zero"),
    )


def _carry(df: DataFrame, keys: list[str], val: str, window: int, size: int, fill_mean: bool) -> DataFrame:
    """Replace rows with `keep` false by the row `window` steps earlier, in order, so that replacements cascade.

    Within one residue class of slots (slot mod window) this is the last kept value. Before the first kept row
    of a class the look-back wraps around to the raw end of the series, as negative positions do.
    """
    v, slot, keep, chunk = F.col(val), F.col("slot"), F.col("keep"), grid.chunk_col(size)
    df = grid.with_chunk(df, size).withColumn("residue", F.pmod(slot, F.lit(window)))
    parts = df.groupBy(*keys, chunk, "residue").agg(
        F.max_by(v, F.when(keep, slot)).alias("kept"),
        F.max(F.when(keep, slot)).alias("kept_slot"),
        F.max_by(v, slot).alias("end_val"),
        F.min(slot).alias("first_slot"), F.max(slot).alias("last_slot"),
        F.sum(v).alias("total"), F.count(v).alias("n"),
    )
    whole, cls = W.partitionBy(*keys), W.partitionBy(*keys, "residue")
    earlier = cls.orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    carried = F.last(F.when(F.col("kept_slot").isNotNull(), F.struct(F.col("kept").alias("v"))), ignorenulls=True)
    parts = parts.withColumns({
        "carry": carried.over(earlier), "mean": F.sum("total").over(whole) / F.sum("n").over(whole),
        "lo": F.min("first_slot").over(whole), "hi": F.max("last_slot").over(whole),
        "class_start": F.min("first_slot").over(cls), "class_end": F.max("last_slot").over(cls)})
    # the last `window` slots, one per class: where each is found from, counted from the start that wraps onto it
    tail = F.struct((F.col("class_end") - (F.col("hi") + 1 - window)).alias("position"), F.col("end_val").alias("v"))
    tails = F.collect_list(F.when(F.col("last_slot") == F.col("class_end"), tail)).over(whole)
    parts = parts.withColumns({"position": F.col("class_start") - F.col("lo"), "tails": F.map_from_entries(tails)})
    wrapped = F.element_at("tails", F.col("position"))
    if fill_mean:
        wrapped = F.coalesce(wrapped, "mean")
    seed = F.coalesce("carry", F.struct(wrapped.alias("v")))
    # `window` entries per chunk
    seeds = parts.select(*keys, chunk, F.struct("residue", seed.alias("seed")).alias("entry")).groupBy(
        *keys, chunk).agg(F.map_from_entries(F.collect_list("entry")).alias("seeds"))
    inside = (W.partitionBy(*keys, chunk, "residue").orderBy("slot")
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    last_kept = F.last(F.when(keep, F.struct(v.alias("v"))), ignorenulls=True).over(inside)
    rows = df.join(seeds.hint("shuffle_hash"), [*keys, chunk])
    fixed = F.coalesce(last_kept, F.element_at("seeds", F.col("residue")))["v"]
    return rows.withColumn(val, fixed).drop("residue", "keep", "seeds")


def _both_sides(df: DataFrame, keys: list[str], val: str, window: int, size: int) -> DataFrame:
    """Replace rows with `keep` false by the mean of the nearest kept rows before and after, a multiple of
    `window` steps away; one of them alone at the edges, NULL if there is none."""
    v, slot, keep, chunk = F.col(val), F.col("slot"), F.col("keep"), grid.chunk_col(size)
    df = grid.with_chunk(df, size).withColumn("residue", F.pmod(slot, F.lit(window)))
    kept = F.when(keep & v.isNotNull(), v)
    kept_slot = F.when(keep & v.isNotNull(), slot)
    parts = df.groupBy(*keys, chunk, "residue").agg(
        F.max_by(v, kept_slot).alias("end_kept"), F.min_by(v, kept_slot).alias("start_kept"))
    cls = W.partitionBy(*keys, "residue").orderBy(chunk)
    before = F.last("end_kept", ignorenulls=True).over(cls.rowsBetween(W.unboundedPreceding, -1))
    after = F.first("start_kept", ignorenulls=True).over(cls.rowsBetween(1, W.unboundedFollowing))
    entry = F.struct("residue", F.struct(before.alias("before"), after.alias("after")).alias("seed"))
    seeds = parts.select(*keys, chunk, entry.alias("entry")).groupBy(*keys, chunk).agg(
        F.map_from_entries(F.collect_list("entry")).alias("seeds"))
    inside = W.partitionBy(*keys, chunk, "residue").orderBy("slot")
    seed = F.element_at("seeds", F.col("residue"))
    left = F.coalesce(F.last(kept, ignorenulls=True).over(inside.rowsBetween(W.unboundedPreceding, W.currentRow)),
                      seed["before"])
    right = F.coalesce(F.first(kept, ignorenulls=True).over(inside.rowsBetween(W.currentRow, W.unboundedFollowing)),
                       seed["after"])
    rows = df.join(seeds.hint("shuffle_hash"), [*keys, chunk])
    mean = (F.coalesce(left, right) + F.coalesce(right, left)) / 2
    return rows.withColumn(val, F.when(keep, v).otherwise(mean)).drop("residue", "keep", "seeds")


def _repair(df: DataFrame, keys: list[str], val: str, window: int, side: str, size: int, fill_mean: bool) -> DataFrame:
    if side == "both":
        return _both_sides(df, keys, val, window, size)
    return _carry(df, keys, val, window, size, fill_mean)


def remove_na(df: DataFrame, keys: list[str], val: str = "val", window: int = 2, side: str = "back",
              size: int = grid.CHUNK) -> DataFrame:
    """Fill NULLs with the value `window` steps earlier (24 = the day before), in order; the first steps wrap to
    the series' end, whose NULLs count as the series mean. `side='both'` takes the mean of the nearest values
    before and after instead. Needs consecutive `slot`s, `window` of them at least.
    """
    return _repair(df.withColumn("keep", F.col(val).isNotNull()), keys, val, window, side, size, fill_mean=True)


def avg_extremes(df: DataFrame, keys: list[str], val: str = "val", window: int = 2, sigmas: float = 4.0,
                 side: str = "back", size: int = grid.CHUNK) -> DataFrame:
    """Replace zeros and values above mean + 4 deviations by the value `window` steps earlier, in order.

    The mask is taken once from the raw series. NULLs are neither masked nor filled. `side` as in `remove_na`.
    Needs consecutive `slot`s.
    """
    v = F.col(val)
    stats = grid.series_stats(df, keys, F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"))
    bad = high_or_zero(v, F.col("mean"), F.col("std"), sigmas)
    marked = grid.attach(df, stats, keys, size, windowed=True).withColumn("keep", ~bad).drop("mean", "std", "lo", "hi")
    return _repair(marked, keys, val, window, side, size, fill_mean=False)


def identity_residual(df: DataFrame, index: list[str], demand: str, generation: str, interchange: str,
                      code_sign: bool = False) -> DataFrame:
    """Demand - (generation - interchange) per step; `code_sign` gives demand - (interchange - generation)."""
    def pick(measure: str) -> Column:
        return F.sum(F.when(F.col("measure") == measure, F.col("val")))

    rows = (df.where(F.col("measure").isin(demand, generation, interchange)).groupBy(*index)
            .agg(pick(demand).alias("demand"), pick(generation).alias("generation"),
                 pick(interchange).alias("interchange")))
    net = F.col("generation") - F.col("interchange")
    return rows.withColumn("residual", F.col("demand") + net if code_sign else F.col("demand") - net)
