"""Calendars, star joins, pivots and windows that line several series up on time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridspark.functions import timefn
from gridspark.operators import grid


def calendar_rejects(df: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """The rows that no calendar can hold, with all their columns and a `reason`: 'key' or 'time' is NULL."""
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    reason = F.when(no_key, F.lit("key")).when(F.col(ts).isNull(), F.lit("time"))
    return df.withColumn("reason", reason).where(F.col("reason").isNotNull())


def calendar_fill(df: DataFrame, keys: list[str], values: list[str], ts: str = "ts", step: int = timefn.HOUR,
                  common: bool = False, size: int = grid.CHUNK) -> DataFrame:
    """Put each series on a regular calendar; missing steps become rows with NULL values.

    Run this before any lag, block or cleaning operator: those count rows, so a gap would shift them.
    `common=True` gives all series the calendar from the overall first to the overall last step.

    The rows are shuffled once, by (series, chunk). Inside a chunk each row also produces the empty steps since
    the row before it, and the last one those up to the chunk's end; chunks without rows come from the spans.
    Rows with a NULL key or time belong to no calendar: `calendar_rejects` returns them.
    Output: keys, chunk number, slot, ts, values.
    """
    chunk = grid.chunk_col(size)
    facts = df.select(*keys, timefn.slot_of(ts, step).alias("at"), *values).dropna(subset=[*keys, "at"])
    spans = facts.groupBy(*keys).agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    if common:
        spans = spans.select(*keys, facts.agg(F.min("at")).scalar().alias("lo"),
                             facts.agg(F.max("at")).scalar().alias("hi"))
    bounds = grid.spread(spans, size).select(
        *keys, chunk, F.greatest("lo", F.col(chunk) * size).alias("begin"),
        F.least("hi", F.col(chunk) * size + (size - 1)).alias("end"))
    rows = facts.withColumn(chunk, grid.chunk_of(F.col("at"), size)).join(
        bounds.hint("shuffle_hash"), [*keys, chunk], "right")
    inside = W.partitionBy(*keys, chunk).orderBy("at")
    previous, following = F.lag("at").over(inside), F.lead("at").over(inside)
    # least() keeps repeated rows of one step as they are
    begin = F.when(previous.isNull(), F.col("begin")).otherwise(F.least(previous + 1, F.col("at")))
    rows = (rows.withColumn("from", begin)
            .withColumn("to", F.when(following.isNull(), F.col("end")).otherwise(F.col("at"))))
    rows = rows.withColumn("slot", F.explode(F.sequence("from", "to")))
    here = F.col("slot") == F.col("at")
    return rows.select(*keys, chunk, "slot", timefn.slot_ts("slot", step).alias(ts),
                       *[F.when(here, F.col(v)).alias(v) for v in values])


def star(fact: DataFrame, *lookups: tuple[DataFrame, str, dict[str, str]]) -> DataFrame:
    """Inner join a fact with dimensions: each lookup is (dim, fact id column, {dim column: output name}).

    No broadcast hint: Spark broadcasts a dimension when its measured size allows it and otherwise
    sorts and merges, splitting hot ids at run time.
    """
    def join(left: DataFrame, lookup: tuple) -> DataFrame:
        dim, fact_id, columns = lookup
        right = dim.select(F.col("id").alias(fact_id), *[F.col(c).alias(n) for c, n in columns.items()])
        return left.join(right, fact_id)

    return reduce(join, lookups, fact)


def pivot_mean(df: DataFrame, index: str, name: str, value: str, names: list[str]) -> DataFrame:
    """Time x name matrix of means over distinct rows; times without any value do not appear.

    The column list is given, so no extra job looks for it.
    """
    rows = df.select(index, name, value).dropDuplicates().where(F.col(value).isNotNull())
    return rows.groupBy(index).pivot(name, names).agg(F.avg(value))


def outer_align(df: DataFrame, index: str, name: str, value: str, names: list[str]) -> DataFrame:
    """Full outer alignment of series on the union of their times: one shuffle on time."""
    return df.groupBy(index).pivot(name, names).agg(F.first(value, ignorenulls=True))


def drop_empty_series(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Drop series whose values are all NULL."""
    filled = df.where(F.col(value).isNotNull()).select(*keys).distinct()
    return df.join(filled, keys, "left_semi")


def demand_weather(demand: DataFrame, weather: DataFrame, stations: dict[str, Column], ts: str = "ts") -> DataFrame:
    """Left join demand with one temperature column per station; `stations` maps column name -> row condition."""
    temps = weather.groupBy(ts).agg(*[F.max(F.when(cond, F.col("temp"))).alias(c) for c, cond in stations.items()])
    return demand.join(temps, ts, "left")


def input_target_windows(df: DataFrame, t1: str, t2: str, t3: str, measures: dict[str, str],
                         keys: list[str], ts: str = "ts") -> DataFrame:
    """Rows of `(t1, t2]` labelled input and `(t2, t3]` labelled target, one column per measure.

    Distinct rows only; a cell is the mean of its values. All measures and both windows come from one scan.
    """
    label = F.when(timefn.half_open(ts, t1, t2), F.lit("input")).otherwise(F.lit("target"))
    rows = (df.where(timefn.half_open(ts, t1, t3) & F.col("measure").isin(*measures))
            .select(*keys, ts, "measure", "val").dropDuplicates())
    cells = [F.avg(F.when(F.col("measure") == m, F.col("val"))).alias(c) for m, c in measures.items()]
    return rows.groupBy(label.alias("part"), *keys, ts).agg(*cells)


def dim_enrich(facts: DataFrame, dim: DataFrame, titles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Complete a dimension with names taken from series titles.

    facts: column `abbr`; dim: (id, full_name, abbr); titles: (abbr, full_name) pairs parsed from titles.
    Returns the enlarged dimension and the abbreviations still unknown, which must be empty for a good load.
    """
    wanted = facts.select("abbr").where(F.col("abbr").isNotNull()).distinct()
    missing = wanted.join(dim, "abbr", "left_anti")
    named = titles.groupBy("abbr").agg(F.max("full_name").alias("full_name"))
    found = missing.join(named, "abbr")
    last = dim.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    new = grid.dense_ids(found, "abbr").select((F.col("id") + last).cast("int").alias("id"), "full_name", "abbr")
    return dim.select("id", "full_name", "abbr").unionByName(new), missing.join(named, "abbr", "left_anti")


def reconcile_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys found on one side only, with the side that has them."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    only_left = a.join(b, key, "left_anti").withColumn("side", F.lit("left"))
    return only_left.unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def flow_balance(flows: DataFrame, source: str = "source", dest: str = "dest", ts: str = "ts",
                 val: str = "val") -> DataFrame:
    """A->B against B->A: both directions of a pair meet in one aggregation, without a self-join."""
    a, b = F.least(source, dest), F.greatest(source, dest)
    forward = F.sum(F.when(F.col(source) <= F.col(dest), F.col(val)))
    back = F.sum(F.when(F.col(source) > F.col(dest), F.col(val)))
    return (flows.where(F.col(source) != F.col(dest))
            .groupBy(ts, a.alias("a"), b.alias("b"))
            .agg(forward.alias("forward"), back.alias("back"))
            .withColumn("imbalance", F.coalesce("forward", F.lit(0.0)) + F.coalesce("back", F.lit(0.0))))
