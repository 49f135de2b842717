"""From long facts to time x series records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.functions import timefn
from gridspark.operators import align
from gridspark.sources import sinks


def measure_record(fact: DataFrame, sources: DataFrame, measures: DataFrame, measure: str, t1: str, t2: str,
                   names: list[str], source_id: str = "source_id", label: str = "abbr",
                   measure_name: str = "full_name") -> DataFrame:
    """One measure over `(t1, t2]` as a time x source matrix: slice, star join, distinct, pivot in one plan."""
    rows = fact.where(timefn.half_open("ts", t1, t2))
    wanted = measures.where(F.col(measure_name) == measure)
    starred = align.star(rows, (wanted, "measure_id", {}), (sources, source_id, {label: "name"}))
    return align.pivot_mean(starred, "ts", "name", "val", names)


def window_records(df: DataFrame, keys: list[str], t1: str, t2: str, t3: str, measures: dict[str, str]) -> DataFrame:
    """Input and target records as JSON per key and day: time, demand, temperature and forecast arrays.

    A record holds one day of one key, so arrays stay short whatever the window.
    """
    rows = align.input_target_windows(df, t1, t2, t3, measures, keys)
    packed = rows.groupBy("part", *keys, F.to_date("ts").alias("day")).agg(
        F.sort_array(F.collect_list(F.struct("ts", *measures.values()))).alias("r"))
    record = sinks.record_json({"t": F.transform("r.ts", lambda x: F.date_format(x, "yyyy-MM-dd HH:mm:ss")),
                                **{c: F.col(f"r.{c}") for c in measures.values()}})
    return packed.select("part", *keys, "day", record.alias("record"))
