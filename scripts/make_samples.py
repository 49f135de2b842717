"""spark-submit scripts/make_samples.py OUT --start-date 2016-01-01 --end-date 2017-01-01 [--n-data 1000] [--test-split 0.1]

Draws whole days of demand per source from the loaded table and writes them as JSON, labelled train or test.
"""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from gridspark.operators import align, series  # noqa: E402
from gridspark.session import get_spark  # noqa: E402
from gridspark.sources import sinks  # noqa: E402


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("out")
    parser.add_argument("--database", default="default")
    parser.add_argument("--start-date", required=True)
    parser.add_argument("--end-date", required=True)
    parser.add_argument("--n-data", type=int, default=1000)
    parser.add_argument("--test-split", type=float, default=0.1)
    parser.add_argument("--seed", type=int, default=7653)
    a = parser.parse_args()
    spark = get_spark("make-samples")
    demand = spark.table(f"{a.database}.eba").where("measure = 'D'").select("source", "ts", "val")
    rows = series.split_half(align.calendar_fill(demand, ["source"], ["val"]), ["source"], ratio=1 - a.test_split)
    picked = series.sample_windows(rows, ["source"], a.n_data, 24, a.seed, every=24, after=a.start_date, until=a.end_date)
    days = picked.groupBy("source", "sample").agg(
        F.min("part").alias("part"), F.sort_array(F.collect_list(F.struct("step", "ts", "val"))).alias("r"))
    sinks.write_json(days.select("source", "sample", "part", F.col("r.ts").alias("t"), F.col("r.val").alias("dem")), a.out)


if __name__ == "__main__":
    main()
