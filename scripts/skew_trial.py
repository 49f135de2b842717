"""python scripts/skew_trial.py [--rows 6000000] [--series 40]

Times the chunked operators on hourly rows of which one series holds a third, with broadcasts off, and prints one JSON line: seconds
per operator and the largest share of the rows that one partition holds after the calendar.
"""

import argparse
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from gridspark.functions import timefn  # noqa: E402
from gridspark.models import smoothing, spectral  # noqa: E402
from gridspark.operators import align, quality, series  # noqa: E402
from gridspark.session import get_spark, materialize  # noqa: E402

K = ["series"]


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--rows", type=int, default=6_000_000)
    parser.add_argument("--series", type=int, default=40)
    parser.add_argument("--master", default="local[8]")
    a = parser.parse_args()
    spark = get_spark("skew-trial", a.master, 64, **{
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    long = a.rows // 3
    short = (a.rows - long) // (a.series - 1)
    n = F.col("id")
    owner = F.when(n < long, F.lit(0)).otherwise(F.least(F.floor((n - long) / short) + 1, F.lit(a.series - 1)))
    place = F.when(n < long, n).otherwise(n - long - (F.col("k") - 1) * short)
    wave = 50 + 10 * F.sin(F.col("slot") * 6.283185307 / 24) + F.pmod(F.xxhash64("slot", "series"), F.lit(100)) / 50
    rows = (spark.range(long + short * (a.series - 1)).withColumn("k", owner).withColumn("slot", place)
            .withColumn("series", F.concat(F.lit("s"), "k")))
    rows = materialize(rows.select("series", "slot", timefn.slot_ts("slot").alias("ts"),
                                   F.when(F.col("slot") % 997 != 5, wave).alias("val")), "skew-rows")
    calendar = align.calendar_fill(rows, K, ["val"])
    full = materialize(quality.remove_na(calendar, K, "val", 24), "skew-full")
    jobs = {
        "calendar": lambda: calendar,
        "calendar_clean": lambda: quality.avg_extremes(quality.remove_na(calendar, K, "val", 24), K, "val", 24),
        "moving_avg": lambda: series.moving_avg(full, K),
        "decompose": lambda: series.seasonal_decompose(full, K),
        "acf": lambda: series.acf(full, K),
        "seq_windows": lambda: series.seq_windows(full, K, "val", "val", 24),
        "run_boundaries": lambda: series.run_series(series.run_boundaries(rows, "series", ["series", "ts"]), "series", "ts", "val"),
        "walk_forward": lambda: smoothing.walk_forward(full, K, smoothing.Params(alpha=0.1, beta=0.1), ninit=14 * 24),
        "fft_detrend": lambda: spectral.fft_detrend(full, K),
    }
    seconds = {}
    for name, job in jobs.items():
        start = time.perf_counter()
        job().write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 2)
    parts = calendar.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count"), F.count("*")).first()
    print(json.dumps({"rows": rows.count(), "largest_series": round(1 / 3, 3), "seconds": seconds,
                      "fullest_partition": round(parts[0] / parts[1], 3), "partitions": parts[2]}))


if __name__ == "__main__":
    main()
