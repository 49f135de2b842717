"""Headline timings: one JSON line with seconds per query (warm) at $BENCH_SF_DIR on local[$BENCH_CPUS].

`load_rows_per_sec` times text station lines parsed and written as long parquet, the reference's one published
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridspark.catalog import QUERIES  # noqa: E402
from gridspark.catalog.source_queries import isd_lines  # noqa: E402
from gridspark.session import get_spark, materialize, scratch_path  # noqa: E402
from gridspark.sources import weather  # noqa: E402

HEADLINE = [
    "series_explode", "isd_long", "eba_load", "period_explode", "upsert_last_wins", "star_eba", "pivot_mean",
    "calendar_fill", "flow_balance", "series_stats", "quality_counts", "corr_matrix", "remove_na", "avg_extremes",
    "moving_avg", "seasonal_decompose", "acf", "run_boundaries", "fourier_fit", "temp_gradient", "walk_forward",
    "rate_gradient", "power_bins", "scoreboard",
]
# timed once after a warm-up and summed apart, so that the headline total stays comparable between rounds
HEAVY = ["seq_windows", "pacf", "onestep", "temp_fit", "lag_regression", "rate_search", "fft_detrend", "clean_forecast_scores",
         "scoreboard_models", "meter_runs", "stream_hourly"]


def timed(spark, name: str, sf: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def load_rate(spark, sf: str, copies: int = 20, compression: str = "none") -> float:
    """Rows per second from text lines to long parquet rows; the lines are written as text first, untimed."""
    source = scratch_path(spark, "bench-lines")
    lines = isd_lines(spark, sf)
    for _ in range(copies):
        lines.select("callsign", "value").write.mode("append").partitionBy("callsign").text(source, compression=compression)
    start = time.perf_counter()
    wide = weather.parse_isd_lines(spark.read.text(source), ["callsign"])
    rows = materialize(weather.to_long(wide), "bench-isd")
    seconds = time.perf_counter() - start
    return rows.count() / seconds


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8,
                      **{"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:] or HEADLINE
    times = {}
    for name in only:
        timed(spark, name, sf)
        times[name] = round(min(timed(spark, name, sf) for _ in range(2)), 3)
        if sys.argv[1:]:
            print(name, times[name], file=sys.stderr)
    out = {"metric": "headline_total_warm", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
           "sf": sf.rstrip("/").split("sf")[-1], "cpus": cpus}
    if not sys.argv[1:]:
        out["load_rows_per_sec"] = round(load_rate(spark, sf))
        out["load_gz_rows_per_sec"] = round(load_rate(spark, sf, compression="gzip"))
        heavy = {}
        for name in HEAVY:
            timed(spark, name, sf)
            heavy[name] = round(timed(spark, name, sf), 3)
        out["heavy"], out["heavy_total"] = heavy, round(sum(heavy.values()), 3)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
