"""spark-submit scripts/load_isd.py FOLDER AIRPORTS.csv HISTORY.txt [--database grid] [--drop-tables] [--zero-as-null]"""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from gridspark.operators import grid  # noqa: E402
from gridspark.plans.load import load_isd  # noqa: E402
from gridspark.session import get_spark, materialize  # noqa: E402
from gridspark.sources import weather  # noqa: E402


def main() -> None:
    parser = argparse.ArgumentParser()
    for name in ("folder", "airports", "history"):
        parser.add_argument(name)
    parser.add_argument("--database", default="default")
    parser.add_argument("--drop-tables", action="store_true")
    parser.add_argument("--zero-as-null", action="store_true")
    a = parser.parse_args()
    spark = get_spark("load-isd")
    merged = weather.merge_stations(
        weather.airport_filter(weather.read_airports(spark, a.airports)),
        weather.read_station_history(spark, a.history), ["USAF", "WBAN"])
    stations = grid.dense_ids(merged, "CALL").select(
        "id", "name", F.col("City").alias("city"), F.col("ST").alias("state"), F.col("CALL").alias("callsign"),
        F.col("USAF").alias("usaf"), F.col("WBAN").alias("wban"), F.col("LAT").alias("lat"), F.col("LON").alias("lng"))
    load_isd(spark, a.folder, materialize(stations, "stations"), a.database, a.drop_tables, a.zero_as_null).show(1000)


if __name__ == "__main__":
    main()
