"""Micro-batches as folders, and compaction that readers follow.

Batch n lies in `path/batch=n`, so a retried batch overwrites itself. A compaction writes all batches before the newest one (which
may still be in writing) as one snapshot beside them; readers take the latest snapshot and the batches after it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def _snapshots(spark: SparkSession, path: str) -> DataFrame | None:
    """All snapshots with the number of the last batch they hold (`batch`); None before the first compaction."""
    try:
        return spark.read.parquet(f"{path}-snapshots")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the latest snapshot and of all later batches, with their `batch`."""
    rows, old = spark.read.parquet(path), _snapshots(spark, path)
    if old is None:
        return rows
    last = old.agg(F.max("batch")).first()[0]
    return old.where(F.col("batch") == last).unionByName(rows.where(F.col("batch") > last))


def compact(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Write `merge` of all rows before the newest batch as a snapshot; nothing to do where there are none.

    `merge` must give the same result over snapshots and batches as over the batches alone.
    """
    newest = spark.read.parquet(path).agg(F.max("batch")).first()[0]
    rows = read_batches(spark, path).where(F.col("batch") < newest)
    last = rows.agg(F.max("batch")).first()[0]
    if last is not None:
        old = _snapshots(spark, path)
        if old is None or old.where(F.col("batch") == last).isEmpty():
            merge(rows).drop("batch").write.mode("overwrite").parquet(f"{path}-snapshots/batch={last}")
