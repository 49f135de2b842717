"""A stream merged into a table by month (extension): the newest value of a key counts, whenever its batch arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridspark.sources import warehouse

LEDGER = "_batches"


def create(spark: SparkSession, table: str, stream: DataFrame, keys: list[str], value: str, order: str, database: str = "default") -> None:
    """The table and the ledger of its batches, unless they are there: keys, value and order by month of `ts`."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.select(*keys, value, order).schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}, month date) USING parquet PARTITIONED BY (month)")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table}{LEDGER} (batch bigint, n_rows bigint) USING parquet")


def merge_batch(batch: DataFrame, table: str, keys: list[str], value: str, order: str, database: str = "default") -> None:
    """Merge rows into the months they fall into.

    The value of the highest `order` stays (ties: the largest value), be it the table's or the batch's, so merging is
    commutative and repeatable: a replayed or a reordered batch changes nothing that one load of all rows would not.
    """
    spark = batch.sparkSession
    new = batch.select(*keys, value, order).withColumn("month", warehouse.month_of("ts"))
    current = spark.table(f"{database}.{table}")
    # an equality join prunes months at run time, but loses that of unreadable times
    touched = current.join(new.select("month").distinct(), "month", "left_semi").unionByName(current.where("month is null"))
    best = F.max(F.struct(F.col(order).alias("order"), F.col(value).alias("value"))).alias("_best")
    merged = (touched.unionByName(new).repartition(*[k for k in keys if k != "ts"] or keys).groupBy(*keys, "month").agg(best)
              .select(*keys, F.col("_best.value").alias(value), F.col("_best.order").alias(order), "month"))
    warehouse.replace_partitions(merged, table, database)


def merge_stream(stream: DataFrame, table: str, checkpoint: str, keys: list[str], value: str, order: str,
                 database: str = "default") -> StreamingQuery:
    """Merge each micro-batch into the table; no batch is kept beside it.

    The ledger gets a batch's id after its months are in place. A batch that the ledger holds is passed over; one that
    failed in between is merged again, which changes nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        ledger = batch.sparkSession.table(f"{database}.{table}{LEDGER}")
        if not ledger.where(F.col("batch") == batch_id).isEmpty():
            return
        n = batch.count()
        if n:
            merge_batch(batch, table, keys, value, order, database)
        (batch.sparkSession.createDataFrame([(batch_id, n)], "batch bigint, n_rows bigint")
         .write.insertInto(f"{database}.{table}{LEDGER}"))

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
