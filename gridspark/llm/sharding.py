"""Sharding by largest differencing (Karmarkar and Karp): shards of nearly equal bytes from indivisible groups.

Groups are equal texts. A partial partition is a tuple of `shards` byte sums in falling order. Again and again the two partial
partitions with the largest spread (first minus last sum) are combined, one in falling and one in rising order. First
each of some thousand buckets of groups is differenced in a task of its own, into as many parts as there are shards. The
parts of all buckets are then indivisible in a last differencing, whose input is bounded by the number of buckets: so a
heavy group, which stands alone in its part, can be made up for by the parts of other buckets.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.session import materialize

BUCKETS, MAX_BUCKETS = 1 << 10, 1 << 13


def difference(partials: list[list[int]]) -> list[list[int]]:
    """Where each slot of each partial partition goes: result[i][k] is the final part of slot k of partials[i].

    Slots of a partial are given in falling order. Ties go to the partial that came first.
    """
    width = len(partials[0])
    heap = [(s[-1] - s[0], i) for i, s in enumerate(partials)]
    heapq.heapify(heap)
    sums = [list(s) for s in partials]
    made: list[tuple[int, int, list[int]]] = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        joined = [x + y for x, y in zip(sums[a], reversed(sums[b]))]
        order = sorted(range(width), key=joined.__getitem__, reverse=True)
        made.append((a, b, order))
        sums[a] = sums[b] = []
        sums.append([joined[k] for k in order])
        heapq.heappush(heap, (sums[-1][-1] - sums[-1][0], len(sums) - 1))
    goes: list[list[int]] = [[] for _ in sums]
    goes[heap[0][1]] = list(range(width))
    for node in range(len(sums) - 1, len(partials) - 1, -1):
        a, b, order = made[node - len(partials)]
        where = goes[node]
        goes[a], goes[b] = [0] * width, [0] * width
        for k, i in enumerate(order):
            goes[a][i] = where[k]
            goes[b][width - 1 - i] = where[k]
        goes[node] = []
    return goes[:len(partials)]


def _bucket_parts(shards: int):
    def parts(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "key"], ascending=[False, True])
        rest = [0] * (shards - 1)
        goes = difference([[b, *rest] for b in pdf["bytes"].tolist()])
        return pd.DataFrame({"key": pdf["key"], "bytes": pdf["bytes"], "bucket": pdf["bucket"],
                             "part": np.array([g[0] for g in goes], np.int32)})

    return parts


def _place(shards: int):
    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "bucket", "part"], ascending=[False, True, True])
        rest = [0] * (shards - 1)
        goes = difference([[b, *rest] for b in pdf["bytes"].tolist()])
        return pd.DataFrame({"bucket": pdf["bucket"], "part": pdf["part"], "shard": np.array([g[0] for g in goes], np.int32)})

    return place


def assign(docs: DataFrame, shards: int = 8, buckets: int | None = None) -> DataFrame:
    """Every row of (doc_id, text) in a shard: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the UTF-8 bytes of the text plus 1 (null: 1, and of the same group as the empty text). Equal texts share a
    shard whatever their weight, so a group above a shard's share sets the largest shard. slot counts from 0
    without gaps inside a shard, in an order that doc_id and the rows' slices fix; rows alike in all columns
    take neighbouring slots. Null doc_ids are kept. An empty table gives no rows. grown_shard is null under this law.
    """
    spark = docs.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(buckets or max(BUCKETS, slices), MAX_BUCKETS)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("key"))
    groups = (rows.groupBy("key").agg(F.sum("size").alias("bytes"))
              .withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")))
    parts = materialize(groups.groupBy("bucket").applyInPandas(
        _bucket_parts(shards), "key string, bytes long, bucket int, part int"), "shard-parts")
    place = (parts.groupBy("bucket", "part").agg(F.sum("bytes").alias("bytes"))
             .groupBy().applyInPandas(_place(shards), "bucket int, part int, shard int"))
    where = parts.join(place, ["bucket", "part"]).select("key", "shard")
    placed = materialize(
        rows.join(where, "key").select("doc_id", "size", "text_crc32", "shard",
                                       F.pmod(F.xxhash64("doc_id"), F.lit(slices)).cast("int").alias("slice")), "shard-rows")
    before = (placed.groupBy("shard", "slice").count()
              .withColumn("before", F.coalesce(F.sum("count").over(
                  Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    rank = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32", "size"))
    return (placed.withColumn("rank", rank).join(before, ["shard", "slice"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("before") + F.col("rank") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
