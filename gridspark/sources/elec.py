"""Monthly, quarterly and annual series stored as one text row per series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.functions import timefn


def read_elec(spark: SparkSession, paths: list[str], schema: T.StructType | None = None) -> DataFrame:
    """JSON-lines chunks into one frame of text columns; a column absent from a chunk is NULL.

    Without a schema Spark infers one over all chunks, which reads them twice.
    """
    reader = spark.read.option("primitivesAsString", True)
    return as_text(reader.schema(schema).json(paths) if schema else reader.json(paths))


def as_text(df: DataFrame) -> DataFrame:
    """Nested values as JSON text, everything else as string."""
    def cell(f: T.StructField) -> Column:
        nested = isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
        return (F.to_json(f.name) if nested else F.col(f.name).cast("string")).alias(f.name)

    return df.select(*[cell(f) for f in df.schema.fields])


def union_chunks(*chunks: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [as_text(c) for c in chunks])


def period_explode(df: DataFrame, keep: list[str], data: str = "data", freq: str = "f") -> DataFrame:
    """Stringified `[[period, value], ...]` to one row per period (start date, value). The text is parsed as JSON,
    never evaluated; unreadable text gives no rows, unreadable periods or values give NULL."""
    pairs = F.from_json(data, "array<array<string>>")
    return (df.select(*keep, freq, F.explode(pairs).alias("d"))
            .select(*keep, freq, timefn.period_start(F.get("d", F.lit(0)), freq).alias("obs_date"),
                    F.get("d", F.lit(1)).try_cast("double").alias("obs_val")))
