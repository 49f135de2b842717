"""Explicit schemas of the raw inputs and of the long tables; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# One JSON line. `data` pairs mix a text period and a number, so both are read as text and cast later.
SERIES_DOC = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("start", T.StringType()),
    T.StructField("end", T.StringType()),
    T.StructField("f", T.StringType()),
    T.StructField("childseries", T.ArrayType(T.StringType())),
    T.StructField("data", T.ArrayType(T.ArrayType(T.StringType()))),
])

METER_CSV = T.StructType([
    T.StructField("ID", T.StringType()),
    T.StructField("LocalDateTime", T.StringType()),
    T.StructField("kWh", T.DoubleType()),
])

EBA = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("measure", T.StringType()),
    T.StructField("val", T.DoubleType()),
])

EBA_INTER = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("dest", T.StringType()),
    T.StructField("val", T.DoubleType()),
])

DIM = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("full_name", T.StringType()),
    T.StructField("abbr", T.StringType()),
])

ISD = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("callsign", T.StringType()),
    T.StructField("measure", T.StringType()),
    T.StructField("val", T.DoubleType()),
])

EBA_REJECT = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("pair", T.ArrayType(T.StringType())),
    T.StructField("reason", T.StringType()),
])

ISD_REJECT = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("line", T.StringType()),
    T.StructField("reason", T.StringType()),
])

# First day of the month of `ts`; the warehouse derives it, so frames need not carry it
MONTH = T.StructField("month", T.DateType())

# Table name -> (schema, partition columns)
WAREHOUSE = {
    "eba": (T.StructType([*EBA.fields, MONTH]), ["measure", "month"]),
    "eba_inter": (T.StructType([*EBA_INTER.fields, MONTH]), ["month"]),
    "eba_rejects": (EBA_REJECT, []),
    "eba_meta": (DIM, []),
    "eba_measure": (DIM, []),
    "isd": (T.StructType([*ISD.fields, MONTH]), ["measure", "month"]),
    "isd_rejects": (ISD_REJECT, []),
    "isd_meta": (T.StructType([
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("callsign", T.StringType()),
        T.StructField("usaf", T.StringType()),
        T.StructField("wban", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType()),
    ]), []),
    "isd_measure": (T.StructType([
        T.StructField("id", T.IntegerType()),
        T.StructField("measure", T.StringType()),
    ]), []),
    "elec_gen": (T.StructType([
        T.StructField("series_id", T.StringType()),
        T.StructField("obs_date", T.DateType()),
        T.StructField("obs_val", T.DoubleType()),
    ]), []),
}
