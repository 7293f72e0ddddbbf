"""Explicit schemas: nothing in the engine infers types from data."""

from pyspark.sql import types as T

# Raw interaction log as delivered (CSV with header).
RAW_LOG_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("behavior_type", T.IntegerType()),
    T.StructField("user_geohash", T.StringType()),
    T.StructField("item_category", T.LongType()),
    T.StructField("time", T.StringType()),  # "YYYY-MM-DD HH"
])

# Target item table; only item_id is used.
ITEM_SCHEMA = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("item_geohash", T.StringType()),
    T.StructField("item_category", T.LongType()),
])

# Cleaned log, stored as Parquet partitioned by ``day``.
CLEAN_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("item_category", T.LongType()),
    T.StructField("behavior_type", T.IntegerType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("day", T.DateType()),
])

CLEAN_COLUMNS = [f.name for f in CLEAN_SCHEMA.fields]
