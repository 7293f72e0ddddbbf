"""Readers for the production inputs (CSV log and item table, Parquet clean log)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BEHAVIORS
from .schemas import CLEAN_SCHEMA, ITEM_SCHEMA, RAW_LOG_SCHEMA

#: fixed form of the time column: a day and an hour 0..23
TIME_FORM = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} ([01][0-9]|2[0-3])$"


def _csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """CSV with a header that must name the schema's columns in order; a
    malformed row fails the read."""
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("mode", "FAILFAST").csv(path))


def read_raw_log_csv(spark: SparkSession, path: str, schema=RAW_LOG_SCHEMA) -> DataFrame:
    return _csv(spark, path, schema)


def read_item_table_csv(spark: SparkSession, path: str, schema=ITEM_SCHEMA) -> DataFrame:
    return _csv(spark, path, schema).select("item_id")


#: what a delivered log row can be rejected for, in the order in which it is tested
REJECT_REASONS = ("malformed", "no_user", "no_item", "bad_behavior", "bad_time")


def read_raw_log_tolerant(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects) of a delivered log: no row stops the read.

    A reject is (reason, record): a line with another number of fields or a
    field of the wrong type is ``malformed`` and keeps its text; the other
    reasons name the first field that no interaction can do without. A file
    whose header differs from the schema still fails, as all its rows would.
    """
    names = RAW_LOG_SCHEMA.names
    schema = T.StructType([*RAW_LOG_SCHEMA.fields, T.StructField("_record", T.StringType())])
    rows = (spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_record").option("columnPruning", False).csv(path))
    day = F.expr("try_cast(split_part(time, ' ', 1) AS DATE)")
    reason = (F.when(F.col("_record").isNotNull(), "malformed")
              .when(F.col("user_id").isNull(), "no_user").when(F.col("item_id").isNull(), "no_item")
              .when(~F.coalesce(F.col("behavior_type").isin(list(BEHAVIORS)), F.lit(False)), "bad_behavior")
              .when(~F.coalesce(F.col("time").rlike(TIME_FORM), F.lit(False)) | day.isNull(), "bad_time"))
    tagged = rows.withColumn("reason", reason)
    good = tagged.filter("reason IS NULL").select(*names)
    fields = F.concat_ws(",", *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names])
    return good, tagged.filter("reason IS NOT NULL").select("reason", F.coalesce("_record", fields).alias("record"))


def rejects_by_reason(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


class TooManyRejects(ValueError):
    """More of a delivery was rejected than the run accepts."""


def check_rejects(good: DataFrame, rejects: DataFrame, most: float) -> dict[str, int]:
    """Counts by reason; raises if more than ``most`` (a share of all rows) were rejected."""
    counts = {r["reason"]: r["n_rows"] for r in rejects_by_reason(rejects).collect()}
    bad = sum(counts.values())
    if bad and bad > most * (bad + good.count()):
        raise TooManyRejects(f"{bad} rows rejected, more than {most:.2%}: {counts}")
    return counts


def read_clean_log(spark: SparkSession, path: str, first_day: dt.date | None = None,
                   last_day: dt.date | None = None) -> DataFrame:
    """The cleaned log; bounds on ``day`` prune whole partitions."""
    df = spark.read.schema(CLEAN_SCHEMA).parquet(path)
    if first_day is not None:
        df = df.filter(F.col("day") >= F.lit(first_day))
    if last_day is not None:
        df = df.filter(F.col("day") <= F.lit(last_day))
    return df
