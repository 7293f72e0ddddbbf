"""The driver's tables recast as an interaction log and an item table.

Mapping (FIXTURES.md): ``events.user_id`` is the user, ``props.k`` the item,
``item_id % 10`` its category; event types map to behaviour codes (error has
none: cleaning drops those rows); the item table is ``part`` with ``p_size <=
40``, a choice that makes the item semi join selective.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Event type -> behaviour code.
EVENT_BEHAVIOR = {"click": 1, "view": 2, "signup": 3, "purchase": 4}
ITEM_MAX_SIZE = 40
N_CATEGORIES = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (event_id, user_id, item_id, item_category, behavior_type, time)."""
    ev = table(spark, sf_dir, "events")
    bt = F.lit(None).cast("int")
    for name, code in reversed(list(EVENT_BEHAVIOR.items())):
        bt = F.when(F.col("event_type") == name, F.lit(code)).otherwise(bt)
    item = F.get_json_object("props", "$.k").cast("long")
    # "yyyy-MM-dd HH" from the date and the hour: no session time zone involved
    time = F.concat_ws(" ", F.to_date("ts").cast("string"),
                       F.lpad(F.hour("ts").cast("string"), 2, "0"))
    return ev.select(
        "event_id",
        "user_id",
        item.alias("item_id"),
        (item % N_CATEGORIES).alias("item_category"),
        bt.alias("behavior_type"),
        time.alias("time"),
    )


def item_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "part")
            .filter(F.col("p_size") <= ITEM_MAX_SIZE)
            .select(F.col("p_partkey").alias("item_id")))


#: column names of a delivered log, as its header line
LOG_HEADER = "user_id,item_id,behavior_type,user_geohash,item_category,time"
DAMAGE = 50  # of so many rows, the first seven kinds below are damaged


def delivered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as the text lines of a CSV delivery, some of them damaged by
    ``event_id % DAMAGE``: 0 a user that is no number, 1 a field missing, 2 no
    user, 3 no item, 4 an unknown behaviour, 5 an impossible day, 6 no hour."""
    kind = F.col("event_id") % DAMAGE
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    user = F.when(kind == 0, F.concat(F.lit("x"), text("user_id"))).when(kind == 2, "").otherwise(text("user_id"))
    time = F.when(kind == 5, "2024-13-40 05").when(kind == 6, F.split_part("time", F.lit(" "), F.lit(1))).otherwise(text("time"))
    fields = [user, F.when(kind == 3, "").otherwise(text("item_id")), F.when(kind == 4, "9").otherwise(text("behavior_type")), F.lit(""), text("item_category")]
    return raw_log(spark, sf_dir).select(F.when(kind == 1, F.concat_ws(",", *fields)).otherwise(F.concat_ws(",", *fields, time)).alias(LOG_HEADER))


def write_lines(lines: DataFrame, path: str) -> None:
    """One column of text lines under its name as the header of every file."""
    lines.write.mode("overwrite").option("header", True).option("sep", "\u0001").option("quote", "\u0000").csv(path)
