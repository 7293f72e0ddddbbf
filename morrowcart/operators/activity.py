"""The log aggregated once, and its roll-ups to one row per key and day.

``activity_table`` is the narrow table every feature is built from: one row
per (user, item, category, day, hour, behaviour) with its count. ``key_days``
rolls it up to one row per (key, day): counts per behaviour, first and last
hour, highest behaviour code. The roll-up aggregates map-side, so a hot key
reaches its shuffle as one row per task and day; it is then partitioned by
the key alone (at most one row per calendar day and key). Label days are
applied after that shuffle: the fan-out to (label_day, key) and its aggregate
need no further one.

All functions accept the activity table (column ``n``) or a clean log, whose
rows count 1 each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BEHAVIORS
from ..functions import names as N

ACTIVITY_KEYS = ["user_id", "item_id", "item_category", "day", "hour", "behavior_type"]


def weight(rows: DataFrame) -> str:
    return "n" if "n" in rows.columns else "1"


def activity_table(log: DataFrame) -> DataFrame:
    if "n" in log.columns:
        return log
    return log.groupBy(*ACTIVITY_KEYS).agg(F.count(F.lit(1)).alias("n"))


def day_totals(rows: DataFrame, e: N.Entity) -> DataFrame:
    """(keys, day): ``n_<b>`` per behaviour, ``hmin``, ``hmax``, ``maxbt``."""
    w = weight(rows)
    sums = [F.expr(f"sum(CASE WHEN behavior_type = {b} THEN {w} ELSE 0 END)").cast("long").alias(f"n_{b}")
            for b in BEHAVIORS]
    return rows.groupBy(*e.keys, "day").agg(
        *sums, F.min("hour").alias("hmin"), F.max("hour").alias("hmax"),
        F.max("behavior_type").alias("maxbt"))


def key_days(rows: DataFrame, e: N.Entity, sample: DataFrame | None = None) -> DataFrame:
    """``day_totals`` partitioned by the key. With a ``sample`` only its keys
    stay, and ``label_days`` lists the label days each is sampled for.

    Pairs of the activity table are partitioned first and summed in place, one
    shuffle in all: summing them map-side saves little, and a pair has at most
    96 rows a day. Other keys can be hot and are summed map-side."""
    if e is N.USER_ITEM and "n" in rows.columns:
        kd = day_totals(rows.repartition(*e.keys), e)
    else:
        kd = day_totals(rows, e).repartition(*e.keys)
    if sample is None:
        return kd
    wanted = sample.groupBy(*e.keys).agg(F.collect_set("label_day").alias("label_days"))
    return kd.join(wanted, list(e.keys))


def snapshots(kd: DataFrame, days: DataFrame) -> DataFrame:
    """Each key-day on every label day whose window holds it (after the
    shuffle; the calendar table is broadcast, its size fixed by configuration)."""
    out = kd.join(F.broadcast(days), "day")
    return out.filter(F.array_contains("label_days", F.col("label_day"))) if "label_days" in kd.columns else out
