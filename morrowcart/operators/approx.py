"""Approximate distinct users per item from daily mergeable sketches.

One HyperLogLog sketch per (item, day, behaviour), summed map-side: a hot item
reaches the shuffle as one sketch of bounded size per task, day and behaviour,
not as its users. Sketches of a window's days are united per label day, so a
user seen on several days counts once, and a day's sketches serve all label
days whose window holds it.

The relative standard error is ``relative_error(lg_k)``; with the default
2**12 registers it is below 1.7 %, and counts below some hundreds are exact
(the sketch still lists its users). Null users are not counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BEHAVIORS
from ..functions import names as N
from .activity import snapshots

LG_K = 12


def relative_error(lg_k: int = LG_K) -> float:
    """Upper bound of the sketch's relative standard error."""
    return 1.04 / 2 ** (lg_k / 2)


def daily_user_sketches(log: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """(item, day, behaviour, users): one sketch each."""
    return log.groupBy("item_id", "day", "behavior_type").agg(F.hll_sketch_agg("user_id", lg_k).alias("users"))


def item_unique_users_approx(log: DataFrame, days: DataFrame, lg_k: int = LG_K, sketches: DataFrame | None = None) -> DataFrame:
    """As ``extras.item_unique_users``, estimated. ``sketches`` may be a stored
    table of ``daily_user_sketches``, to which only new days have to be added."""
    daily = daily_user_sketches(log, lg_k) if sketches is None else sketches
    united = [F.expr(f"coalesce(hll_sketch_estimate(hll_union_agg(CASE WHEN behavior_type = {b} THEN users END)), 0L)").alias(n)
              for b, n in zip(BEHAVIORS, N.uniq_names())]
    return snapshots(daily, days).groupBy("label_day", "item_id").agg(*united)
