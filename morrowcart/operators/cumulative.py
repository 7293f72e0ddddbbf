"""Windowed counts as differences of running totals.

``counts.entity_counts`` meets each key-day with every label day whose window
holds it, which grows with the window's length. Here a key's days carry
running totals instead, and a window's count is the total as of its last day
less the total as of the day before its first: a key-day is met only by the
bounds that fall between it and the key's next day, whatever the window's
length. That is the better plan for keys active on most days (items,
categories, busy users) and for long windows; for keys of one or two days
(most user x item pairs) the fan-out meets no more rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import BEHAVIORS, Calendar
from ..functions import names as N
from .activity import key_days


def _starts(cal: Calendar) -> dict[str, str]:
    """Window label -> SQL of its first day on a spine row."""
    return {"w": "win_start", "1d": "day1"} | {n: f"greatest(win_start, lb_{n}_start)" for n in N.lookback_labels(cal)}


def bound_days(sp: DataFrame, cal: Calendar) -> DataFrame:
    """(bound_day, label_day, win_end, is_last, s_<window>, before_<window>): one
    row per label day and distinct bound, its last day or the day before the
    first of some windows. At most 2 + lookbacks rows a label day and one more:
    fixed by the calendar."""
    starts = _starts(cal)
    one = sp.selectExpr("label_day", "win_end", *[f"{x} AS s_{w}" for w, x in starts.items()])
    bounds = F.array_distinct(F.array("win_end", *[F.date_sub(f"s_{w}", 1) for w in starts]))
    out = one.withColumn("bound_day", F.explode(bounds))
    return out.selectExpr("bound_day", "label_day", "win_end", "bound_day = win_end AS is_last", *[f"s_{w}" for w in starts],
                          *[f"bound_day = date_sub(s_{w}, 1) AS before_{w}" for w in starts])


def running_totals(kd: DataFrame, e: N.Entity) -> DataFrame:
    """(keys, day, next_day, c_<behaviour>): totals up to and with each of the
    key's days. ``kd`` is partitioned by the key, so no further shuffle."""
    order = Window.partitionBy(*e.keys).orderBy("day")
    return kd.withColumns({f"c_{b}": F.sum(f"n_{b}").over(order) for b in BEHAVIORS} | {"next_day": F.lead("day").over(order)})


def as_of(totals: DataFrame, bounds: DataFrame, cal: Calendar, first: str, last: str) -> DataFrame:
    """The running totals that hold on each bound day a window needs: the
    window's last day if the key is active in it, and the day before a window's
    first day if activity before it must be taken off."""
    in_reach = totals.withColumns({"_from": F.expr(f"greatest(day, {first})"), "_to": F.expr(
        f"least(coalesce(date_sub(next_day, 1), date_add(day, {cal.window_days_max})), {last})")}).where("_from <= _to")
    spread = in_reach.withColumn("bound_day", F.explode(F.sequence("_from", "_to"))).drop("_from", "_to")
    held = spread.join(F.broadcast(bounds), "bound_day").where("CASE WHEN is_last THEN day >= s_w ELSE next_day <= win_end END")
    return held.filter(F.array_contains("label_days", F.col("label_day"))) if "label_days" in held.columns else held


def cumulative_counts(log: DataFrame, sp: DataFrame, e: N.Entity, cal: Calendar, sample: DataFrame | None = None) -> DataFrame:
    """(label_day, keys) -> the 20 counts of ``counts.entity_counts``, for the
    keys active in the window (those that ``sample`` holds, if given). ``sp`` is
    a spine of ``operators.calendar``."""
    bounds = bound_days(sp, cal)
    first, last = sp.selectExpr("min(date_sub(win_start, 1))", "max(win_end)").first()  # of the calendar, no data read
    rows = as_of(running_totals(key_days(log, e, sample), e), bounds, cal, f"DATE '{first}'", f"DATE '{last}'")
    sums = []
    for w in _starts(cal):
        sign = f"CASE WHEN is_last AND day >= s_{w} THEN 1L WHEN before_{w} AND next_day <= win_end THEN -1L ELSE 0L END"
        sums += [F.expr(f"sum(({sign}) * c_{b})").alias(N.cnt(e, w, b)) for b in BEHAVIORS]
    # the window's last bound exists exactly if the key is active in the window
    return rows.groupBy("label_day", *e.keys).agg(*sums, F.expr("bool_or(is_last)").alias("_active")).where("_active").drop("_active")
