"""Windowed behaviour counts per entity and label day (crosstabs), and what
derives from them: daily averages and actions-per-purchase ratios.

The log is first summed to one row per key and day (``activity.key_days``);
every count is then a conditional sum over those rows on each label day, so
the full window, the last day and all lookbacks share one aggregate, and no
label day multiplies rows before a shuffle. Expressions are SQL strings:
hundreds of columns are built with one call each instead of a chain of calls
per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BEHAVIORS, PURCHASE, Calendar
from ..functions import names as N
from ..functions.exprs import safe_ratio_sql
from .activity import key_days, snapshots


def window_conditions(cal: Calendar) -> dict[str, str]:
    """Window label -> SQL condition on the fanned-out log's flags."""
    conds = {"w": "true", "1d": "f_1d"}
    for name in N.lookback_labels(cal):
        conds[name] = f"f_{name}"
    return conds


def count_sql(e: N.Entity, cal: Calendar) -> list[str]:
    conds = window_conditions(cal)
    return [f"sum(CASE WHEN {conds[w]} THEN n_{b} ELSE 0L END) AS {N.cnt(e, w, b)}"
            for w in ["w", "1d", *N.lookback_labels(cal)] for b in BEHAVIORS]


def entity_counts(log: DataFrame, days: DataFrame, e: N.Entity, cal: Calendar,
                  extra_sql: list[str] | None = None, sample: DataFrame | None = None) -> DataFrame:
    """(label_day, keys) -> 20 counts (+ extra aggregates), for the keys active
    in the window, or those of them that ``sample`` holds on that label day."""
    aggs = [F.expr(s) for s in count_sql(e, cal) + (extra_sql or [])]
    return snapshots(key_days(log, e, sample), days).groupBy("label_day", *e.keys).agg(*aggs)


def average_sql(e: N.Entity, cal: Calendar) -> list[str]:
    """Full-window count / slot (the constant slot, not the active days)."""
    return [f"{N.cnt(e, 'w', b)} / CAST({cal.slot} AS DOUBLE) AS {a}"
            for b, a in zip(BEHAVIORS, N.avg_names(e))]


def ratio_sql(e: N.Entity, window: str = "w") -> list[str]:
    """count(b) / count(purchase) for b = click, skim, collect; x/0 -> 0."""
    return [f"{safe_ratio_sql(N.cnt(e, window, b), N.cnt(e, window, PURCHASE))} AS {r}"
            for b, r in zip(N.RATIO_BEHAVIORS, N.ratio_names(e, window))]


def daily_average(counts: DataFrame, e: N.Entity, cal: Calendar) -> DataFrame:
    return counts.selectExpr("label_day", *e.keys, *average_sql(e, cal))


def action_purchase_ratio(counts: DataFrame, e: N.Entity) -> DataFrame:
    return counts.selectExpr("label_day", *e.keys, *ratio_sql(e, "w"))


def action_purchase_ratio_lookback(counts: DataFrame, e: N.Entity, cal: Calendar) -> DataFrame:
    """The same ratios on the first two lookbacks (5 and 3 days)."""
    cols = []
    for w in N.lookback_labels(cal)[:2]:
        cols += ratio_sql(e, w)
    return counts.selectExpr("label_day", *e.keys, *cols)
