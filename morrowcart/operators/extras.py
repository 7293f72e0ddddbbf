"""Distinct counts, hour bounds, last-day behaviour, hour grids and spans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BEHAVIORS, HOURS
from ..functions import names as N
from .activity import day_totals, key_days, snapshots, weight


def _agg(df: DataFrame, keys: list[str], sql: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(s) for s in sql])


def item_unique_users(log: DataFrame, days: DataFrame) -> DataFrame:
    """Distinct users per (label_day, item, behaviour) over the full window.

    Two aggregations instead of COUNT(DISTINCT) x 4 (which plans an Expand
    that multiplies every row by four): the user x item days are flagged per
    label day where they lie, then the flags are summed by item. A hot item is
    spread over its users in the first step and summed map-side in the second.
    """
    per_user = _agg(snapshots(key_days(log, N.USER_ITEM), days), ["label_day", "user_id", "item_id"],
                    [f"max(CAST(n_{b} > 0 AS INT)) AS _has_{b}" for b in BEHAVIORS])
    return _agg(per_user, ["label_day", "item_id"],
                [f"CAST(sum(_has_{b}) AS BIGINT) AS {n}"
                 for b, n in zip(BEHAVIORS, N.uniq_names())])


def active_day_agg_sql() -> list[str]:
    """Per behaviour, the days with activity: a count over the user's days."""
    return [f"count_if(n_{b} > 0) AS {n}" for b, n in zip(BEHAVIORS, N.active_day_names())]


def user_active_days(log: DataFrame, days: DataFrame) -> DataFrame:
    return _agg(snapshots(key_days(log, N.USER), days), ["label_day", "user_id"], active_day_agg_sql())


def last_day_hour_sql() -> list[str]:
    """min / max hour on the last day (NULL when the key has no last-day row)."""
    return ["min(CASE WHEN f_1d THEN hmin END) AS _hmin",
            "max(CASE WHEN f_1d THEN hmax END) AS _hmax"]


def hour_sql(e: N.Entity) -> list[str]:
    names = N.hour_names(e)
    out = [f"coalesce(_hmin, 0) AS {names[0]}", f"coalesce(_hmax, 0) AS {names[1]}"]
    if e is N.USER:
        out.append(f"coalesce(_hmax - _hmin, 0) AS {names[2]}")
    return out


def max_behavior_agg_sql() -> str:
    return "max(CASE WHEN f_1d THEN maxbt END) AS _maxbt"


def max_behavior_sql(e: N.Entity) -> str:
    return f"coalesce(_maxbt, 0) AS {N.maxbt_name(e)}"


def _last_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Tag rows of a last day with its label day: at most one training and one scoring snapshot."""
    return rows.join(F.broadcast(days.filter("f_1d").select("label_day", "day")), "day")


def hour_bounds(log: DataFrame, days: DataFrame, e: N.Entity) -> DataFrame:
    """Keys active on the last day -> hour min / max (and range for users)."""
    rows = _last_days(day_totals(log, e), days).withColumnsRenamed({"hmin": "_hmin", "hmax": "_hmax"})
    return rows.selectExpr("label_day", *e.keys, *hour_sql(e))


def max_behavior(log: DataFrame, days: DataFrame, e: N.Entity) -> DataFrame:
    rows = _last_days(day_totals(log, e), days).withColumnRenamed("maxbt", "_maxbt")
    return rows.selectExpr("label_day", *e.keys, max_behavior_sql(e))


def grid_cells(rows: DataFrame, keys: list[str], part: list[str] | None = None) -> DataFrame:
    """(keys, grid): the hour x behaviour counts of a key as a sparse map, one
    entry for each cell that holds anything; the cell number is 4 * hour +
    behaviour - 1. Rows are summed to one per key and cell first (map-side, so
    a hot key reaches the shuffle as at most 96 rows a task), and a key's cells
    are then gathered where ``part`` puts them (by the key itself if not given)."""
    cell = f"CASE WHEN hour BETWEEN {HOURS[0]} AND {HOURS[-1]} AND behavior_type BETWEEN {BEHAVIORS[0]} AND {BEHAVIORS[-1]} " \
           f"THEN CAST({len(BEHAVIORS)} * hour + behavior_type - {BEHAVIORS[0]} AS INT) END"
    summed = rows.groupBy(*keys, F.expr(cell).alias("_cell")).agg(F.expr(f"sum({weight(rows)})").cast("long").alias("n"))
    if part:
        summed = summed.repartition(*part)
    entry = F.expr("collect_list(CASE WHEN _cell IS NOT NULL THEN struct(_cell, n) END)")
    return summed.groupBy(*keys).agg(F.map_from_entries(entry).alias("grid"))


def grid_cell(h: int, b: int) -> int:
    return len(BEHAVIORS) * h + b - BEHAVIORS[0]


def grid_columns(names) -> list[str]:
    """The 96 fixed columns of a sparse grid; ``names(h, b)`` names the cell."""
    return [f"coalesce(grid[{grid_cell(h, b)}], 0L) AS {names(h, b)}" for h in HOURS for b in BEHAVIORS]


def sparse_hour_grid(log: DataFrame, days: DataFrame, e: N.Entity) -> DataFrame:
    """(label_day, keys, grid): the last day's counts per hour and behaviour."""
    last = F.broadcast(days.filter("f_1d").select("day").distinct())
    return _last_days(grid_cells(log.join(last, "day", "left_semi"), ["day", *e.keys], [*e.keys]), days).drop("day")


def hour_grid(log: DataFrame, days: DataFrame, e: N.Entity) -> DataFrame:
    """Counts per hour x behaviour on the last day: the sparse grid, expanded
    to 96 fixed columns only at the output."""
    return sparse_hour_grid(log, days, e).selectExpr("label_day", *e.keys, *grid_columns(lambda h, b: N.grid_name(e, h, b)))


def sparse_hour_grid_lookback(log: DataFrame, recent: DataFrame, keys: tuple[str, ...] = ("label_day", "user_id", "lookback_days")) -> DataFrame:
    """(keys, grid): a user's counts per hour and behaviour over the days of
    ``recent``, summed by user, day, hour and behaviour, and only then spread
    over the label days, in the users' partitions, where cells are summed and
    gathered without another shuffle."""
    rows = log.groupBy("user_id", "day", "hour", "behavior_type").agg(F.expr(f"sum({weight(log)})").cast("long").alias("n"))
    return grid_cells(rows.repartition("user_id").join(F.broadcast(recent), "day"), list(keys))


def hour_grid_lookback(log: DataFrame, recent: DataFrame, keys: tuple[str, ...] = ("label_day", "user_id", "lookback_days"),
                       names=None) -> DataFrame:
    """User hour grid over the last 2 and last 5 days before each label day."""
    grid = sparse_hour_grid_lookback(log, recent, keys)
    return grid.selectExpr(*keys, *grid_columns(names or (lambda h, b: N.grid_name(N.USER, h, b))))


def span_sql(e: N.Entity) -> str:
    """Days between first and last touch in the window."""
    return f"date_diff(max(day), min(day)) AS {N.span_name(e)}"


def span_days(log: DataFrame, days: DataFrame, e: N.Entity) -> DataFrame:
    return _agg(snapshots(key_days(log, e), days), ["label_day", *e.keys], [span_sql(e)])
