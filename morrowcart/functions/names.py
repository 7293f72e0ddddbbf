"""Feature column names and their fixed order.

Naming: ``<entity>_<measure>_<window>_<behaviour>``; entity ``u`` user,
``i`` item, ``c`` category, ``ui`` user x item, ``uc`` user x category;
windows ``w`` (full window), ``1d`` (last day) and ``<k>d`` lookbacks.
Spark code and the DuckDB oracle both generate their columns from here.
"""

from __future__ import annotations

from dataclasses import dataclass

from ..config import BEHAVIORS, HOURS, Calendar, FeatureOptions

RATIO_BEHAVIORS = (1, 2, 3)  # actions per purchase, for click, skim, collect


@dataclass(frozen=True)
class Entity:
    name: str
    prefix: str
    keys: tuple[str, ...]


USER = Entity("user", "u", ("user_id",))
ITEM = Entity("item", "i", ("item_id",))
CATEGORY = Entity("category", "c", ("item_category",))
USER_ITEM = Entity("user_item", "ui", ("user_id", "item_id"))
USER_CATEGORY = Entity("user_category", "uc", ("user_id", "item_category"))
ENTITIES = (USER, ITEM, CATEGORY, USER_ITEM, USER_CATEGORY)


def lookback_labels(cal: Calendar) -> list[str]:
    return [f"{k}d" for k in cal.lookbacks]


def cnt(e: Entity, window: str, b: int) -> str:
    return f"{e.prefix}_cnt_{window}_{b}"


def cnt_block(e: Entity, window: str) -> list[str]:
    return [cnt(e, window, b) for b in BEHAVIORS]


def count_names(e: Entity, cal: Calendar) -> list[str]:
    """The 20 count columns: full window, last day, then each lookback."""
    out = cnt_block(e, "w") + cnt_block(e, "1d")
    for w in lookback_labels(cal):
        out += cnt_block(e, w)
    return out


def avg_names(e: Entity) -> list[str]:
    return [f"{e.prefix}_avg_w_{b}" for b in BEHAVIORS]


def ratio_names(e: Entity, window: str = "w") -> list[str]:
    return [f"{e.prefix}_ratio_{window}_{b}" for b in RATIO_BEHAVIORS]


def uniq_names() -> list[str]:
    return [f"i_uniq_w_{b}" for b in BEHAVIORS]


def active_day_names() -> list[str]:
    return [f"u_days_w_{b}" for b in BEHAVIORS]


def grid_name(e: Entity, h: int, b: int) -> str:
    return f"{e.prefix}_grid_{h:02d}_{b}"


def grid_names(e: Entity) -> list[str]:
    """24 x 4 cells, hour-major, as the unstacked crosstab orders them."""
    return [grid_name(e, h, b) for h in HOURS for b in BEHAVIORS]


def hour_names(e: Entity) -> list[str]:
    if e is USER:
        return ["u_hour_min_1d", "u_hour_max_1d", "u_hour_range_1d"]
    return [f"{e.prefix}_hour_min_1d", f"{e.prefix}_hour_max_1d"]


def maxbt_name(e: Entity) -> str:
    return f"{e.prefix}_maxbt_1d"


def family_names(e: Entity, cal: Calendar) -> list[str]:
    """Columns of one entity family, in the order the reference merges them."""
    lb = []
    for w in lookback_labels(cal):
        lb += cnt_block(e, w)
    head = cnt_block(e, "w") + cnt_block(e, "1d")
    if e is USER:
        return head + avg_names(e) + ratio_names(e) + lb + hour_names(e)
    if e is ITEM:
        return head + avg_names(e) + ratio_names(e) + uniq_names() + lb
    if e is CATEGORY:
        return head + avg_names(e) + ratio_names(e) + lb
    return head + hour_names(e) + [maxbt_name(e)] + lb


def span_name(e: Entity) -> str:
    return f"{e.prefix}_span_w"


def lookback_grid_names(k: int) -> list[str]:
    """The user hour grid over the last k days."""
    return [lookback_grid_name(k, h, b) for h in HOURS for b in BEHAVIORS]


def lookback_grid_name(k: int, h: int, b: int) -> str:
    return f"u_grid{k}d_{h:02d}_{b}"


def optional_names(e: Entity, cal: Calendar, opts: FeatureOptions) -> list[str]:
    """Columns a family has only when asked for."""
    out = []
    if opts.lookback_ratios and e in (USER, ITEM, CATEGORY):
        for w in lookback_labels(cal)[:2]:
            out += ratio_names(e, w)
    if opts.span_days and e in (USER_ITEM, USER_CATEGORY):
        out.append(span_name(e))
    return out


SAMPLE_KEYS = ["label_day", "user_id", "item_id", "item_category"]


def feature_names(cal: Calendar, opts: FeatureOptions = FeatureOptions()) -> list[str]:
    """The full feature vector, in model input order: 426 columns, then the
    optional ones (none by default)."""
    out = []
    for e in (USER, ITEM, CATEGORY, USER_CATEGORY, USER_ITEM):
        out += family_names(e, cal)
    for e in (USER, USER_ITEM, USER_CATEGORY):
        out += grid_names(e)
    out += active_day_names()
    for e in (USER, ITEM, CATEGORY, USER_CATEGORY, USER_ITEM):
        out += optional_names(e, cal, opts)
    for k in opts.grid_lookbacks:
        out += lookback_grid_names(k)
    return out
