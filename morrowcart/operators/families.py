"""Feature families per entity, and their assembly onto the samples.

A family is everything keyed by the same entity key. What the reference
builds as separate crosstabs and joins by index (counts, last-day counts,
lookbacks, hour bounds, last-day behaviour, active days) is here one
aggregate per key over the key's days (operators/activity.py); only the item
distinct users (a two-step aggregate) and the 96-cell hour grids are joined.
Grids stay sparse maps until the output, so shuffles and sorts carry the few
cells that hold anything instead of 96 columns a grid.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..config import BEHAVIORS, HOURS, Calendar, FeatureOptions, HotKeys
from ..functions import names as N
from . import calendar as C
from . import counts as K
from . import extras as X
from .approx import item_unique_users_approx
from .skew import split_hot_join

NO_OPTIONS = FeatureOptions()


def _family_sql(e: N.Entity, cal: Calendar, opts: FeatureOptions) -> dict[str, str]:
    """Output column name -> SQL expression over the family aggregate."""
    cols = {c: c for c in N.count_names(e, cal)}
    derived = []
    if e in (N.USER, N.ITEM, N.CATEGORY):
        derived += K.average_sql(e, cal) + K.ratio_sql(e, "w")
        if opts.lookback_ratios:
            for w in N.lookback_labels(cal)[:2]:
                derived += K.ratio_sql(e, w)
    if e in (N.USER, N.USER_ITEM, N.USER_CATEGORY):
        derived += X.hour_sql(e)
    if e in (N.USER_ITEM, N.USER_CATEGORY):
        derived.append(X.max_behavior_sql(e))
    for s in derived:
        expr, name = s.rsplit(" AS ", 1)
        cols[name] = expr
    return cols


def family(log: DataFrame, days: DataFrame, e: N.Entity, cal: Calendar,
           with_active_days: bool = False, sample: DataFrame | None = None,
           opts: FeatureOptions = NO_OPTIONS) -> DataFrame:
    """One row per (label_day, key) active in the window, columns of
    ``names.family_names`` (plus ``u_days_w_*`` for users if asked, and the
    optional ones). With a ``sample`` only its (label_day, key) are built."""
    extra: list[str] = []
    if e in (N.USER, N.USER_ITEM, N.USER_CATEGORY):
        extra += X.last_day_hour_sql()
    if e in (N.USER_ITEM, N.USER_CATEGORY):
        extra.append(X.max_behavior_agg_sql())
    plain = []
    if e is N.USER and with_active_days:
        extra += X.active_day_agg_sql()
        plain += N.active_day_names()
    if opts.span_days and e in (N.USER_ITEM, N.USER_CATEGORY):
        extra.append(X.span_sql(e))
        plain.append(N.span_name(e))
    agg = K.entity_counts(log, days, e, cal, extra, sample)
    cols = _family_sql(e, cal, opts)
    out = [f"{cols[n]} AS {n}" for n in N.family_names(e, cal) + N.optional_names(e, cal, opts) if n in cols]
    fam = agg.selectExpr("label_day", *e.keys, *out, *plain)
    if e is N.ITEM:
        uniq = item_unique_users_approx(log, days) if opts.approx_users else X.item_unique_users(log, days)
        fam = (fam.join(uniq, ["label_day", "item_id"], "left")
                  .select("label_day", "item_id", *N.family_names(e, cal), *N.optional_names(e, cal, opts))
                  .na.fill(0, subset=N.uniq_names()))
    return fam


PAIR_KEYS = ["label_day", "user_id", "item_id"]


def _attach(keys: DataFrame, fam: DataFrame, on: list[str], name: str, hot: HotKeys | None) -> DataFrame:
    """A family as (pair keys, one struct column).

    The family's columns are packed into one struct right after its
    aggregate; joins then copy each family as one block instead of field by
    field, and the join chain stays narrow enough for whole-stage code
    generation (measured: ~15% faster than flat columns on a skewed 1.3M-row
    log, and faster than packing after the join). Families keyed by the pair
    are used as they are; others are first attached to the narrow sample keys.
    """
    cols = [c for c in fam.columns if c not in on]
    packed = fam.selectExpr(*on, f"struct({', '.join(cols)}) AS {name}")
    if on == PAIR_KEYS:
        return packed
    narrow = keys.select(*PAIR_KEYS, *[k for k in on if k not in PAIR_KEYS])
    # a hot user / item / category is joined against a broadcast of its own
    # family row instead of landing in one partition (see operators/skew.py)
    split = (hot.max_keys, hot.min_rows) if hot else ()
    return split_hot_join(narrow, packed, on, *split).select(*PAIR_KEYS, name)


@dataclass(frozen=True)
class Piece:
    """A group of features: where it joins and how it is built."""

    on: list[str]
    features: list[str]
    build: Callable[[], DataFrame]
    cells: dict[str, int] = field(default_factory=dict)  # of a sparse grid: its features' cells


def _grid_piece(on: list[str], names: Callable[[int, int], str], build: Callable[[], DataFrame]) -> Piece:
    cells = {names(h, b): X.grid_cell(h, b) for h in HOURS for b in BEHAVIORS}
    return Piece(on, list(cells), build, cells)


def pieces(sample: DataFrame, log: DataFrame, days: DataFrame, cal: Calendar, opts: FeatureOptions) -> dict[str, Piece]:
    u, i, c = ["label_day", "user_id"], ["label_day", "item_id"], ["label_day", "item_category"]
    uc = ["label_day", "user_id", "item_category"]
    fam = lambda e, **kw: lambda: family(log, days, e, cal, sample=sample, opts=opts, **kw)
    grid = lambda on, e: _grid_piece(on, lambda h, b: N.grid_name(e, h, b), lambda: X.sparse_hour_grid(log, days, e))
    names = lambda e: N.family_names(e, cal) + N.optional_names(e, cal, opts)
    out = {
        "ui": Piece(PAIR_KEYS, names(N.USER_ITEM), fam(N.USER_ITEM)),
        "uig": grid(PAIR_KEYS, N.USER_ITEM),
        "u": Piece(u, names(N.USER) + N.active_day_names(), fam(N.USER, with_active_days=True)),
        "ug": grid(u, N.USER),
        "i": Piece(i, names(N.ITEM), fam(N.ITEM)),
        "uc": Piece(uc, names(N.USER_CATEGORY), fam(N.USER_CATEGORY)),
        "ucg": grid(uc, N.USER_CATEGORY),
        "c": Piece(c, names(N.CATEGORY), fam(N.CATEGORY)),
    }
    for k in opts.grid_lookbacks:
        def build(k=k):
            # the k days before each snapshot's label day, its own label day excluded
            recent = C.recent_days_of(days.select("label_day", "base_day").distinct(), k)
            return X.sparse_hour_grid_lookback(log, recent, ("label_day", "user_id"))
        out[f"ug{k}"] = _grid_piece(u, lambda h, b, k=k: N.lookback_grid_name(k, h, b), build)
    return out


def assemble(sample: DataFrame, log: DataFrame, days: DataFrame, cal: Calendar,
             opts: FeatureOptions = NO_OPTIONS, wanted: list[str] | None = None,
             hot: HotKeys | None = None) -> DataFrame:
    """Left-join features onto the samples and fill misses with 0.

    ``log`` is the stored activity table and ``sample`` a stored narrow table:
    both are read once per family. Only families that own a ``wanted`` feature
    (all by default) are built, and only for the sample's keys. Families keyed
    by something other than the pair are first attached to the sample keys
    alone (a shuffle of 3-4 key columns); each family then moves to the pair
    partitioning once, as one struct column, and the structs and their sparse
    grids are expanded into flat columns after the last join. Families that share a key are joined
    before they move. Small families (categories) become broadcast joins when
    AQE measures them small; a hot user, item or category is joined against a
    broadcast of its own family rows, so no task receives it whole.
    ``na.fill`` keeps each column's type (counts stay bigint, ratios double).
    """
    feats = N.feature_names(cal, opts) if wanted is None else wanted
    todo = {k: p for k, p in pieces(sample, log, days, cal, opts).items() if set(p.features) & set(feats)}
    by_key: dict[tuple, DataFrame] = {}
    source: dict[str, tuple[str, str]] = {}  # feature: column of its piece, place in that
    for k, p in todo.items():
        built = p.build()
        if p.cells:
            df = built.selectExpr(*p.on, f"grid AS {k}_grid")
            source |= {f: (f"{k}_grid", f"[{cell}]") for f, cell in p.cells.items()}
        else:
            df = built.select(*p.on, *[f for f in p.features if f in set(feats)])
            source |= {f: (f, "") for f in p.features}
        key = tuple(p.on)
        if p.on == PAIR_KEYS:
            by_key[(*key, k)] = df
        else:
            by_key[key] = by_key[key].join(df, p.on, "left") if key in by_key else df
    keys = sample.select(*PAIR_KEYS, "item_category")
    x, owner = sample, {}
    for n, (key, df) in enumerate(by_key.items()):
        on = [c for c in key if c in df.columns]
        name = f"_p{n}"
        x = x.join(_attach(keys, df, on, name, hot), PAIR_KEYS, "left")
        owner |= {f: name for f in df.columns if f not in on}
    cols = [c for c in N.SAMPLE_KEYS + ["label"] if c in sample.columns]
    value = lambda f: f"{owner[source[f][0]]}.{source[f][0]}{source[f][1]}"
    return x.selectExpr(*cols, *[f"{value(f)} AS {f}" for f in feats]).na.fill(0, subset=feats)
