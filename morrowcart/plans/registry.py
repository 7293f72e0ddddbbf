"""Named queries over the driver's tables: one per operator of the survey.

Each entry takes (spark, sf_dir) and returns a DataFrame built from the
``events`` and ``part`` tables through the fixture mapping. Nothing is
sampled or capped; limits appear only where they are the feature (top-k).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BoostParams, Calendar, FeatureOptions, ModelParams
from ..functions import names as N
from ..operators import boosting as B
from ..operators import calendar as C
from ..operators import clean as CL
from ..operators import counts as K
from ..operators import extras as X
from ..operators import families as FAM
from ..operators import ranking as R
from ..operators import sampling as S
from ..operators import samples as SM
from ..operators.approx import item_unique_users_approx
from ..operators.cumulative import cumulative_counts
from ..operators.datasets import sampled_training_set, scoring_set, stored_activity, training_set
from ..operators.model import gbt_fit, gbt_scores
from ..session import checkpoint_dir, stored
from ..sources import fixture
from ..sources.files import read_clean_log, read_item_table_csv, read_raw_log_tolerant, rejects_by_reason
from ..sources.sinks import write_clean_log
from .incremental import DailyRun

# Fixed parameters of the fixture queries (FIXTURES.md).
CAL = Calendar.fixture()
EVAL_CAL = CAL.with_end(dt.date(2024, 1, 29))  # truth for 01-29 is on 01-30
NEG_RATIO = 90
SEED = 42
TOP_K = 700
SHORT_TOP_K = 100  # smaller than the fixture's scoring set, so that the cut shows
CUTOFFS = (50, 100, 150, 650, 700, 750)
# the product's settings: all 900 boosting rounds (figures in the README)
QUERY_MODEL = ModelParams()

RELOADED_DAYS = (dt.date(2024, 1, 10), dt.date(2024, 1, 20))
PAIR_BEHAVIORS = (2, 3)
DAILY_FEATURES = N.family_names(N.USER, CAL) + N.family_names(N.USER_ITEM, CAL)
# two rounds over all rows and columns, and as many bins as values: what the SQL
# of the boosted queries writes out (the product default is in BoostParams); with
# the small L2 weight the few positives of the test tables still give deep trees
QUERY_BOOST = BoostParams(rounds=2, rows=1.0, columns=1.0, bins=4096, l2=0.01, step=0.3)

Query = Callable[[SparkSession, str], DataFrame]


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return fixture.raw_log(spark, sf)


def log(spark: SparkSession, sf: str, cal: Calendar = CAL) -> DataFrame:
    return CL.clean_log(raw(spark, sf), fixture.item_table(spark, sf), cal)


def days(spark: SparkSession, split: str = "train", cal: Calendar = CAL) -> DataFrame:
    return C.spine_days(C.spine(spark, cal, split), cal)


def _counts(e: N.Entity) -> Query:
    def q(spark, sf):
        df = K.entity_counts(log(spark, sf), days(spark), e, CAL)
        return df.select("label_day", *e.keys, *N.count_names(e, CAL))
    return q


def _cumulative(e: N.Entity) -> Query:
    def q(spark, sf):
        return cumulative_counts(log(spark, sf), C.train_spine(spark, CAL), e, CAL).select("label_day", *e.keys, *N.count_names(e, CAL))
    return q


def _family(e: N.Entity) -> Query:
    def q(spark, sf):
        return FAM.family(log(spark, sf), days(spark), e, CAL)
    return q


def _per_entity(fn) -> Query:
    """Union over user, item, category of ``fn(counts, entity)``."""
    def q(spark, sf):
        lg, dd = log(spark, sf), days(spark)
        parts = []
        for e in (N.USER, N.ITEM, N.CATEGORY):
            df = fn(K.entity_counts(lg, dd, e, CAL), e)
            ren = {c: c[len(e.prefix) + 1:] for c in df.columns if c.startswith(e.prefix + "_")}
            parts.append(df.select("label_day", F.lit(e.name).alias("entity"),
                                   F.col(e.keys[0]).alias("entity_id"),
                                   *[F.col(c).alias(n) for c, n in ren.items()]))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    return q


def _split_time(spark, sf):
    return CL.split_time(raw(spark, sf)).select("event_id", "time", "days", "hours")


def _parse_day(spark, sf):
    return CL.parse_day(CL.split_time(raw(spark, sf))).select("event_id", "day", "hour")


def _drop_blackout_days(spark, sf):
    df = CL.parse_day(CL.split_time(raw(spark, sf)))
    return CL.drop_blackout_days(df, CAL).select("event_id", "day")


def _semi_item_subset(spark, sf):
    return CL.semi_item_subset(raw(spark, sf), fixture.item_table(spark, sf)) \
             .select("event_id", "user_id", "item_id", "behavior_type")


def _semi_item_subset_filtered(spark, sf):
    return CL.semi_item_subset_filtered(raw(spark, sf), fixture.item_table(spark, sf)) \
             .select("event_id", "user_id", "item_id", "behavior_type")


def _sparse_grid(e):
    """The sparse grid itself, one row per cell that holds anything."""
    def q(spark, sf):
        grid = X.sparse_hour_grid(log(spark, sf), days(spark), e)
        return grid.select("label_day", *e.keys, F.explode("grid").alias("cell", "n"))
    return q


def _purchases(spark, sf):
    return CL.purchases(log(spark, sf)).select("event_id", "user_id", "item_id", "day", "hour")


# The calendar queries report each snapshot's bounds together with what the
# log holds inside them, so they read the tables and grow with them.
def _label_spine(spark, sf):
    return C.label_activity(log(spark, sf), C.train_spine(spark, CAL))


def _window_bounds(spark, sf):
    cov = C.window_coverage(log(spark, sf), C.train_spine(spark, CAL), CAL)
    return cov.select("label_day", "win_start", "win_end", "n_window_rows", "n_window_days")


def _lookback_bounds(spark, sf):
    cov = C.window_coverage(log(spark, sf), C.train_spine(spark, CAL), CAL)
    lbs = N.lookback_labels(CAL)
    return cov.select("label_day", "shift", *[f"lb_{n}_start" for n in lbs],
                      *[f"n_days_{n}" for n in lbs])


def _score_bounds(spark, sf):
    return C.window_coverage(log(spark, sf), C.score_spine(spark, CAL), CAL).drop("split")


def _day_slice(spark, sf):
    d = days(spark).filter("f_1d").select("label_day", "day")
    return log(spark, sf).join(F.broadcast(d), "day").select("label_day", "event_id")


def _window_slice(spark, sf):
    return C.fan_out(log(spark, sf), days(spark, "both")) \
            .select("split", "label_day", "event_id", "day")


def _lookback_slice(spark, sf):
    fan = C.fan_out(log(spark, sf), days(spark, "both"))
    ks = F.array(*[F.when(F.col(f"f_{n}"), F.lit(k))
                   for k, n in zip(CAL.lookbacks, N.lookback_labels(CAL))])
    return (fan.select("split", "label_day", "event_id", F.explode(ks).alias("lookback_days"))
               .filter(F.col("lookback_days").isNotNull()))


def _snapshot_fanout(spark, sf):
    return (C.fan_out(log(spark, sf), days(spark, "both"))
            .groupBy("split", "label_day")
            .agg(F.count(F.lit(1)).alias("n_window_rows"),
                 F.count_if("f_1d").alias("n_1d_rows")))


def _train_pairs(spark, sf):
    return SM.train_pairs(log(spark, sf), C.train_spine(spark, CAL))


def _score_pairs(spark, sf):
    return SM.score_pairs(log(spark, sf), C.score_spine(spark, CAL))


def _train_labels(spark, sf):
    return SM.train_labels(log(spark, sf), C.train_spine(spark, CAL))


def _label_day_summary(spark, sf):
    return SM.label_day_summary(_train_labels(spark, sf))


def _class_split(spark, sf):
    return SM.class_counts(_train_labels(spark, sf))


def _item_unique_users(spark, sf):
    return X.item_unique_users(log(spark, sf), days(spark))


def _user_active_days(spark, sf):
    return X.user_active_days(log(spark, sf), days(spark))


def _hour_bounds(e):
    return lambda spark, sf: X.hour_bounds(log(spark, sf), days(spark), e)


def _max_behavior(e):
    return lambda spark, sf: X.max_behavior(log(spark, sf), days(spark), e)


def _grid(e):
    return lambda spark, sf: X.hour_grid(log(spark, sf), days(spark), e)


def _grid_lookback(spark, sf):
    return X.hour_grid_lookback(log(spark, sf), C.recent_days(spark, CAL))


def _span(e):
    return lambda spark, sf: X.span_days(log(spark, sf), days(spark), e)


def _training_set(spark, sf):
    return training_set(spark, log(spark, sf), CAL)


def _scoring_set(spark, sf):
    return scoring_set(spark, log(spark, sf), CAL)


def _negative_sample(spark, sf):
    return S.negative_sample(_train_labels(spark, sf), NEG_RATIO, SEED)


def _training_set_all_options(spark, sf):
    return training_set(spark, log(spark, sf), CAL, opts=FeatureOptions.all())


def _balanced_training_set(spark, sf):
    return sampled_training_set(spark, log(spark, sf), CAL, NEG_RATIO, SEED)


def fitted_scores(spark, sf) -> DataFrame:
    """Every scoring pair with its probability; the fit stores what it iterates over."""
    act = stored_activity(log(spark, sf))
    train = sampled_training_set(spark, act, CAL, NEG_RATIO, SEED)
    return gbt_scores(gbt_fit(train, CAL, QUERY_MODEL), scoring_set(spark, act, CAL))


def boosted(spark, sf, params: BoostParams, act: DataFrame | None = None) -> B.Booster:
    act = stored_activity(log(spark, sf)) if act is None else act
    train = sampled_training_set(spark, act, CAL, NEG_RATIO, SEED)
    return B.boost_fit(train, N.feature_names(CAL), params)


# ---- sources and sinks: through files and back ----

def _delivery(spark, sf):
    path = f"{checkpoint_dir(spark)}/delivery-{uuid.uuid4().hex}"
    fixture.write_lines(fixture.delivered_lines(spark, sf), path)
    return read_raw_log_tolerant(spark, path)


def _log_from_csv(spark, sf):
    return _delivery(spark, sf)[0].drop("user_geohash")


def _csv_rejects(spark, sf):
    return rejects_by_reason(_delivery(spark, sf)[1])


def _items_from_csv(spark, sf):
    path = f"{checkpoint_dir(spark)}/items-{uuid.uuid4().hex}"
    items = fixture.item_table(spark, sf).select("item_id", F.lit("").alias("item_geohash"), (F.col("item_id") % 10).alias("item_category"))
    items.write.option("header", True).csv(path)
    return read_item_table_csv(spark, path)


def _reloaded_clean_log(spark, sf):
    path = f"{checkpoint_dir(spark)}/clean-{uuid.uuid4().hex}"
    write_clean_log(log(spark, sf), path)
    return read_clean_log(spark, path, *RELOADED_DAYS)


def _train_pairs_behaviors(spark, sf):
    return SM.train_pairs(log(spark, sf), C.train_spine(spark, CAL), behaviors=PAIR_BEHAVIORS)


def _item_unique_users_approx(spark, sf):
    return item_unique_users_approx(log(spark, sf), days(spark))


def _incremental_training_set(spark, sf):
    """All days but the last delivered first, then the last two; the stored rows
    have the features of two families."""
    run = DailyRun(spark, CAL, f"{checkpoint_dir(spark)}/daily-{uuid.uuid4().hex}", wanted=DAILY_FEATURES)
    rows, items = stored(raw(spark, sf), "raw"), fixture.item_table(spark, sf)
    late = F.col("time") >= str(CAL.end_label)
    run.add(rows.filter(~late), items)
    run.add(rows.filter(F.col("time") >= str(CAL.end_label - dt.timedelta(days=1))), items)
    return run.training_set()


def _boosted_trees(spark, sf):
    """Every node of the trees: split, gain, sums and leaf values."""
    return boosted(spark, sf, QUERY_BOOST).table(spark)


def _boosted_scores(spark, sf):
    act = stored_activity(log(spark, sf))
    model = boosted(spark, sf, QUERY_BOOST, act)
    return B.boost_scores(model, scoring_set(spark, act, CAL)).withColumn("prob", F.round("prob", 9))


def _gbt_scores(spark, sf):
    # what SQL can state of a model's scores: one per scoring pair, a probability
    scores = fitted_scores(spark, sf)
    return scores.select("user_id", "item_id", F.coalesce(F.col("prob").between(0.0, 1.0), F.lit(False)).alias("is_probability"))


def _eval_inputs(spark, sf):
    act = stored_activity(log(spark, sf, EVAL_CAL))
    # the test score reads two families: only those are built
    scored = R.fixed_test_score(scoring_set(spark, act, EVAL_CAL, wanted=R.TEST_SCORE_FEATURES))
    return scored, R.next_day_purchases(act, EVAL_CAL.score_day)


def _topk(k):
    def q(spark, sf):
        scored, _ = _eval_inputs(spark, sf)
        return R.topk(scored, k)
    return q


def _cutoff_sweep(spark, sf):
    scored, truth = _eval_inputs(spark, sf)
    return R.cutoff_sweep(scored, truth, CUTOFFS)


def _offline_eval(spark, sf):
    scored, truth = _eval_inputs(spark, sf)
    return R.offline_eval(scored, truth)


def _ratio_lookback(counts, e):
    return K.action_purchase_ratio_lookback(counts, e, CAL)


QUERIES: dict[str, Query] = {
    # sources / sinks and cleaning
    "clean_log": lambda spark, sf: log(spark, sf),
    "split_time": _split_time,
    "parse_day": _parse_day,
    "drop_blackout_days": _drop_blackout_days,
    "semi_item_subset": _semi_item_subset,
    "semi_item_subset_filtered": _semi_item_subset_filtered,
    "purchases": _purchases,
    # calendar
    "label_spine": _label_spine,
    "window_bounds": _window_bounds,
    "lookback_bounds": _lookback_bounds,
    "score_bounds": _score_bounds,
    "day_slice": _day_slice,
    "window_slice": _window_slice,
    "lookback_slice": _lookback_slice,
    "snapshot_fanout": _snapshot_fanout,
    # samples and labels
    "train_pairs": _train_pairs,
    "score_pairs": _score_pairs,
    "train_labels": _train_labels,
    "label_day_summary": _label_day_summary,
    "class_split": _class_split,
    # counts and derived ratios
    "user_counts": _counts(N.USER),
    "item_counts": _counts(N.ITEM),
    "category_counts": _counts(N.CATEGORY),
    "user_item_counts": _counts(N.USER_ITEM),
    "user_category_counts": _counts(N.USER_CATEGORY),
    **{f"{e.name}_counts_cumulative": _cumulative(e) for e in N.ENTITIES},
    "daily_average": _per_entity(lambda c, e: K.daily_average(c, e, CAL)),
    "action_purchase_ratio": _per_entity(K.action_purchase_ratio),
    "action_purchase_ratio_lookback": _per_entity(_ratio_lookback),
    # distinct counts, hour statistics, grids, spans
    "item_unique_users": _item_unique_users,
    "user_active_days": _user_active_days,
    "user_hour_span": _hour_bounds(N.USER),
    "user_item_hour_bounds": _hour_bounds(N.USER_ITEM),
    "user_category_hour_bounds": _hour_bounds(N.USER_CATEGORY),
    "user_item_max_behavior": _max_behavior(N.USER_ITEM),
    "user_category_max_behavior": _max_behavior(N.USER_CATEGORY),
    "user_hour_grid": _grid(N.USER),
    "user_item_hour_grid": _grid(N.USER_ITEM),
    "user_category_hour_grid": _grid(N.USER_CATEGORY),
    "user_hour_grid_lookback": _grid_lookback,
    "user_item_hour_cells": _sparse_grid(N.USER_ITEM),
    "user_item_span_days": _span(N.USER_ITEM),
    "user_category_span_days": _span(N.USER_CATEGORY),
    # families and feature tables
    "user_features": _family(N.USER),
    "item_features": _family(N.ITEM),
    "category_features": _family(N.CATEGORY),
    "user_item_features": _family(N.USER_ITEM),
    "user_category_features": _family(N.USER_CATEGORY),
    "training_set": _training_set,
    "training_set_all_options": _training_set_all_options,
    "scoring_set": _scoring_set,
    # sampling, model, ranking
    "negative_sample": _negative_sample,
    "balanced_training_set": _balanced_training_set,
    "log_from_csv": _log_from_csv,
    "csv_rejects": _csv_rejects,
    "items_from_csv": _items_from_csv,
    "reloaded_clean_log": _reloaded_clean_log,
    "train_pairs_behaviors": _train_pairs_behaviors,
    "item_unique_users_approx": _item_unique_users_approx,
    "incremental_training_set": _incremental_training_set,
    "gbt_scores": _gbt_scores,
    "boosted_trees": _boosted_trees,
    "boosted_scores": _boosted_scores,
    "topk_recommendations": _topk(TOP_K),
    "topk_recommendations_short": _topk(SHORT_TOP_K),
    "cutoff_sweep": _cutoff_sweep,
    "offline_eval": _offline_eval,
}
