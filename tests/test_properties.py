"""Invariants of the training set on the smallest driver tables."""

import pandas as pd
import pytest

from conftest import SF_SMALL
from morrowcart.config import BEHAVIORS
from morrowcart.functions import names as N
from morrowcart.plans import registry as R


@pytest.fixture(scope="module")
def ts(spark) -> pd.DataFrame:
    return R.QUERIES["training_set"](spark, SF_SMALL).toPandas()


def test_row_count_is_sample_count(spark, ts):
    assert len(ts) == R.QUERIES["train_pairs"](spark, SF_SMALL).count()
    assert not ts.duplicated(["label_day", "user_id", "item_id"]).any()


def test_no_nulls(ts):
    assert not ts.isna().any().any()


def test_lookbacks_nest(ts):
    for e in N.ENTITIES:
        for b in BEHAVIORS:
            c = lambda w: ts[N.cnt(e, w, b)]
            assert (c("3d") <= c("5d")).all() and (c("5d") <= c("7d")).all()
            assert (c("7d") <= c("w")).all() and (c("1d") <= c("3d")).all()


def test_grid_cells_sum_to_last_day_counts(ts):
    for e in (N.USER, N.USER_ITEM, N.USER_CATEGORY):
        for b in BEHAVIORS:
            cells = ts[[N.grid_name(e, h, b) for h in range(24)]].sum(axis=1)
            assert (cells == ts[N.cnt(e, "1d", b)]).all()


def test_distinct_counts_bounded(ts):
    for b in BEHAVIORS:
        assert (ts[f"i_uniq_w_{b}"] <= ts[f"i_cnt_w_{b}"]).all()
        assert (ts[f"u_days_w_{b}"] <= 9).all()
        assert ((ts[f"u_days_w_{b}"] > 0) == (ts[f"u_cnt_w_{b}"] > 0)).all()


def test_sample_pair_active_on_last_day(ts):
    one_day = sum(ts[N.cnt(N.USER_ITEM, "1d", b)] for b in BEHAVIORS)
    assert (one_day > 0).all()


def test_combined_feature_tables_equal_separate_tables(spark):
    from morrowcart.operators.datasets import feature_tables

    lg = R.log(spark, SF_SMALL)
    both = feature_tables(spark, lg, R.CAL)
    cols = R.QUERIES["scoring_set"](spark, SF_SMALL).columns
    for split, name in (("train", "training_set"), ("score", "scoring_set")):
        sep = R.QUERIES[name](spark, SF_SMALL)
        part = both.filter(f"split = '{split}'").select(*sep.columns)
        assert part.exceptAll(sep).count() == 0 and sep.exceptAll(part).count() == 0
    assert both.filter("split = 'score' AND label IS NOT NULL").count() == 0
    assert set(cols) <= set(both.columns)


def test_feature_tables_fallback_when_snapshots_collide(spark):
    import datetime as dt

    from morrowcart.operators.datasets import feature_tables, scoring_set, training_set

    cal = R.CAL.with_end(dt.date(2024, 1, 30), dt.date(2024, 1, 29))  # S + 1 is a label day
    lg = R.log(spark, SF_SMALL)
    both = feature_tables(spark, lg, cal)
    tr, sc = training_set(spark, lg, cal), scoring_set(spark, lg, cal)
    assert both.filter("split = 'train'").count() == tr.count()
    part = both.filter("split = 'score'").select(*sc.columns)
    assert part.exceptAll(sc).count() == 0 and sc.exceptAll(part).count() == 0


def test_count_families_are_rollups_of_user_item_counts(spark):
    """Every entity's counts equal the user x item counts summed over the
    other key, for every window and behaviour."""
    from pyspark.sql import functions as F

    q = lambda name: R.QUERIES[name](spark, SF_SMALL)
    ui = q("user_item_counts").withColumn("item_category", F.col("item_id") % 10)
    ui_cols = N.count_names(N.USER_ITEM, R.CAL)
    for name, e in [("user_counts", N.USER), ("item_counts", N.ITEM),
                    ("category_counts", N.CATEGORY), ("user_category_counts", N.USER_CATEGORY)]:
        keys = ["label_day", *e.keys]
        cols = N.count_names(e, R.CAL)
        rolled = ui.groupBy(*keys).agg(*[F.sum(a).cast("long").alias(b) for a, b in zip(ui_cols, cols)])
        got = q(name).select(*keys, *cols)
        assert got.exceptAll(rolled).count() == 0 and rolled.exceptAll(got).count() == 0, name


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [k for k in R.QUERIES if k not in ("gbt_scores", "training_set_all_options")])
def test_plans_have_no_unbounded_operators(spark, name):
    from morrowcart.plans.explain import summarize

    s = summarize(_plan(R.QUERIES[name](spark, SF_SMALL)))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "Expand"):
        assert bad not in s, (bad, s)


def test_feature_tables_read_the_log_once(spark, monkeypatch):
    """The activity table is the only reader of the log; features and samples read what is stored."""
    from morrowcart.operators import datasets

    plans = {}

    def spy(df, name, store=datasets.stored):
        plans.setdefault(name, []).append(_plan(df))
        return store(df, name)
    monkeypatch.setattr(datasets, "stored", spy)
    monkeypatch.setattr(R, "stored", spy)
    for query in ("training_set", "balanced_training_set", "scoring_set", "topk_recommendations", "cutoff_sweep"):
        plans.clear()
        final = _plan(R.QUERIES[query](spark, SF_SMALL))
        reads = [p.count("events.parquet") for ps in plans.values() for p in ps] + [final.count("events.parquet")]
        assert sum(reads) == len(plans["activity"]) == 1, (query, reads)


def test_label_days_are_applied_after_the_shuffle(spark):
    """No label day below the first exchange of the user x item counts."""
    lines = _plan(R.QUERIES["user_item_counts"](spark, SF_SMALL)).split("\n")
    at = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
    scan = next(i for i, x in enumerate(lines) if "events.parquet" in x)
    first = max(i for i in at if i < scan and "item_id" in lines[i] and "user_id" in lines[i])
    assert not any("label_day" in x for x in lines[first:scan + 1])


def test_only_wanted_families_are_built(spark):
    from morrowcart.operators.datasets import scoring_set

    lg = R.log(spark, SF_SMALL)
    wanted = ["ui_cnt_w_1", "uc_cnt_w_4", "u_days_w_1"]
    some = scoring_set(spark, lg, R.CAL, wanted=wanted)
    every = scoring_set(spark, lg, R.CAL)
    assert some.columns == every.columns[:4] + wanted
    assert some.exceptAll(every.select(*some.columns)).count() == 0
    assert "i_uniq" not in _plan(some) and "_grid_" not in _plan(some)
