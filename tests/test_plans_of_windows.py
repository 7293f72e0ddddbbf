"""Running totals, sparse grids and the item filter: results beside the plain
form's, and what their plans move."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from morrowcart.config import Calendar
from morrowcart.functions import names as N
from morrowcart.operators import calendar as C
from morrowcart.operators import clean as CL
from morrowcart.operators import counts as K
from morrowcart.operators import cumulative as CU
from morrowcart.operators import extras as X
from morrowcart.operators.activity import activity_table, key_days, snapshots

CAL = Calendar.reference()


@pytest.fixture(scope="module")
def log(spark):
    """Busy and sparse keys over 50 days, gaps longer than a window, a hot user."""
    from morrowcart.sources.schemas import CLEAN_SCHEMA

    rng, first = random.Random(5), dt.date(2014, 11, 1)
    rows = []
    for i in range(4000):
        user = 1 if i % 3 == 0 else rng.randint(2, 40)
        item = rng.randint(1, 30)
        day = first + dt.timedelta(days=rng.choice([0, 1, 2, 46, 47] if user % 5 == 0 else range(49)))
        rows.append((i, user, item, item % 4, rng.choice([1, 1, 1, 2, 3, 4]), rng.randint(0, 23), day))
    return spark.createDataFrame(rows, CLEAN_SCHEMA)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(tuple, df.select(*[f"`{c}`" for c in sorted(df.columns)]).collect()))


@pytest.mark.parametrize("e", N.ENTITIES, ids=lambda e: e.name)
@pytest.mark.parametrize("split", ["train", "score", "both"])
def test_differences_of_running_totals_equal_window_sums(spark, log, e, split):
    sp = C.spine(spark, CAL, split)
    if split == "both":
        sp = sp.where("split = 'train' OR label_day > DATE '2014-12-18'")
    plain = K.entity_counts(log, C.spine_days(sp, CAL), e, CAL)
    got = CU.cumulative_counts(activity_table(log), sp, e, CAL)
    assert got.columns == plain.columns
    assert _rows(got) == _rows(plain)


def test_a_sample_limits_the_running_totals(spark, log):
    sp = C.train_spine(spark, CAL)
    sample = spark.createDataFrame([(dt.date(2014, 12, 18), 1), (dt.date(2014, 12, 9), 1), (dt.date(2014, 12, 18), 99)], "label_day date, user_id long")
    days = C.spine_days(sp, CAL)
    assert _rows(CU.cumulative_counts(log, sp, N.USER, CAL, sample)) == _rows(K.entity_counts(log, days, N.USER, CAL, sample=sample)) != []


def test_a_key_day_meets_few_bounds(spark, log):
    """A busy key's days meet the bounds next to them, not every window that
    holds them, and the totals need no shuffle after the key's."""
    sp = C.train_spine(spark, CAL)
    kd = key_days(activity_table(log), N.CATEGORY)
    totals, bounds = CU.running_totals(kd, N.CATEGORY), CU.bound_days(sp, CAL)
    met = CU.as_of(totals, bounds, CAL, "DATE '2014-11-01'", "DATE '2014-12-18'")
    assert met.groupBy("item_category", "label_day", "bound_day").count().where("count > 1").count() == 0
    per_bound = met.groupBy("item_category", "day", "bound_day").agg(F.countDistinct("label_day").alias("n"))
    fan = snapshots(kd, C.spine_days(sp, CAL)).count()
    assert met.count() < fan and per_bound.count() > 0
    # a longer window: the fan-out grows with it, the bounds do not
    wide = Calendar(end_label=CAL.end_label, score_day=CAL.score_day, blackout_days=CAL.blackout_days, slot=30)
    sp30 = C.train_spine(spark, wide)
    met30 = CU.as_of(totals, CU.bound_days(sp30, wide), wide, "DATE '2014-10-01'", "DATE '2014-12-18'").count()
    assert met30 <= met.count() * 1.1 and snapshots(kd, C.spine_days(sp30, wide)).count() > 2 * fan
    plain, cumulative = K.entity_counts(activity_table(log), C.spine_days(sp, CAL), N.CATEGORY, CAL), CU.cumulative_counts(activity_table(log), sp, N.CATEGORY, CAL)
    count = lambda df: len(re.findall(r"Exchange hashpartitioning", _plan(df)))
    assert count(cumulative) == count(plain)


def test_edges_of_running_totals(spark, log):
    sp = C.train_spine(spark, CAL)
    assert CU.cumulative_counts(log.where("false"), sp, N.USER, CAL).count() == 0
    null_day = log.limit(3).withColumn("day", F.lit(None).cast("date"))
    assert CU.cumulative_counts(null_day, sp, N.USER, CAL).count() == 0


def test_grids_are_sparse_until_the_output(spark, log):
    days = C.spine_days(C.train_spine(spark, CAL), CAL)
    for df in (X.hour_grid(log, days, N.USER), X.hour_grid_lookback(log, C.recent_days(spark, CAL))):
        sums = re.findall(r"sum\(", _plan(df))
        assert 0 < len(sums) < 20                                  # no sum per cell
    grid = X.sparse_hour_grid(log, days, N.USER_ITEM)
    cells = grid.select(F.size("grid").alias("n"), F.expr("aggregate(map_values(grid), 0L, (a, x) -> a + x)").alias("total"))
    assert cells.where("n = 0 OR n > 96").count() == 0
    last = log.join(F.broadcast(days.where("f_1d").select("day")), "day")
    assert cells.agg(F.sum("total")).first()[0] == last.count()


def test_grid_rows_without_an_hour(spark, mk_log):
    """A row without a usable hour counts in no cell; its key stays with zeros."""
    log = mk_log([(1, 10, 3, 1, "2014-12-17", None), (2, 10, 3, 1, "2014-12-17", 30), (2, 10, 3, 4, "2014-12-17", 23)])
    days = C.spine_days(C.train_spine(spark, CAL), CAL)
    got = {r.user_id: r for r in X.hour_grid(log, days, N.USER).where("label_day = DATE '2014-12-18'").collect()}
    assert sum(got[1][c] for c in N.grid_names(N.USER)) == 0
    assert got[2].u_grid_23_4 == 1 and sum(got[2][c] for c in N.grid_names(N.USER)) == 1


def test_item_filter_keeps_every_listed_item(spark):
    """Nothing listed is lost, few others pass, and any size gives the same rows."""
    items = spark.range(0, 60_000, 3).selectExpr("id AS item_id").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS item_id"))
    log = spark.range(100_000).selectExpr("id AS event_id", "IF(id % 1000 = 0, NULL, id % 70000) AS item_id", "id AS _bucket", "'x' AS `a.b`")
    n = items.count()
    filter_ = CL.item_filter(items, n)
    assert filter_.count() * CL.FILTER_BUCKET == CL._filter_bits(n) and filter_.where("size(_words) != 512").count() == 0
    right = _rows(CL.semi_item_subset(log, items))
    passed = CL.maybe_listed(log, filter_, n)
    assert passed.columns == log.columns
    assert len(right) <= passed.count() <= len(right) + 0.04 * 100_000
    for size in (None, 1, 10 * n):                                  # 1: a full filter only passes more
        assert _rows(CL.semi_item_subset_filtered(log, items, size)) == right
    assert CL.semi_item_subset_filtered(log, items.where("false")).count() == 0
    assert CL.semi_item_subset_filtered(log.where("false"), items).count() == 0
    assert CL._filter_bits(10**12) == CL.FILTER_MAX_BITS


def test_the_log_is_cut_before_its_shuffle(spark):
    """With broadcasts of tables off, the filter lies below the log's exchange."""
    items = spark.range(0, 5000, 50).selectExpr("id AS item_id")
    log = spark.range(20_000).selectExpr("id AS event_id", "id % 5000 AS item_id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = CL.semi_item_subset_filtered(log, items, 100)
        plan = _plan(df)
        assert plan.index("SortMergeJoin") < plan.index("Exchange hashpartitioning(item_id") < plan.index("BroadcastHashJoin")
        assert df.count() == 400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_grids_stay_sparse_until_the_output(spark, mk_log):
    """Joins move a grid as one map of its filled cells, not as 96 columns; the output has them all."""
    from morrowcart.config import Calendar, FeatureOptions
    from morrowcart.functions import names as N
    from morrowcart.operators import calendar as C
    from morrowcart.operators import families as FAM
    from morrowcart.operators.samples import train_labels

    cal, opts = Calendar.fixture(), FeatureOptions.all()
    log = mk_log([(1, 10, 0, 1, "2024-01-28", 5), (1, 10, 0, 1, "2024-01-28", 5), (1, 10, 0, 4, "2024-01-29", 23), (2, 11, 1, 2, "2024-01-29", 0)])
    sp = C.train_spine(spark, cal)
    days, sample = C.spine_days(sp, cal), train_labels(log, sp)
    grids = {k: p for k, p in FAM.pieces(sample, log, days, cal, opts).items() if p.features[0].endswith("_00_1")}
    assert sorted(grids) == ["ucg", "ug", "ug2", "ug5", "uig"]
    for p in grids.values():
        assert set(p.build().columns) == {*p.on, "grid"} and len(p.features) == 96
    rows = {(str(r.label_day), r.user_id, r.item_id): r for r in FAM.assemble(sample, log, days, cal, opts).collect()}
    first, last = rows["2024-01-29", 1, 10], rows["2024-01-30", 1, 10]
    cells = lambda r, names: {n: r[n] for n in names if r[n]}
    assert cells(first, N.grid_names(N.USER_ITEM)) == {"ui_grid_05_1": 2} and first.label == 1
    assert cells(last, N.grid_names(N.USER)) == {"u_grid_23_4": 1}
    assert cells(last, N.lookback_grid_names(2)) == {"u_grid2d_05_1": 2, "u_grid2d_23_4": 1}
    assert cells(rows["2024-01-30", 2, 11], N.grid_names(N.USER_CATEGORY)) == {"uc_grid_00_2": 1}
