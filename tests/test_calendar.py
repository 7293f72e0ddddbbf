
import datetime as dt

from pyspark.sql import functions as F

from morrowcart.config import Calendar
from morrowcart.operators import calendar as C

D = dt.date

# label day -> (first window day, last window day, active days, shift, 5d, 3d, 7d active days)
GOLDEN_2014 = {
    D(2014, 12, 18): (D(2014, 12, 7), D(2014, 12, 17), 9, 0, 5, 3, 5),
    D(2014, 12, 17): (D(2014, 12, 6), D(2014, 12, 16), 9, 2, 5, 4, 7),
    D(2014, 12, 16): (D(2014, 12, 5), D(2014, 12, 15), 9, 2, 5, 3, 7),
    D(2014, 12, 15): (D(2014, 12, 4), D(2014, 12, 14), 9, 0, 3, 2, 5),
    D(2014, 12, 14): (D(2014, 12, 3), D(2014, 12, 13), 9, 0, 3, 1, 5),
}


def _active(spark, cal, split):
    days = C.spine_days(C.spine(spark, cal, split), cal)
    days = days.filter(~F.col("day").isin([F.lit(x) for x in cal.blackout_days]))
    rows = (days.groupBy("label_day")
                .agg(F.min("day").alias("first"), F.max("day").alias("last"),
                     F.count(F.lit(1)).alias("n"), F.count_if("f_5d").alias("n5"),
                     F.count_if("f_3d").alias("n3"), F.count_if("f_7d").alias("n7"),
                     F.count_if("f_1d").alias("n1"))
                .collect())
    return {r.label_day: r for r in rows}


def test_label_days_2014():
    days = C.label_days(Calendar.reference())
    assert len(days) == 15
    assert days[:5] == [D(2014, 12, d) for d in (18, 17, 16, 15, 14)]
    assert days[5:] == [D(2014, 12, d) for d in range(10, 0, -1)]


def test_label_days_fixture():
    days = C.label_days(Calendar.fixture())
    want = [D(2024, 1, d) for d in (30, 29, 28, 27, 26, 22, 21, 20, 19, 18, 17, 16, 15, 14, 13)]
    assert days == want


def test_golden_windows_2014(spark):
    cal = Calendar.reference()
    got = _active(spark, cal, "train")
    assert len(got) == 15
    for L, (first, last, n, shift, n5, n3, n7) in GOLDEN_2014.items():
        r = got[L]
        assert (r.first, r.last, r.n, r.n5, r.n3, r.n7, r.n1) == (first, last, n, n5, n3, n7, 1)
    for d in range(1, 11):
        L = D(2014, 12, d)
        r = got[L]
        assert r.first == L - dt.timedelta(days=9) and r.last == L - dt.timedelta(days=1)
        assert (r.n, r.n5, r.n3, r.n7) == (9, 5, 3, 7)
    shifts = {r.label_day: r.shift for r in C.lookback_bounds(spark, cal).collect()}
    for L, g in GOLDEN_2014.items():
        assert shifts[L] == g[3]


def test_golden_score_window_2014(spark):
    cal = Calendar.reference()
    r = _active(spark, cal, "score")[D(2014, 12, 19)]  # label_day = the predicted day
    assert (r.first, r.last, r.n, r.n5, r.n3, r.n7, r.n1) == (
        D(2014, 12, 10), D(2014, 12, 18), 7, 6, 4, 6, 1)


def test_fanout_table_is_bounded(spark):
    cal = Calendar.reference()
    n = C.spine_days(C.spine(spark, cal, "both"), cal).count()
    assert n <= cal.spine_rows_max


def test_no_blackout_calendar(spark):
    cal = Calendar(end_label=D(2024, 1, 30), score_day=D(2024, 1, 30), blackout_days=())
    days = C.label_days(cal)
    assert days == [D(2024, 1, 30) - dt.timedelta(days=i) for i in range(15)]
    b = C.window_bounds(spark, cal).collect()
    assert all((r.label_day - r.win_start).days == 9 for r in b)  # day > L - 10


def test_aligned_score_window_matches_next_label(spark):
    cal = Calendar.reference()
    r = _active(spark, cal.with_end(D(2014, 12, 19), D(2014, 12, 18)), "train")[D(2014, 12, 19)]
    a = C.spine_days(C.score_spine(spark, cal, aligned=True), cal)
    a = a.filter(~F.col("day").isin([F.lit(x) for x in cal.blackout_days]))
    got = a.agg(F.min("day"), F.max("day"), F.count(F.lit(1)), F.count_if("f_1d")).collect()[0]
    assert tuple(got) == (r.first, r.last, r.n, 1)
    assert a.select("label_day").distinct().collect()[0][0] == D(2014, 12, 19)


def test_golden_table_from_fixture_data(spark):
    """The same golden table, read off the driver's data at sf0.01 (every day
    has events): 2024-01-30 plays 2014-12-18, the blackout is 01-23/24."""
    from morrowcart.plans import registry as R

    got = {r.label_day: (r.n_days_5d, r.n_days_3d, r.n_days_7d)
           for r in R.QUERIES["lookback_bounds"](spark, "/root/testdata/sf0.01").collect()}
    shift = D(2024, 1, 30) - D(2014, 12, 18)
    for L, g in GOLDEN_2014.items():
        assert got[L + shift] == g[4:], L
    assert all(v == (5, 3, 7) for k, v in got.items() if k <= D(2024, 1, 22))
    w = R.QUERIES["window_bounds"](spark, "/root/testdata/sf0.01").collect()
    assert len(w) == 15 and all(r.n_window_days == 9 and r.n_window_rows > 0 for r in w)
