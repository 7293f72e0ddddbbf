"""Point-in-time calendar: label days, windows, lookbacks, and the fan-out table.

The reference loops over label days in Python and slices the log each time.
Here the calendar is a small DataFrame (the "spine"), one row per label day,
with its bounds as columns. ``spine_days`` expands it to one row per
(label_day, day) with a flag per window; joining the log to it on ``day``
evaluates every label day in one job. Its size is fixed by the calendar
(``Calendar.spine_rows_max``), never by the data, so it is broadcast.

Rules, with B the contiguous blackout days:
  * a label day L is valid iff L and L-1 are not in B; the ``n_labels``
    latest valid days up to ``end_label`` are used;
  * training window: L - len < day < L, len = slot + |B| if L >= max(B),
    else slot;
  * lookback k: day >= L - k - shift, shift = |B| if L - probe is in B;
    always inside the window;
  * last day ("1d"): day = L - 1;
  * scoring day S (its snapshot's label_day is S + 1, the predicted day):
    S - (slot - 1) < day <= S, 1d is S, lookbacks day >= S - k - shift with
    the shift tested on S - probe.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Calendar
from ..functions.names import lookback_labels


def _label() -> Column:
    return F.col("label_day")


def _in_blackout(day: Column, cal: Calendar) -> Column:
    if not cal.blackout_days:
        return F.lit(False)
    return day.isin([F.lit(d) for d in cal.blackout_days])


def label_days(cal: Calendar) -> list[dt.date]:
    """The ``n_labels`` valid label days, latest first (calendar arithmetic
    on the configuration only; no data involved)."""
    bad = set(cal.blackout_days)
    out = []
    for i in range(cal.search_days):
        d = cal.end_label - dt.timedelta(days=i)
        if d not in bad and d - dt.timedelta(days=1) not in bad:
            out.append(d)
        if len(out) == cal.n_labels:
            break
    return out


def label_spine(spark: SparkSession, cal: Calendar) -> DataFrame:
    """The training label days as a local relation: a constant table the
    optimizer folds, with no job of its own, broadcast wherever it is used."""
    rows = ", ".join(f"(DATE '{d.isoformat()}')" for d in label_days(cal))
    return spark.sql(f"SELECT col1 AS label_day FROM VALUES {rows}")


def _lookback_columns(cal: Calendar, ref: Column) -> dict[str, Column]:
    shift = F.when(_in_blackout(F.date_sub(ref, cal.lookback_probe), cal),
                   F.lit(cal.n_blackout)).otherwise(F.lit(0))
    cols = {"shift": shift}
    for k, name in zip(cal.lookbacks, lookback_labels(cal)):
        cols[f"lb_{name}_start"] = F.date_sub(ref, F.lit(k) + F.col("shift"))
    return cols


def _train_bounds(df: DataFrame, cal: Calendar, ref: Column) -> DataFrame:
    """Training-window bounds relative to the label day ``ref``."""
    if cal.blackout_days:
        win_len = F.when(ref >= F.lit(cal.last_blackout), F.lit(cal.slot + cal.n_blackout)) \
                   .otherwise(F.lit(cal.slot))
    else:
        win_len = F.lit(cal.slot)
    df = df.withColumns({
        "win_start": F.date_sub(ref, win_len - 1),
        "win_end": F.date_sub(ref, 1),
        "day1": F.date_sub(ref, 1),
    })
    for name, c in _lookback_columns(cal, ref).items():
        df = df.withColumn(name, c)
    return df


def train_spine(spark: SparkSession, cal: Calendar) -> DataFrame:
    """Label days with their window, last day and lookback bounds."""
    df = label_spine(spark, cal).select(F.lit("train").alias("split"), _label())
    return _train_bounds(df, cal, _label())


def score_spine(spark: SparkSession, cal: Calendar, aligned: bool = False) -> DataFrame:
    """The scoring snapshot. Its ``label_day`` is the day being predicted,
    S + 1 for scoring day S, as for training rows (label day = the day whose
    purchases are predicted), so training and scoring snapshots can share
    one plan. By default the bounds are the original's: a window of slot-1
    days ending on (and including) S, last day S, lookbacks ``day >= S - k -
    shift`` with the shift tested on S - probe.

    ``aligned=True`` gives instead exactly the bounds of a training label
    day S + 1, so score features are on the training scale.
    """
    label = cal.score_day + dt.timedelta(days=1)
    df = spark.sql(f"SELECT col1 AS split, col2 AS label_day FROM VALUES ('score', DATE '{label.isoformat()}')")
    if aligned:
        return _train_bounds(df, cal, _label())
    score_day = F.date_sub(_label(), 1)
    df = df.withColumns({
        "win_start": F.date_sub(score_day, cal.slot - 2),
        "win_end": score_day,
        "day1": score_day,
    })
    for name, c in _lookback_columns(cal, score_day).items():
        df = df.withColumn(name, c)
    return df


def spine(spark: SparkSession, cal: Calendar, split: str = "train") -> DataFrame:
    if split == "train":
        return train_spine(spark, cal)
    if split == "score":
        return score_spine(spark, cal)
    if split == "both":
        return train_spine(spark, cal).unionByName(score_spine(spark, cal))
    raise ValueError(split)


def spine_days(sp: DataFrame, cal: Calendar) -> DataFrame:
    """(split, label_day, base_day, day) for every window day, with window flags.

    ``f_1d`` marks the last day, ``f_<k>d`` the lookback suffixes;
    ``base_day`` is the day after the last one.
    """
    flags = {"f_1d": F.col("day") == F.col("day1")}
    for name in lookback_labels(cal):
        flags[f"f_{name}"] = F.col("day") >= F.col(f"lb_{name}_start")
    return (sp.select("split", "label_day", "day1",
                      *[f"lb_{n}_start" for n in lookback_labels(cal)],
                      F.explode(F.sequence("win_start", "win_end")).alias("day"))
              .select("split", "label_day", F.date_add("day1", 1).alias("base_day"), "day",
                      *[c.alias(n) for n, c in flags.items()]))


def fan_out(log: DataFrame, days: DataFrame) -> DataFrame:
    """Attach every log row to each label day whose window holds its day.

    An equi-join on ``day`` against the broadcast calendar table: no shuffle
    of the log, and each row meets at most ``slot + |B|`` label days.
    """
    return log.join(F.broadcast(days), "day")


def window_bounds(spark: SparkSession, cal: Calendar) -> DataFrame:
    return train_spine(spark, cal).select("label_day", "win_start", "win_end")


def lookback_bounds(spark: SparkSession, cal: Calendar) -> DataFrame:
    return train_spine(spark, cal).select(
        "label_day", "shift", *[f"lb_{n}_start" for n in lookback_labels(cal)])


def score_bounds(spark: SparkSession, cal: Calendar) -> DataFrame:
    return score_spine(spark, cal).drop("split")


def window_coverage(log: DataFrame, sp: DataFrame, cal: Calendar) -> DataFrame:
    """Each snapshot's bounds with what the log holds inside them: rows and
    active days in the window, on the last day, and per lookback. The log is
    counted by day first (one row per day), then attached to the snapshots;
    snapshots without data keep their row with zeros."""
    stats = [F.expr("sum(n) AS n_window_rows"), F.expr("count(1) AS n_window_days"),
             F.expr("sum(CASE WHEN f_1d THEN n ELSE 0L END) AS n_1d_rows")]
    names = ["n_window_rows", "n_window_days", "n_1d_rows"]
    for n in lookback_labels(cal):
        stats.append(F.expr(f"count_if(f_{n}) AS n_days_{n}"))
        names.append(f"n_days_{n}")
    by_day = log.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    agg = fan_out(by_day, spine_days(sp, cal)).groupBy("label_day").agg(*stats)
    return sp.join(agg, "label_day", "left").na.fill(0, subset=names)


def label_activity(log: DataFrame, sp: DataFrame) -> DataFrame:
    """Each label day with its candidate rows (on the day before) and its
    purchase rows (on the label day itself)."""
    days = (sp.select("label_day", F.col("day1").alias("day"), F.lit(True).alias("is_pair"))
              .unionByName(sp.select("label_day", F.col("label_day").alias("day"),
                                     F.lit(False).alias("is_pair"))))
    agg = (fan_out(log, days).groupBy("label_day")
           .agg(F.expr("count_if(is_pair) AS n_pair_rows"),
                F.expr("count_if(NOT is_pair AND behavior_type = 4) AS n_purchase_rows")))
    return (sp.select("label_day").join(agg, "label_day", "left")
              .na.fill(0, subset=["n_pair_rows", "n_purchase_rows"]))


def recent_days(spark: SparkSession, cal: Calendar, ks=(2, 5)) -> DataFrame:
    """(label_day, lookback_days, day) for the last k days before each label
    day, L - k <= day < L, not clipped to the window (hour-grid lookbacks)."""
    sp = label_spine(spark, cal).withColumn("base_day", _label())
    out = None
    for k in ks:
        part = recent_days_of(sp, k).withColumn("lookback_days", F.lit(k))
        out = part if out is None else out.unionByName(part)
    return out


def recent_days_of(snapshots: DataFrame, k: int) -> DataFrame:
    """(label_day, day) for the k days before each snapshot's ``base_day``."""
    base = F.col("base_day")
    return snapshots.select("label_day", F.explode(F.sequence(F.date_sub(base, k), F.date_sub(base, 1))).alias("day"))
