"""Training and scoring tables: samples with all their features.

Each builder stores two narrow tables in the shared folder, the activity
table (the only reader of the log) and the samples, and assembles the
features from them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Calendar, FeatureOptions, HotKeys
from ..session import stored
from .activity import activity_table
from .calendar import score_spine, spine_days, train_spine
from .families import NO_OPTIONS, assemble
from .samples import score_pairs, train_labels
from .sampling import balanced_training_set

#: label days of scoring snapshots are moved this far while both tables are
#: built in one plan, so that they cannot meet a training label day
SCORE_SHIFT = 100_000


def stored_activity(log: DataFrame) -> DataFrame:
    return stored(activity_table(log), "activity") if "n" not in log.columns else log


def training_set(spark: SparkSession, log: DataFrame, cal: Calendar, behaviors=None,
                 opts: FeatureOptions = NO_OPTIONS, hot: HotKeys | None = None) -> DataFrame:
    """All label days in one plan: (label_day, user, item, category, label, features)."""
    sp, act = train_spine(spark, cal), stored_activity(log)
    sample = stored(train_labels(act, sp, behaviors), "samples")
    return assemble(sample, act, spine_days(sp, cal), cal, opts, hot=hot)


def sampled_training_set(spark: SparkSession, log: DataFrame, cal: Calendar, ratio: int, seed: int, behaviors=None,
                         opts: FeatureOptions = NO_OPTIONS, hot: HotKeys | None = None) -> DataFrame:
    """The balanced training set: rows are drawn from the narrow label table,
    and features are built for the drawn keys only."""
    sp, act = train_spine(spark, cal), stored_activity(log)
    labels = stored(train_labels(act, sp, behaviors), "labels")
    sample = stored(balanced_training_set(labels, ratio, seed), "samples")
    return assemble(sample, act, spine_days(sp, cal), cal, opts, hot=hot)


def scoring_set(spark: SparkSession, log: DataFrame, cal: Calendar, behaviors=None, aligned: bool = False,
                opts: FeatureOptions = NO_OPTIONS, wanted: list[str] | None = None, hot: HotKeys | None = None) -> DataFrame:
    """Pairs active on the scoring day S with the same features (or only the
    ``wanted`` ones); ``label_day`` is S + 1, the day predicted
    (``aligned=True``: training bounds for S + 1)."""
    sp, act = score_spine(spark, cal, aligned), stored_activity(log)
    sample = stored(score_pairs(act, sp, behaviors), "samples")
    return assemble(sample, act, spine_days(sp, cal), cal, opts, wanted, hot)


def feature_tables(spark: SparkSession, log: DataFrame, cal: Calendar, behaviors=None, aligned: bool = False,
                   opts: FeatureOptions = NO_OPTIONS, hot: HotKeys | None = None,
                   labels: DataFrame | None = None) -> DataFrame:
    """Training and scoring rows from one plan, tagged by ``split``.

    The scoring snapshot is one more row of the calendar, so every family is
    aggregated once for both tables. Inside the plan its label day is moved
    far beyond the calendar: a scoring day followed by a training label day
    then needs no other plan. Scoring rows get a NULL label. ``labels``
    replaces the training samples (e.g. by drawn ones).
    """
    train, score = train_spine(spark, cal), score_spine(spark, cal, aligned)
    act = stored_activity(log)
    moved = spine_days(score, cal).withColumn("label_day", F.date_add("label_day", SCORE_SHIFT))
    days = spine_days(train, cal).unionByName(moved)
    labels = train_labels(act, train, behaviors) if labels is None else labels
    pairs = score_pairs(act, score, behaviors).withColumn("label_day", F.date_add("label_day", SCORE_SHIFT)) \
        .withColumn("label", F.lit(None).cast("int"))
    sample = stored(labels.unionByName(pairs.select(*labels.columns)), "samples")
    last = F.lit(cal.score_day + dt.timedelta(days=1))
    is_score = F.col("label_day") == F.date_add(last, SCORE_SHIFT)
    return (assemble(sample, act, days, cal, opts, hot=hot)
            .withColumn("split", F.when(is_score, F.lit("score")).otherwise(F.lit("train")))
            .withColumn("label_day", F.when(is_score, last).otherwise(F.col("label_day"))))
