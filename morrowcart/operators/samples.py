"""Samples: the (user, item) pairs to score for each label day, and their labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PURCHASE
from .calendar import fan_out


def _pairs(log: DataFrame, sp: DataFrame, behaviors=None) -> DataFrame:
    days = sp.select("label_day", F.col("day1").alias("day"))
    rows = log if behaviors is None else log.filter(F.col("behavior_type").isin(list(behaviors)))
    # one category per pair: the smallest, so the choice does not depend on row order
    return (fan_out(rows, days)
            .groupBy("label_day", "user_id", "item_id")
            .agg(F.min("item_category").alias("item_category")))


def train_pairs(log: DataFrame, sp: DataFrame, behaviors=None) -> DataFrame:
    """Distinct (user, item) active on the day before each label day.

    ``behaviors`` optionally restricts the sampled rows (e.g. ``(2, 3)``).
    """
    return _pairs(log, sp, behaviors)


def score_pairs(log: DataFrame, sp: DataFrame, behaviors=None) -> DataFrame:
    """Distinct (user, item) active on the scoring day (``day1`` of the score spine)."""
    return _pairs(log, sp, behaviors)


def train_labels(log: DataFrame, sp: DataFrame, behaviors=None) -> DataFrame:
    """Training pairs with label 1 iff the same pair bought on the label day.

    One aggregation: each log row is attached to the label day after it (as a
    candidate pair) and to its own day (as a purchase), then grouped by
    (label_day, user, item). Pairs are matched on the exact composite key.
    """
    days = (sp.select("label_day", F.col("day1").alias("day"), F.lit(True).alias("is_pair"))
              .unionByName(sp.select("label_day", F.col("label_day").alias("day"),
                                     F.lit(False).alias("is_pair"))))
    is_pair_row = F.col("is_pair")
    if behaviors is not None:
        is_pair_row = is_pair_row & F.col("behavior_type").isin(list(behaviors))
    bought = ~F.col("is_pair") & (F.col("behavior_type") == PURCHASE)
    rows = fan_out(log, days).filter(is_pair_row | bought)
    # one flag aggregate (bit 0: candidate pair, bit 1: bought on the label
    # day): readers of the keys only and readers of the label then share the
    # same aggregate, so Spark reuses its shuffle instead of recomputing it
    flags = F.bit_or(F.when(is_pair_row, F.lit(1)).otherwise(F.lit(0))
                     + F.when(bought, F.lit(2)).otherwise(F.lit(0)))
    return (rows.groupBy("label_day", "user_id", "item_id")
                .agg(F.min(F.when(is_pair_row, F.col("item_category"))).alias("item_category"),
                     flags.alias("_flags"))
                .filter((F.col("_flags") % 2) == 1)
                .select("label_day", "user_id", "item_id", "item_category",
                        F.shiftright(F.col("_flags"), 1).alias("label")))


def label_day_summary(labeled: DataFrame) -> DataFrame:
    return (labeled.groupBy("label_day")
                   .agg(F.count(F.lit(1)).alias("n_pairs"),
                        F.count_if(F.col("label") == 1).alias("n_positive")))


def class_split(labeled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(positives, negatives)."""
    return labeled.filter(F.col("label") == 1), labeled.filter(F.col("label") == 0)


def class_counts(labeled: DataFrame) -> DataFrame:
    return labeled.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"))
