"""Top-k export and offline evaluation against next-day purchases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import PURCHASE
from ..functions.exprs import div_or_null

PAIR = ["user_id", "item_id"]


def _order() -> list[Column]:
    # ties on prob break on the keys, so the cut is deterministic
    return [F.col("prob").desc(), F.col("user_id").asc(), F.col("item_id").asc()]


TEST_SCORE_FEATURES = ["ui_cnt_w_1", "ui_cnt_w_2", "ui_cnt_w_3", "ui_cnt_w_4", "uc_cnt_w_4"]


def fixed_test_score(scoring: DataFrame) -> DataFrame:
    """A score any SQL engine reproduces, to test ranking apart from the model."""
    s = (8 * F.col("ui_cnt_w_4") + 4 * F.col("ui_cnt_w_3") + 2 * F.col("ui_cnt_w_2")
         + F.col("ui_cnt_w_1") + F.col("uc_cnt_w_4"))
    return scoring.select(*PAIR, s.cast("double").alias("prob"))


def topk(scored: DataFrame, k: int) -> DataFrame:
    """The k best pairs (a bounded top-k: each task keeps k rows)."""
    return scored.orderBy(*_order()).limit(k).select(*PAIR)


def next_day_purchases(log: DataFrame, score_day) -> DataFrame:
    """Distinct pairs bought on the day after the scoring day (the truth)."""
    return (log.filter((F.col("day") == F.date_add(F.lit(score_day), 1))
                       & (F.col("behavior_type") == PURCHASE))
               .select(*PAIR).distinct())


def _metrics(tp: Column, n_pred: Column, n_actual: Column) -> list[Column]:
    p = div_or_null(tp, n_pred)
    r = div_or_null(tp, n_actual)
    f1 = F.try_divide(F.lit(2.0) * p * r, p + r)
    return [p.alias("precision"), r.alias("recall"), f1.alias("f1")]


def offline_eval(scored: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: tp, predicted, actual, precision, recall, F1 over all
    distinct predicted pairs. Undefined ratios are NULL."""
    n_actual = truth.select(F.count(F.lit(1))).scalar()
    hits = truth.select(*PAIR, F.lit(True).alias("_hit"))
    counts = (scored.select(*PAIR).distinct()
              .join(hits, PAIR, "left")
              .agg(F.count_if(F.col("_hit").isNotNull()).alias("tp"),
                   F.count(F.lit(1)).alias("n_predicted")))
    return counts.select("tp", "n_predicted", n_actual.alias("n_actual"),
                         *_metrics(F.col("tp"), F.col("n_predicted"), n_actual))


def cutoff_sweep(scored: DataFrame, truth: DataFrame, cutoffs) -> DataFrame:
    """Precision / recall / F1 of the top c pairs, for each cutoff c.

    The top max(c) rows are taken once (bounded), ranked, and each row is
    counted for every cutoff it falls under.
    """
    kmax = max(cutoffs)
    top = scored.orderBy(*_order()).limit(kmax)
    # ranking within the bounded top-k rows only
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(*_order())))
    hits = truth.select(*PAIR, F.lit(True).alias("_hit"))
    n_actual = truth.select(F.count(F.lit(1))).scalar()
    per = (ranked.join(hits, PAIR, "left")
                 .withColumn("cutoff", F.explode(F.array(*[F.lit(c) for c in cutoffs])))
                 .filter(F.col("rank") <= F.col("cutoff"))
                 .groupBy("cutoff")
                 .agg(F.count_if(F.col("_hit").isNotNull()).alias("tp"),
                      F.count(F.lit(1)).alias("n_predicted")))
    return per.select("cutoff", "tp", "n_predicted", n_actual.alias("n_actual"),
                      *_metrics(F.col("tp"), F.col("n_predicted"), n_actual))
