"""Joins that stay balanced when one key holds a large share of the rows.

``split_hot_join(left, right, on)`` is ``left LEFT JOIN right USING (on)``
for a ``right`` that is unique on ``on``. Keys of ``left`` with more than
``n / max_hot`` rows (n = rows of ``left``) and at least ``min_rows`` are
"hot": there can be at most ``max_hot`` of them, since their counts add up to
at most n (``config.HotKeys`` has the defaults). Their ``right`` rows (at most ``max_hot``, a proven bound) are
broadcast and the hot ``left`` rows are joined where they are, without a
shuffle; every other key takes the ordinary shuffle join. So no task receives
a hot key's rows as one partition, and nothing unbounded is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import HotKeys

MAX_HOT_KEYS = HotKeys.max_keys
MIN_HOT_ROWS = HotKeys.min_rows


def hot_keys(left: DataFrame, on: list[str], max_hot: int | None = None,
             min_rows: int | None = None) -> DataFrame:
    """Keys of ``left`` holding more than 1/max_hot of its rows (and at least
    min_rows): at most max_hot rows. Counting uses partial aggregation, so a
    hot key is collapsed before the shuffle."""
    max_hot = MAX_HOT_KEYS if max_hot is None else max_hot
    min_rows = MIN_HOT_ROWS if min_rows is None else min_rows
    n = left.select(F.count(F.lit(1))).scalar()
    counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return (counts.filter((F.col("_n") * F.lit(max_hot) > n) & (F.col("_n") >= F.lit(min_rows)))
                  .select(*on))


def split_hot_join(left: DataFrame, right: DataFrame, on: list[str],
                   max_hot: int | None = None, min_rows: int | None = None) -> DataFrame:
    hot = F.broadcast(hot_keys(left, on, max_hot, min_rows))
    cold = left.join(hot, on, "left_anti").join(right, on, "left")
    right_hot = right.join(hot, on, "left_semi")
    warm = left.join(hot, on, "left_semi").join(F.broadcast(right_hot), on, "left")
    return cold.unionByName(warm)
