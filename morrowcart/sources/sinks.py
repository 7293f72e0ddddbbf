"""Writers. Every table goes to a shared path and is written whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_clean_log(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet partitioned by day. The rebalance by day puts a day's rows into
    as few tasks as their size needs (adaptive execution splits a large day and
    merges small ones), so files grow with the data, not with tasks x days;
    within a file rows are sorted by user and item."""
    (df.hint("rebalance", F.col("day")).sortWithinPartitions("day", "user_id", "item_id")
       .write.mode(mode).partitionBy("day").parquet(path))


def write_feature_table(df: DataFrame, path: str, mode: str = "overwrite",
                        partition_by: str | None = None) -> None:
    """Wide tables (431 columns) are read whole by the next step, so they are
    not split by label day: that would multiply files (x15) and per-file
    column-writer overhead for no pruning gain. ``label_day`` stays a column;
    ``partition_by`` splits by a column with few values (e.g. ``split``)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def write_topk_csv(df: DataFrame, path: str) -> None:
    """The exported pairs (bounded by k, so one file) with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_rejects(rejects: DataFrame, path: str) -> None:
    """Rejected rows (reason, record) by reason, for repair and delivery anew."""
    rejects.write.mode("overwrite").partitionBy("reason").parquet(path)


def overwrite_days(df: DataFrame, path: str, column: str) -> None:
    """Replace only the partitions of ``column`` that ``df`` has rows for."""
    (df.hint("rebalance", F.col(column)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(column).parquet(path))
