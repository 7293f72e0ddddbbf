"""The daily run: new days of the log added to stored tables.

Under one output folder (shared storage) lie the clean log and the activity
table, partitioned by ``day``, and the training table, partitioned by
``label_day``. A delivery holds whole days. ``DailyRun.add``

1. cleans it and takes a count and a checksum of every day (one row a day);
2. compares them with the manifest: days that are stored as delivered are
   skipped, so a delivery can be repeated without effect;
3. overwrites the partitions of the changed days only, in the clean log and in
   the activity table;
4. rebuilds the training rows of the label days that can see a changed day (in
   their window, or as the label day itself) and overwrites those partitions;
5. writes a new manifest.

A run that dies between steps leaves the old manifest, so the next one repeats
what is missing; partitions are replaced whole, so repeating is safe. A label
day's rows depend on the log alone, not on the run that built them: the result
is that of one run over all days.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Calendar, FeatureOptions, HotKeys
from ..operators.activity import activity_table
from ..operators.calendar import spine_days, train_spine
from ..operators.clean import clean_log
from ..operators.families import NO_OPTIONS, assemble
from ..operators.samples import train_labels
from ..session import checkpoint_dir, stored
from ..sources.sinks import overwrite_days

MANIFEST = T.StructType([T.StructField("day", T.DateType()), T.StructField("n_rows", T.LongType()), T.StructField("checksum", T.StringType())])


def day_sums(log: DataFrame) -> DataFrame:
    """(day, n_rows, checksum): the checksum does not depend on the rows' order."""
    return log.groupBy("day").agg(F.count(F.lit(1)).alias("n_rows"),
                                  F.sum(F.xxhash64(*[c for c in log.columns if c != "day"]).cast("decimal(38,0)")).cast("string").alias("checksum"))


class DailyRun:
    def __init__(self, spark: SparkSession, cal: Calendar, out: str, behaviors=None, opts: FeatureOptions = NO_OPTIONS,
                 wanted: list[str] | None = None, hot: HotKeys | None = None):
        self.spark, self.cal, self.out = spark, cal, out
        self.behaviors, self.opts, self.wanted, self.hot = behaviors, opts, wanted, hot
        checkpoint_dir(spark, fallback=os.path.join(out, "_checkpoints"))

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"

    def _read(self, name: str, schema) -> DataFrame | None:
        """A stored table, None before the first run."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return self.spark.read.schema(schema).parquet(self.path(name)) if files.exists(folder) else None

    def manifest(self) -> dict[dt.date, tuple[int, str]]:
        table = self._read("manifest", MANIFEST)
        return {} if table is None else {r["day"]: (r["n_rows"], r["checksum"]) for r in table.collect()}

    def affected(self, days: list[dt.date]) -> list[dt.date]:
        """Label days with one of ``days`` in their window or as their label day."""
        spine = train_spine(self.spark, self.cal).select("label_day", "win_start").collect()
        return sorted(r["label_day"] for r in spine if any(r["win_start"] <= d <= r["label_day"] for d in days))

    def add(self, raw: DataFrame, items: DataFrame) -> dict[str, list[dt.date]]:
        """{'days': days replaced, 'label_days': label days rebuilt}."""
        delivered = stored(clean_log(raw, items, self.cal), "delivery")
        sums = {r["day"]: (r["n_rows"], r["checksum"]) for r in day_sums(delivered).collect()}  # a row a day
        known = self.manifest()
        changed = sorted(d for d in sums if d is not None and known.get(d) != sums[d])
        if not changed:
            return {"days": [], "label_days": []}
        rows = delivered.filter(F.col("day").isin(changed))
        overwrite_days(rows, self.path("clean_log"), "day")
        overwrite_days(activity_table(rows), self.path("activity"), "day")
        labels = self.affected(changed)
        if labels:
            self._build(labels)
        known |= {d: sums[d] for d in changed}
        self.spark.createDataFrame([(d, *known[d]) for d in sorted(known)], MANIFEST).coalesce(1).write.mode("overwrite").parquet(self.path("manifest"))
        return {"days": changed, "label_days": labels}

    def _build(self, labels: list[dt.date]) -> None:
        spine = train_spine(self.spark, self.cal).filter(F.col("label_day").isin(labels))
        first = spine.agg(F.min("win_start")).first()[0]
        activity = self.spark.read.parquet(self.path("activity")).filter(F.col("day").between(first, max(labels)))
        sample = stored(train_labels(activity, spine, self.behaviors), "samples")
        rows = assemble(sample, activity, spine_days(spine, self.cal), self.cal, self.opts, self.wanted, self.hot)
        overwrite_days(rows, self.path("training_set"), "label_day")

    def training_set(self) -> DataFrame:
        """The stored rows of the calendar's label days."""
        spine = train_spine(self.spark, self.cal).select("label_day")
        return self.spark.read.parquet(self.path("training_set")).join(F.broadcast(spine), "label_day", "left_semi")
