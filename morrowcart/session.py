"""Spark session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the engine is designed for. AQE coalesces small shuffles, splits
# skewed join partitions and turns joins with a small measured side into
# broadcast joins at run time.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # the status store keeps plan descriptions even without the UI; feature
    # plans are large, so long-lived sessions keep only recent history
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "morrowcart", extra: dict | None = None) -> SparkSession:
    """The session of every entry point. Master and shuffle partitions are left
    to the cluster's configuration unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for checkpoints.

    Read from the session (the context's checkpoint dir, else
    ``spark.checkpoint.dir``). If neither is set, ``fallback`` is used: a
    caller passes a folder it already knows to be shared, such as the batch
    job's output folder. Only a local-mode session with neither gets a fresh
    temporary folder; a cluster without one is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        d = tempfile.mkdtemp(prefix="morrowcart-ckpt-")
    sc.setCheckpointDir(d)
    return d


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back: what
    several branches of a plan read is computed once, and lineage ends there."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
