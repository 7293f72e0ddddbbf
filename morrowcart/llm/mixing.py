"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's size is its number of words `[^\\x20\\x09-\\x0D]+`. Sources, by
code point with null last, weigh 1, 2, 3, repeating; targets share the total
of all sizes by weight, stop at `EPOCHS` times their source's size, and the
excess is shared again by weight until no target is above its stop.

A source's target is taken in whole epochs first: every document counts
floor(target / size of the source) times. The rest is a weighted sample
without replacement: each document draws an exponential key -ln(u) / w (u a
hash of the seed and its id, w its quality weight), documents are sorted by
key within their source, and a prefix sum of their sizes runs up to the rest
of the budget; the document that crosses it is taken in part. Keys come from
hashes, so reruns agree.

The prefix sums run in two levels: keys are cut into `BUCKETS` ranges, whose
sizes are summed by task and then cumulated (one row per source and bucket);
only the bucket in which a source's budget ends is sorted, so a source with a
third of all rows never meets in one task.

Quality weights come from labels: `QUALITY` of the label, 1.0 without one. Null
texts have size 0 and take 0; a null id draws its key from the empty string;
repeated rows tie in their key and are taken in any order among equals.
Sources are one row each (names and sums), ordered once to weigh them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

EPOCHS = 3
WEIGHTS = (1, 2, 3)
QUALITY = {0: 0.25, 1: 1.0}
SEED = "mix-1"
BUCKETS = 4096


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def key_of(id_col: str, weight: Column, seed: str = SEED) -> Column:
    """-ln(u) / w with u in (0, 1) from 52 bits of a digest."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double")
    return -F.ln((h + 0.5) / F.lit(float(1 << 52))) / weight


def targets(sources: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """`sources` (source, source_size) with `weight` and `target`.

    A stop that binds stays bound, so sharing the excess is a loop over sums:
    one row comes back per round, rounds end when no further source binds.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    s = stored(sources.withColumn("r", rank).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("r") - 1, F.lit(len(weights))) + 1).cast("int")).cast("long")).drop("r"), "source-weights")
    stop = F.col("source_size") * epochs
    rest, share, bound = None, None, F.lit(False)
    n_bound = -1
    while True:
        row = s.agg(F.sum("source_size").alias("total"), F.sum(F.when(bound, stop).otherwise(F.lit(0))).alias("bound"),
                    F.sum(F.when(bound, 0).otherwise(F.col("weight"))).alias("weight"), F.count_if(bound).alias("n")).first()
        rest, share = (row["total"] or 0) - (row["bound"] or 0), row["weight"] or 0
        if row["n"] == n_bound or not share:
            break
        n_bound = row["n"]
        bound = stop * F.lit(share) <= F.col("weight") * F.lit(rest)
    if not share:
        return s.withColumn("target", stop.cast("double"))
    return s.withColumn("target", F.when(bound, stop.cast("double")).otherwise((F.col("weight") * F.lit(rest)).cast("double") / F.lit(float(share))))


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", labels: DataFrame | None = None,
        weights=WEIGHTS, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """(id, source, size, source_size, target, taken) for every row of `docs`;
    `labels` (id, quality) gives the quality weights (1.0 without)."""
    rows = docs.select(F.col(id_col), F.col(source).alias("source"), size_of(text).alias("size"))
    if labels is not None:  # joined to sizes, not texts
        rows = label_weight(stored(rows, "mix-sizes"), labels, id_col)
    else:
        rows = rows.withColumn("_weight", F.lit(1.0))
    rows = rows.select(id_col, "source", "size", key_of(id_col, F.col("_weight"), seed).alias("key"))
    rows = stored(rows.withColumn("bucket", F.least(F.lit(BUCKETS - 1), F.floor(F.lit(BUCKETS) * (1 - F.exp(-F.col("key"))))).cast("int")), "mix-keys")
    by_bucket = stored(rows.groupBy("source", "bucket").agg(F.sum("size").alias("size")), "mix-buckets")
    t = targets(by_bucket.groupBy("source").agg(F.sum("size").alias("source_size")), weights, epochs)
    # whole epochs, and the words that are left to sample
    t = stored(t.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.try_divide("target", "source_size"))).otherwise(0).cast("long"))
               .withColumn("rest", (F.floor("target") - F.col("whole") * F.col("source_size")).cast("long")), "mix-targets")
    before = F.coalesce(F.sum("size").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = (by_bucket.withColumn("before", before).join(t.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
            .where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("size") >= F.col("rest")))
            .select("s", F.col("bucket").alias("last"), "before"))
    t = t.withColumnRenamed("source", "s").join(edge.withColumnRenamed("s", "s2"), F.col("s").eqNullSafe(F.col("s2")), "left").drop("s2")
    r = rows.join(t, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    in_edge = F.col("bucket") == F.col("last")
    upto = Window.partitionBy("source", "bucket").orderBy("key", id_col).rowsBetween(Window.unboundedPreceding, -1)
    sampled = r.where(in_edge).withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(upto), F.lit(0)))))
    others = r.where(~F.coalesce(in_edge, F.lit(False))).withColumn("part", F.when(F.col("bucket") < F.col("last"), F.col("size")).otherwise(0))
    return (sampled.unionByName(others)
            .select(id_col, "source", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("part")).cast("long").alias("taken")))


def label_weight(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """`docs` with `_weight` from labels.quality; several labels of one id count by their largest."""
    q = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max("quality").alias("_q"))
    w = F.lit(1.0)
    for k, v in QUALITY.items():
        w = F.when(F.col("_q") == k, F.lit(v)).otherwise(w)
    return docs.join(q, docs[id_col] == F.col("_id"), "left").withColumn("_weight", w).drop("_id", "_q")
