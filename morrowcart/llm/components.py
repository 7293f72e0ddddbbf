"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import released, stored


def _forest(batches):
    """Links of one partition reduced to one star per local component."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for b in batches:
        for a, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            ra, rc = root(a), root(c)
            if ra != rc:
                parent[max(ra, rc)] = min(ra, rc)
    rows = [(x, root(x)) for x in parent if root(x) != x]
    a = np.array(rows, dtype=np.int64).reshape(-1, 2)
    for i in range(0, len(a), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(a[i:i + 100_000, 0]), pa.array(a[i:i + 100_000, 1])], ["u", "v"])


def union(lab: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the links (i, j) into `lab`, where every row points at its component's first row."""
    while True:
        a, b = lab[i], lab[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(lab, np.maximum(a, b), np.minimum(a, b))
        while (lab[lab] != lab).any():
            lab[:] = lab[lab]


def components(links: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    Each partition first reduces its links to a forest, which keeps a hot
    node's links from meeting in one task; large-star and small-star steps
    then alternate until nothing changes. Every step is stored, so a lost
    executor costs at most one step. Self links and nulls are ignored.
    """
    e = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u != v")
    e = stored(e.mapInArrow(released(_forest), "u long, v long").distinct(), name)
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # large-star links all point down: the smaller neighbours of u are all its v
        small_min = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_min, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small_min.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        seen = Observation()  # count and checksum come with the write
        e = stored(small.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")), name)
        if seen.get == before:
            break
        before = seen.get
    # converged: every node points at its component's smallest node
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
