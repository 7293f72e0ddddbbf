"""Embedding near-duplicates by a random-projection tree forest.

Rows are compared only within their label (and length). Exact copies collapse
to one representative by the digest of their bytes. A label's vectors form a
cell; a cell of more than `max_cell` rows is first split by `TREES`
random-projection trees whose cuts come from a bounded sample (`sample_rows`
per round), until every cell is small enough for one task. A node is cut at the
median of a random direction, with a spill overlap around it. A node in which
one vector links with `DENSE` of the rows or more is not: it is cut by the
distance from that vector, rows within a linking distance of the cut going both
ways, which parts no linking pair; where no such cut pays, the node is dealt
out in blocks and every two blocks meet in a cell. Inside a cell all rows are
compared, in blocks, by cosine in double precision. A pair met in several cells
counts in the first one they share, so links can be summed without a list of
pairs. Each cell hands on one link to the smallest id of each of its local
components; connected components of these give the union.

A vector that is null, empty, zero, or holds a null or non-finite component
links with nothing, nor does one with a null label or id. Repeated rows are
vectors of their own that link with each other. A null id gets a null
component and is not kept. Pairs below the threshold never link; a linking
pair is missed only in cells over `max_cell`, if medians part it in all trees
(recall is measured in the tests).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, mix, stored
from .components import components, union

COSINE = 0.98
TREES = 8
LEAF = 512    # rows of a cell compared with all of it at once, at most
DENSE = 0.05
PROBE = 512   # sampled rows of a node compared to find its densest vector
SPILL = 0.1  # share of a node's rows on either side of the median that go both ways
MAX_CELL = 20_000
SAMPLE_ROWS = 200_000


def _direction(dim: int, *key) -> np.ndarray:
    seed = U64(0)
    for k in key:
        seed = mix(np.array([seed ^ U64(k & 0xFFFFFFFFFFFFFFFF)], dtype=U64) + U64(0x9E3779B97F4A7C15))[0]
    v = np.random.default_rng(int(seed)).normal(size=dim)
    return v / np.linalg.norm(v)


def _cut(p: np.ndarray, spill: float) -> tuple[float, float]:
    """Rows with p <= high go left, rows with p >= low go right."""
    low, high = np.quantile(p, [0.5 - spill, 0.5 + spill])
    return float(low), float(high)


def _ball(y: np.ndarray, cosine: float) -> tuple | None:
    """The cut of a node with a dense group, from a sample of it: ("ball", centre, radius)
    or ("pairs",); None without such a group."""
    z = y[np.linspace(0, len(y) - 1, min(PROBE, len(y))).astype(int)]
    near = (z @ z.T >= cosine).sum(axis=1) - 1
    c = near.argmax()
    if near[c] < DENSE * len(z):
        return None
    link = np.sqrt(2 - 2 * cosine)
    d = np.sort(_distance(y, z[c]))
    radius = np.linspace(link / 2, 2, 40)
    inside = np.searchsorted(d, radius + link, side="right") / len(d)
    outside = 1 - np.searchsorted(d, radius) / len(d)
    cost = np.where(np.maximum(inside, outside) <= 0.95, inside ** 2 + outside ** 2, 2)
    k = cost.argmin()
    return ("ball", z[c], radius[k]) if cost[k] <= 0.95 else ("pairs",)


def _distance(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (x @ centre)))


def _sides(x: np.ndarray, cut: tuple, cosine: float, *key) -> tuple[np.ndarray, np.ndarray]:
    """Which rows go left and which go right."""
    if cut[0] == "ball":
        d = _distance(x, cut[1])
        return d <= cut[2] + np.sqrt(2 - 2 * cosine) + 1e-9, d >= cut[2] - 1e-9
    p = x @ _direction(x.shape[1], *key)
    return p <= cut[2], p >= cut[1]


def _earlier(cells: list, here: int) -> np.ndarray:
    """Bits of the cells before `here` of each row, those that several rows have."""
    lesser = [[c for c in x if c < here] for x in cells]
    row = np.repeat(np.arange(len(cells)), [len(x) for x in lesser])
    _, col, times = np.unique(np.array([c for x in lesser for c in x], dtype=np.int64), return_inverse=True, return_counts=True)
    new = np.cumsum(times > 1) - 1
    keep = times[col] > 1
    row, col = row[keep], new[col[keep]]
    bits = np.zeros((len(cells), int((times > 1).sum()) // 64 + 1), U64)
    np.bitwise_or.at(bits, (row, col // 64), U64(1) << (col % 64).astype(U64))
    return bits


def _compare(ids: np.ndarray, x: np.ndarray, weight: np.ndarray, cosine: float, leaf: int, cells: list | None, here: int, budget: int = 1_000_000):
    """(weighted links, first row of the component) for each row of a cell; ids ascend."""
    n = len(ids)
    links, lab = np.zeros(n, dtype=np.int64), np.arange(n)
    bits = _earlier(cells, here) if cells is not None else None
    block = max(1, min(leaf, budget // n))
    for lo in range(0, n, block):
        i, j = np.nonzero(x[lo:lo + block] @ x.T >= cosine)
        i = i + lo
        i, j = i[i != j], j[i != j]
        union(lab, i, j)
        if bits is not None and len(i):  # another cell that both are in may come first
            own = np.ones(len(i), bool)
            for k in range(bits.shape[1]):
                own &= (bits[i, k] & bits[j, k]) == 0
            i, j = i[own], j[own]
        links += np.bincount(i, weights=weight[j], minlength=n).astype(np.int64)
    return links, lab


def unit_vectors(rows: DataFrame, id_col: str, vector: str, label: str) -> DataFrame:
    """(id, label, dim, vec): vec the bytes of the unit vector in doubles, null if it cannot link."""
    src = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("v"))

    def run(batches):
        for b in batches:
            col = b.column(2)
            size = np.asarray(col.value_lengths().fill_null(0))
            flat = col.flatten()
            x = flat.to_numpy(zero_copy_only=False).astype(float)  # nulls become NaN
            at = np.concatenate(([0], np.cumsum(size)))
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(x))))
            out = []
            for i, (lo, hi) in enumerate(zip(at[:-1], at[1:])):
                v, vec = x[lo:hi], None
                if hi > lo and bad[hi] == bad[lo]:
                    top = np.abs(v).max()
                    if top > 0:
                        v = v / top + 0.0
                        vec = (v / np.sqrt((v * v).sum())).tobytes()
                out.append(vec)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(size.astype(np.int32)), pa.array(out, pa.binary())], ["id", "label", "dim", "vec"])

    return src.mapInArrow(run, "id long, label string, dim int, vec binary")


def _route(reps: DataFrame, max_cell: int, sample_rows: int, trees: int, spill: float, cosine: float) -> DataFrame:
    """Rows with `cell` (long) and `cells` (all cells of the row), no cell much over `max_cell`."""
    cur = reps.withColumn("cell", F.xxhash64("label", "dim")).drop("label")
    for level in range(64):
        big = {r["cell"]: (r["n"], r["dim"]) for r in cur.groupBy("cell").agg(F.count("*").alias("n"), F.first("dim").alias("dim"))
               .where(F.col("n") > max_cell).orderBy(F.desc("n")).limit(sample_rows // 64).toLocalIterator()}
        if not big:
            break
        share = min(1.0, sample_rows / sum(n for n, _ in big.values()))
        draw = (F.xxhash64("id", F.lit(level)).bitwiseAND(F.lit((1 << 30) - 1)) < int(share * (1 << 30)))
        got = cur.where(F.col("cell").isin(*big) & draw).select("cell", "vec").limit(2 * sample_rows).toPandas()
        cuts = {}
        for cell, part in got.groupby("cell"):
            n, dim = big[cell]
            x = np.frombuffer(b"".join(part["vec"]), float).reshape(-1, dim)
            for t in range(trees if level == 0 else 1):
                todo = [(x, 1, n, True)]
                while todo:
                    y, node, size, whole = todo.pop()  # whole: no median above, so no link is parted
                    if size <= max_cell or len(y) < 32:
                        if t and whole and node > 1:
                            cuts[cell, t, node] = ("done",)  # the first tree has it
                        continue
                    cut = _ball(y, cosine) or ("median", *_cut(y @ _direction(dim, t, cell, node), spill))
                    if cut[0] == "pairs":
                        cuts[cell, t, node] = ("done",) if t and whole else ("pairs", max(2, int(np.ceil(size / (0.4 * max_cell)))))
                        continue
                    cuts[cell, t, node] = cut
                    left, right = _sides(y, cut, cosine, t, cell, node)
                    whole = whole and cut[0] == "ball"
                    todo += [(y[left], 2 * node, size * left.mean(), whole), (y[right], 2 * node + 1, size * right.mean(), whole)]
        shared = cur.sparkSession.sparkContext.broadcast(cuts)

        def route(batches, level=level):
            cut = shared.value
            for b in batches:
                out = []
                for cell, key, vec in zip(b["cell"].to_pylist(), b["id"].to_pylist(), b["vec"].to_pylist()):
                    to = set()
                    if (cell, 0, 1) in cut:
                        v = np.frombuffer(vec, float)[None, :]
                        for t in range(trees if level == 0 else 1):
                            todo = [1]
                            while todo:
                                node = todo.pop()
                                c = cut.get((cell, t, node))
                                name = mix(np.array([cell & 0xFFFFFFFFFFFFFFFF], U64) + U64(node & 0xFFFFFFFFFFFFFFFF) * U64(1_000_003) + U64(t + 1))
                                if c is None:
                                    to.add(int(name.view(np.int64)[0]))
                                elif c[0] == "pairs":
                                    own = int(mix(np.array([key & 0xFFFFFFFFFFFFFFFF], U64) + U64(level + 1))[0] % U64(c[1]))
                                    for other in range(c[1]):
                                        pair = min(own, other) * c[1] + max(own, other) + 1
                                        to.add(int(mix(name + U64(pair * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)).view(np.int64)[0]))
                                elif c[0] != "done":
                                    left, right = _sides(v, c, cosine, t, cell, node)
                                    todo += [2 * node] * int(left[0]) + [2 * node + 1] * int(right[0])
                    else:
                        to.add(cell)
                    out.append(sorted(to))
                n = [len(x) for x in out]
                take = pa.array(np.repeat(np.arange(len(out)), n))
                keep = b.select([c for c in b.schema.names if c != "cell"]).take(take)
                yield pa.RecordBatch.from_arrays([*keep.columns, pa.array([c for x in out for c in x], pa.int64())], [*keep.schema.names, "cell"])

        cols = [f for f in cur.schema.fields if f.name != "cell"] + [f for f in cur.schema.fields if f.name == "cell"]
        cur = stored(cur.mapInArrow(route, type(cur.schema)(cols)), f"forest-{level}")
        if not cuts:
            break
    of = cur.groupBy("id").agg(F.collect_set("cell").alias("cells"))  # trees x spill entries at most
    return cur.join(of, "id")


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE,
                    trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, max_cell: int = MAX_CELL, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(id, n_links, component_id, kept) for every row."""
    vecs = stored(unit_vectors(rows, id_col, vector, label).withColumn("key", F.when(
        F.col("vec").isNotNull() & F.col("label").isNotNull() & F.col("id").isNotNull(), F.sha2(F.concat("vec", F.encode("label", "UTF-8")), 256))), "unit-vectors")
    reps = vecs.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.first("label").alias("label"),
                                                           F.first("dim").alias("dim"), F.first("vec").alias("vec"))
    reps = stored(reps, "distinct-vectors")
    largest = reps.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    if largest > max_cell:
        cells = _route(reps.drop("key"), max_cell, sample_rows, trees, spill, cosine)
    else:
        cells = reps.select("id", "n", "dim", "vec", F.xxhash64("label", "dim").alias("cell"), F.lit(None).cast("array<long>").alias("cells"))

    def forest(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids = pdf["id"].to_numpy()
        x = np.frombuffer(b"".join(pdf["vec"]), float).reshape(len(pdf), -1)
        several = pdf["cells"].iloc[0] is not None
        links, lab = _compare(ids, x, pdf["n"].to_numpy(), cosine, leaf,
                                [[int(k) for k in c] for c in pdf["cells"]] if several else None, int(pdf["cell"].iloc[0]))
        return pd.DataFrame({"id": ids, "links": links, "partner": ids[lab]})

    out = stored(cells.groupBy("cell").applyInPandas(forest, "id long, links long, partner long"), "forest-links")
    links = out.groupBy("id").agg(F.sum("links").alias("links"))
    comp = components(out, "id", "partner", "vector-components")
    judged = (reps.select("key", "n", F.col("id").alias("rep")).join(links.withColumnRenamed("id", "rep"), "rep", "left")
              .join(comp.withColumnRenamed("node", "rep"), "rep", "left")
              .select("key", (F.col("links") + F.col("n") - 1).alias("links"), F.coalesce("component", "rep").alias("component")))
    return vecs.select("id", "key").join(judged, "key", "left").select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(False)).alias("kept"))
