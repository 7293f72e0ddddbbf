"""Quality classifier: random Fourier features over document statistics.

Statistics of the whole text (`STATS`, one pass, bounded per document) are
scaled by the training mean and deviation and mapped to
sqrt(2/D) * cos(W x + b), which approximates a Gaussian kernel. Ridge
regression is solved from normal equations that every partition sums over its
own rows (one D x D matrix a partition, at most `FIT_PARTITIONS` of them); the
raw scores are calibrated by isotonic regression (pool adjacent violators) on
a quarter of the labelled rows that the ridge does not see.

The labelled sample is bounded: the `max_labels` labelled rows that come first
by a hash of their id. Statistics and scores are computed for every row.

Null and empty texts have all statistics 0 and get a score like any other row.
With fewer than two classes among the labels every score is the class prior
(0.5 without labels). Duplicate label rows each count. Equal statistics get
equal scores: raw scores are summed in one order whatever batch a row is in,
rounded to `DIGITS` places, and calibration knots keep `KNOT_GAP` apart.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, binary_column, pieces, stored, text_bytes, word_hashes

STATS = ("log_bytes", "log_words", "word_length", "upper", "digits", "symbols", "spaces", "high_bytes",
         "lines_per_word", "repeated_word", "repeated_neighbour", "repeated_line", "symbol_ends", "capital_words", "bars")
FEATURES = 256
RIDGE = 1e-3
MAX_LABELS = 200_000
FIT_PARTITIONS = 16
THRESHOLD = 0.3
DIGITS = 9
KNOT_GAP = 1e-6

_UPPER, _DIGIT, _LETTER = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91], _DIGIT[48:58] = True, True
_LETTER[65:91], _LETTER[97:123], _LETTER[128:] = True, True, True
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_SYMBOL = ~(_LETTER | _DIGIT | _SPACE)


def _sum_by(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    acc = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return (acc[off[1:]] - acc[off[:-1]]).astype(float)


def _repeats(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """1 - distinct / all of the hashes of each document."""
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    o = np.lexsort((h, doc))
    new = np.concatenate(([True], (h[o][1:] != h[o][:-1]) | (doc[o][1:] != doc[o][:-1]))) if len(h) else np.empty(0, bool)
    n = np.diff(off).astype(float)
    return 1 - np.bincount(doc[o][new], minlength=len(n)) / np.maximum(n, 1) * (n > 0) - (n == 0)


def _statistics(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    h, start, end, w = word_hashes(buf, off)
    size, words = np.diff(off).astype(float), np.diff(w).astype(float)
    one, some = np.maximum(size, 1), np.maximum(words, 1)
    # lines by the document they stand in: empty documents share an offset with the next one
    breaks = np.flatnonzero(buf == 10)
    owner = np.concatenate((np.arange(len(off) - 1), np.searchsorted(off, breaks, side="right") - 1))
    first = np.concatenate((off[:-1], breaks + 1))
    o = np.lexsort((first, owner))
    owner, first = owner[o], first[o]
    last = np.append(first[1:], len(buf))
    lo = np.searchsorted(owner, np.arange(len(off)))
    last[lo[1:] - 1] = off[1:]
    # a line is named by the sum of its words' hashes, an empty one by 0
    acc = np.concatenate((np.zeros(1, U64), np.cumsum(h * U64(2) + U64(1), dtype=U64)))
    lines = acc[np.searchsorted(start, last)] - acc[np.searchsorted(start, first)]
    same = np.zeros(len(h))
    if len(h) > 1:
        same[1:] = h[1:] == h[:-1]
        same[w[:-1][(w[:-1] < w[1:])]] = 0
    return np.column_stack([
        np.log1p(size), np.log1p(words), np.log1p(_sum_by(~_SPACE[buf], off) / some), _sum_by(_UPPER[buf], off) / one,
        _sum_by(_DIGIT[buf], off) / one, _sum_by(_SYMBOL[buf], off) / one, _sum_by(_SPACE[buf], off) / one,
        _sum_by(buf >= 128, off) / one, _sum_by(buf == 10, off) / some, _repeats(h, w), _sum_by(same, w) / some,
        _repeats(lines, lo), _sum_by(_SYMBOL[buf[end - 1]], w) / some,
        _sum_by(_UPPER[buf[start]] & _UPPER[buf[start + (end - start) // 2]] & (end - start > 1), w) / some,
        _sum_by(buf == 124, off) / some])


def statistics(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, x: array of the STATS) for every row."""
    src = docs.select(F.col(id_col).alias("id"), text_bytes(text).alias("b"))
    schema = T.StructType([T.StructField("id", src.schema["id"].dataType), T.StructField("x", T.ArrayType(T.DoubleType(), False))])

    def run(batches):
        for batch in batches:
            buf, off = binary_column(batch.column(1))
            rows = [_statistics(buf[off[i]:off[j]], off[i:j + 1] - off[i]) for i, j in pieces(off)]
            x = np.concatenate(rows) if rows else np.empty((0, len(STATS)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(
                pa.array(np.arange(0, x.size + 1, len(STATS)), pa.int32()), pa.array(x.ravel()))], ["id", "x"])

    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    beta: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def phi(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        # term by term: a matrix product's rounding depends on the batch's shape
        angle = np.tile(self.b, (len(x), 1))
        for j in range(z.shape[1]):
            angle += z[:, j:j + 1] * self.w[j]
        return np.column_stack([np.ones(len(x)), np.sqrt(2 / len(self.b)) * np.cos(angle)])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.round((self.phi(x) * self.beta).sum(axis=1), DIGITS)

    def score(self, x: np.ndarray) -> np.ndarray:
        if len(self.knots) == 0:
            return np.full(len(x), self.values[0])
        return np.interp(self.raw(x), self.knots, self.values)


def isotonic(s: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; knots at the blocks' mean scores, so that the
    interpolated curve rises strictly between blocks. Scores closer than
    `KNOT_GAP` count as one."""
    uniq, inv = np.unique(s, return_inverse=True)
    n = np.bincount(inv).astype(float)
    level: list[list[float]] = []
    for x, k, v in zip(uniq, n, np.bincount(inv, weights=y) / n):
        level.append([v, k, x])
        while len(level) > 1 and (level[-2][0] >= level[-1][0] or level[-1][2] - level[-2][2] < KNOT_GAP):
            v2, k2, x2 = level.pop()
            v1, k1, x1 = level[-1]
            level[-1] = [(v1 * k1 + v2 * k2) / (k1 + k2), k1 + k2, (x1 * k1 + x2 * k2) / (k1 + k2)]
    a = np.array(level)
    # one pseudo row of either class per block keeps 0 and 1 out of reach
    return a[:, 2], (a[:, 0] * a[:, 1] + 0.5) / (a[:, 1] + 1)


def fit(stats: DataFrame, label: str = "label", id_col: str = "doc_id", features: int = FEATURES,
        max_labels: int = MAX_LABELS, seed: int = 7) -> Model:
    """`stats`: id, x and a 0/1 label (rows with a null label are left out)."""
    rows = (stats.where(F.col(label).isNotNull()).select(F.xxhash64(F.col(id_col), F.lit(seed)).alias("h"), "x", F.col(label).cast("double").alias("y"))
            .orderBy("h", "x").limit(max_labels))
    rows = stored(rows.repartition(FIT_PARTITIONS, "h"), "quality-sample")
    k = len(STATS)
    m = rows.agg(F.count("*").alias("n"), F.avg("y").alias("prior"), *[F.avg(F.get("x", F.lit(i))).alias(f"m{i}") for i in range(k)],
                 *[F.stddev_pop(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(k)]).first()
    empty = np.empty(0)
    if not m["n"] or m["prior"] in (0.0, 1.0):
        return Model(np.zeros(k), np.ones(k), np.zeros((k, 1)), np.zeros(1), np.zeros(2), empty, np.array([0.5 if not m["n"] else m["prior"]]))
    mean, dev = (np.array([m[f"{p}{i}"] for i in range(k)]) for p in "ms")
    rng = np.random.default_rng(seed)
    model = Model(mean, np.where(dev > 1e-9, dev, 1.0), rng.normal(0, 1 / np.sqrt(k), (k, features)), rng.uniform(0, 2 * np.pi, features), empty, empty, empty)
    calibration = F.pmod(F.col("h"), F.lit(4)) == 0

    def sums(batches):
        d = features + 1
        a, v = np.zeros((d, d)), np.zeros(d)
        for batch in batches:
            x = np.array(batch.column(0).values.to_numpy()).reshape(-1, k)
            p = model.phi(x)
            a += p.T @ p
            v += p.T @ batch.column(1).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()]), pa.array([v.tobytes()])], ["a", "v"])

    a, v = np.zeros((features + 1, features + 1)), np.zeros(features + 1)
    for r in rows.where(~calibration).select("x", "y").mapInArrow(sums, "a binary, v binary").toLocalIterator():
        a += np.frombuffer(r["a"]).reshape(a.shape)
        v += np.frombuffer(r["v"])
    model.beta = np.linalg.solve(a + RIDGE * max(1, m["n"]) / 100 * np.eye(len(v)), v)

    def raw(batches):
        for batch in batches:
            x = np.array(batch.column(0).values.to_numpy()).reshape(-1, k)
            yield pa.RecordBatch.from_arrays([pa.array(model.raw(x)), batch.column(1)], ["s", "y"])

    held = rows.where(calibration).select("x", "y").mapInArrow(raw, "s double, y double").toPandas()  # max_labels rows at most
    if held.empty:
        held = rows.select("x", "y").mapInArrow(raw, "s double, y double").toPandas()
    model.knots, model.values = isotonic(held["s"].to_numpy(), held["y"].to_numpy())
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """`stats` with `score` in [0, 1] in place of `x`."""
    others = [c for c in stats.columns if c != "x"]
    shared = stats.sparkSession.sparkContext.broadcast(model)
    src = stats.select(F.struct(*others).alias("row"), "x")
    schema = T.StructType([T.StructField("row", src.schema["row"].dataType), T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            x = np.array(batch.column(1).values.to_numpy()).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(x))], ["row", "score"])

    return src.mapInArrow(run, schema).select("row.*", "score")


def classify(docs: DataFrame, labels: DataFrame, trainable: Column, id_col: str = "doc_id", text: str = "text",
             quality: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """(id, score, predicted) for every row of `docs`; labels are learned only
    from rows where `trainable` (a condition on the id) holds."""
    stats = stored(statistics(docs, id_col, text), "quality-stats")
    marked = labels.where(F.col(id_col).isNotNull() & F.col(quality).isNotNull() & trainable).select(F.col(id_col), F.col(quality).alias("_label"))
    model = fit(stats.where(F.col(id_col).isNotNull()).join(marked, id_col), "_label", id_col)
    return score(stats, model).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
