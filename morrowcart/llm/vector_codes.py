"""Vector code compression with memoised grid cells.

Every vector becomes integers floor(SCALE * x), is cut into `parts` equal
consecutive parts, and each part is replaced by the index of the nearest entry
of its position's codebook (product quantisation). A codebook starts as that
part of the `entries` smallest ids and moves to floor(sum / count) of its
members for `rounds` rounds.

The nearest entry is found through a grid: a part lies in a coarse cell, the
box of 2**CELL_BITS steps a side that its components share. For a cell the
squared distances from its box to every entry are bounded from below and above;
an entry whose least distance exceeds the smallest greatest distance of any
entry is farther than that one for every point of the box, so the cell keeps
only the others. Cells are looked up by hash and remembered within a task; two
cells of one hash are told apart by their coordinates. A part is compared
exactly with its cell's entries only, ties going to the lower index. The result
is that of comparing with all entries, whatever the cell size and however many
cells are remembered (`MEMO` cells a position, then the memory starts anew).

Each round is one scan: a task sums its parts by entry, Spark adds the sums,
and the driver gets parts * entries rows. Nothing of the data is shuffled or
collected but the id, label, code and error of the result. Sums are exact
integers of any size.

Rows whose vector is null or holds null or non-finite components are dropped.
Shorter vectors count as filled up with zeros to the longest vector's length,
and that to a multiple of `parts`. Ids that are null come last among the first
entries, equal ids by their components. With fewer rows than entries there are
fewer entries. Components of any size are compared exactly; an error beyond a
long is returned as the largest long. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from morrowcart.operators.skew import split_hot_join

from .common import U64, mix, stored

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
CELL_BITS = 9
MEMO = 1 << 16
LONG_MAX = (1 << 63) - 1
BLOCK = 1 << 13  # vectors worked on at once


def _floor_scaled(x: float, scale: int) -> int:
    return int(x) * scale if abs(x) >= 2.0 ** 53 else math.floor(x * scale)


def integers(flat: np.ndarray, off: np.ndarray, dim: int, scale: int = SCALE) -> np.ndarray:
    """rows x dim integers, int64 where distances fit it, else Python integers."""
    n = len(off) - 1
    size = np.diff(off)
    wide = np.zeros((n, dim))
    row = np.repeat(np.arange(n), size)
    wide[row, np.arange(len(flat)) - np.repeat(off[:-1], size)] = flat
    limit = 2.0 ** 28 / max(1, dim) ** 0.5
    if not wide.size or np.abs(wide).max() * scale < limit:
        return np.floor(wide * scale).astype(np.int64)
    return np.array([[_floor_scaled(x, scale) for x in r] for r in wide.tolist()], dtype=object).reshape(n, dim)


class Grid:
    """Nearest entries of one codebook (entries x length, integers)."""

    def __init__(self, book: np.ndarray, bits: int = CELL_BITS, memo: int = MEMO):
        self.book, self.bits, self.memo = book, bits, memo
        self.looked_up = self.computed = self.compared = 0
        self._forget()

    def _forget(self) -> None:
        self.keys = np.empty(0, U64)
        self.cells = np.empty((0, self.book.shape[1]), np.int64)
        self.keep = np.empty((0, len(self.book)), bool)

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """cells x entries: the entries not dominated across the cell's box."""
        lo = cells << self.bits
        hi = lo + ((1 << self.bits) - 1)
        least = np.zeros((len(cells), len(self.book)), self.book.dtype)
        most = np.zeros_like(least)
        for j in range(self.book.shape[1]):
            e = self.book[:, j][None, :]
            below, above = lo[:, j][:, None] - e, e - hi[:, j][:, None]
            near = np.maximum(np.maximum(below, above), 0)
            far = np.maximum(np.abs(below), np.abs(above))
            least += near * near
            most += far * far
        return least <= most.min(axis=1, keepdims=True)

    def _hash(self, cells: np.ndarray) -> np.ndarray:
        h = np.full(len(cells), 1469598103934665603, U64)
        for j in range(cells.shape[1]):
            h = mix(h ^ cells[:, j].astype(np.int64).view(U64)) + U64(j)
        return h

    def _kept(self, cells: np.ndarray) -> np.ndarray:
        """Entries to compare with, by row; each cell is computed once while remembered."""
        h = self._hash(cells)
        at = np.minimum(np.searchsorted(self.keys, h), max(0, len(self.keys) - 1))
        known = (self.keys[at] == h) & (self.cells[at] == cells).all(axis=1) if len(self.keys) else np.zeros(len(cells), bool)
        out = np.empty((len(cells), len(self.book)), bool)
        out[known] = self.keep[at[known]]
        rest = np.flatnonzero(~known)
        self.looked_up += len(cells)
        if len(rest):
            first, back = np.unique(h[rest], return_index=True, return_inverse=True)[1:]
            fresh = cells[rest[first]]
            same = (fresh[back] == cells[rest]).all(axis=1)  # false where two cells share a hash
            keep = self.candidates(fresh)
            out[rest[same]] = keep[back[same]]
            if not same.all():
                out[rest[~same]] = self.candidates(cells[rest[~same]])
            self.computed += len(fresh)
            if len(self.keys) + len(fresh) > self.memo:
                self._forget()
            keys = np.concatenate((self.keys, h[rest[first]]))
            o = np.argsort(keys, kind="stable")
            self.keys, self.cells = keys[o], np.concatenate((self.cells, fresh))[o]
            self.keep = np.concatenate((self.keep, keep))[o]
        return out

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row of integers."""
        if x.dtype == object:  # components of any size: cells of Python integers have no hash
            keep = self.candidates(np.array([[v >> self.bits for v in r] for r in x.tolist()], dtype=object).reshape(x.shape))
        else:
            keep = self._kept(x >> self.bits)
        row, entry = np.nonzero(keep)
        self.compared += len(row)
        d = np.zeros(len(row), self.book.dtype if x.dtype != object else object)
        for j in range(x.shape[1]):
            t = x[row, j] - self.book[entry, j]
            d += t * t
        start = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        best = np.minimum.reduceat(d, start) if len(row) else d
        # the first entry of a row that reaches its least distance
        hit = np.flatnonzero(d == np.repeat(best, np.diff(np.append(start, len(row)))))
        hit = hit[np.concatenate(([True], row[hit][1:] != row[hit][:-1]))] if len(hit) else hit
        return entry[hit], best


@dataclass
class Codebooks:
    dim: int                # padded length of a vector
    parts: int
    scale: int
    books: list             # per part: entries x length, as lists of integers

    def arrays(self, dtype) -> list[np.ndarray]:
        return [np.array(b, dtype=dtype).reshape(len(b), self.dim // self.parts) for b in self.books]

    def dtype(self):
        top = max((abs(v) for b in self.books for e in b for v in e), default=0)
        return np.int64 if top < 2.0 ** 28 / max(1, self.dim) ** 0.5 else object

    def sha256(self) -> str:
        """All entries' decimal components by part, entry and position, joined by `,`."""
        return hashlib.sha256(",".join(str(v) for b in self.books for e in b for v in e).encode()).hexdigest()


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is not null and holds only finite components."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return df.where(F.col(vector).isNotNull() & ~bad).withColumn(vector, v)


def _blocks(batch: pa.RecordBatch, col: int, dim: int, scale: int):
    """(first row, integers) of a batch's vectors, some thousands at a time."""
    a = batch.column(col)
    off = np.asarray(a.offsets, dtype=np.int64)
    flat = a.values.to_numpy(zero_copy_only=False)
    for lo in range(0, len(a), BLOCK):
        hi = min(lo + BLOCK, len(a))
        yield lo, integers(flat[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], dim, scale)


def _grids(books: Codebooks, bits: int):
    """Grids by type of integers: one set for int64, one for Python integers, made when needed."""
    made: dict = {}

    def of(x: np.ndarray) -> list[Grid]:
        kind = np.int64 if x.dtype != object and books.dtype() is np.int64 else object
        if kind not in made:
            made[kind] = [Grid(b, bits) for b in books.arrays(kind)]
        return made[kind]
    return of


def _assign(x: np.ndarray, grids: list[Grid]):
    """(rows x parts entries, rows x parts distances)."""
    length = grids[0].book.shape[1]
    if grids[0].book.dtype == object:
        x = x.astype(object)
    got = [g.nearest(x[:, p * length:(p + 1) * length]) if length else (np.zeros(len(x), np.int64), np.zeros(len(x), np.int64))
           for p, g in enumerate(grids)]
    return np.column_stack([e for e, _ in got]), np.column_stack([d for _, d in got])


def _moved(df: DataFrame, vector: str, books: Codebooks, bits: int) -> Codebooks:
    """One round: every entry to the floored mean of its parts."""
    shared = df.sparkSession.sparkContext.broadcast(books)
    parts, length = books.parts, books.dim // books.parts

    def sums(batches):
        b = shared.value
        of, k = _grids(b, bits), len(b.books[0])
        total = [[0] * length for _ in range(parts * k)]
        count = np.zeros(parts * k, np.int64)
        for batch in batches:
            for _, x in _blocks(batch, 0, b.dim, b.scale):
                entry, _ = _assign(x, of(x))
                for p in range(parts):
                    o = np.argsort(entry[:, p], kind="stable")
                    e = entry[o, p]
                    at = np.flatnonzero(np.concatenate(([True], e[1:] != e[:-1])))
                    s = np.add.reduceat(x[o, p * length:(p + 1) * length], at, axis=0)
                    for i, row in zip(e[at].tolist(), s.tolist()):
                        t = total[p * k + i]
                        for j, v in enumerate(row):
                            t[j] += v
                    count[p * k:(p + 1) * k] += np.bincount(entry[:, p], minlength=k)
        rows = []
        for c in np.flatnonzero(count).tolist():
            rows.append((c // k, c % k, 0, -1, int(count[c])))
            for j, v in enumerate(total[c]):  # a sum in digits of 32 bits, so that Spark adds longs
                sign, v, digit = (-1 if v < 0 else 1), abs(v), 0
                while v:
                    rows.append((c // k, c % k, j, digit, sign * (v & 0xFFFFFFFF)))
                    v, digit = v >> 32, digit + 1
        cols = list(zip(*rows)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int32()) for c in cols[:4]], pa.array(cols[4], pa.int64())], ["part", "entry", "pos", "digit", "v"])

    got = (df.select(vector).mapInArrow(sums, "part int, entry int, pos int, digit int, v long")
           .groupBy("part", "entry", "pos", "digit").agg(F.sum("v").alias("v")).collect())  # parts * entries * length rows, for each digit
    new = [[list(e) for e in b] for b in books.books]
    total: dict = {}
    for r in got:
        key = (r["part"], r["entry"], -1 if r["digit"] < 0 else r["pos"])
        total[key] = total.get(key, 0) + (r["v"] << (32 * max(0, r["digit"])))
    for (p, i, j), n in list(total.items()):
        if j < 0:
            new[p][i] = [total.get((p, i, pos), 0) // n for pos in range(length)]
    shared.unpersist()
    return Codebooks(books.dim, parts, books.scale, new)


def fit(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
        rounds: int = ROUNDS, scale: int = SCALE, bits: int = CELL_BITS) -> Codebooks:
    """Codebooks of the usable rows `df` (see `usable`)."""
    longest = df.agg(F.max(F.size(vector)).alias("n")).first()["n"] or 0
    dim = -(-longest // parts) * parts
    ints = F.transform(vector, lambda x: F.floor(x * scale))  # orders rows of equal ids
    first = df.select(F.col(id_col).alias("id"), F.col(vector).alias("v"), ints.alias("o")).orderBy(F.col("id").asc_nulls_last(), "o").limit(entries).collect()
    length = dim // parts
    seeds = [[_floor_scaled(x, scale) for x in r["v"]] + [0] * (dim - len(r["v"])) for r in first]
    books = Codebooks(dim, parts, scale, [[s[p * length:(p + 1) * length] for s in seeds] for p in range(parts)])
    for _ in range(rounds if seeds and length else 0):
        books = _moved(df, vector, books, bits)
    return books


def encode(df: DataFrame, books: Codebooks, vector: str = "embedding", bits: int = CELL_BITS) -> DataFrame:
    """`df` with `code` (indexes in part order, two hex digits each) and `error`
    (squared distances summed over parts) in place of the vector. Columns of
    these names are replaced."""
    others = [c for c in df.columns if c not in (vector, "code", "error")]
    shared = df.sparkSession.sparkContext.broadcast(books)
    src = df.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), vector)
    schema = T.StructType([T.StructField("row", src.schema["row"].dataType), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def run(batches):
        of = _grids(shared.value, bits)
        digits = np.array([f"{i:02x}" for i in range(256)], dtype=object)
        for batch in batches:
            codes, errors = [], []
            for _, x in _blocks(batch, 1, shared.value.dim, shared.value.scale):
                entry, d = _assign(x, of(x))
                codes += ["".join(r) for r in digits[entry].tolist()]
                errors += [min(int(v), LONG_MAX) for v in d.sum(axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], ["row", "code", "error"])

    return src.mapInArrow(run, schema).select("row.*", "code", "error")


def compress(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", **how) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of the usable rows: the
    errors of equal labels (nulls together) add up to `label_error`."""
    rows = usable(df, vector).select(F.col(id_col), F.col(label).alias("_label"), F.col(vector))
    books = fit(rows, id_col, vector, **how)
    coded = stored(encode(rows, books, vector, how.get("bits", CELL_BITS)), "vector-codes")
    key = [F.coalesce(F.col("_label").cast("string"), F.lit("")).alias("_name"), F.col("_label").isNull().alias("_none")]
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")
    named = coded.select(id_col, "code", "error", *key)
    sums = stored(named.groupBy("_name", "_none").agg(total.alias("label_error")), "label-errors")
    # one row a label: broadcast by its measured size, else joined with labels of many rows split off
    return (split_hot_join(named, sums, ["_name", "_none"])
            .select(id_col, "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")))
