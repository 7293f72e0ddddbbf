"""Helpers shared by the training-data operators: stored intermediate tables,
byte-level word hashing on Arrow buffers, and small bounded filters."""

from __future__ import annotations

import ctypes
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from morrowcart.session import checkpoint_dir

U64 = np.uint64
PIECE = 1 << 21  # bytes hashed at once; longer documents are hashed in such pieces


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # workers on this machine import this package whatever the working folder;
    # on a cluster the package is shipped with --py-files
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared checkpoint folder and read it back: lineage is
    cut by a table every executor can read again."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(col: str = "text"):
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.encode(F.coalesce(F.col(col), F.lit("")), "UTF-8")


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, size: str = "4m") -> None:
    """Texts go to Python workers in batches of some `size` bytes; a session that
    names its own bound keeps it. A batch lies several times in an executor
    beside its heap (Arrow vectors, the stream's buffer, the worker), and Spark's
    own bound of 64 MB lets a whole task's texts be one batch. Rows and results
    stay the same."""
    if BATCH not in spark.conf.getAll:
        spark.conf.set(BATCH, size)


def released(run):
    """`run` (of mapInArrow), handing memory back to the system at its end:
    Python workers are kept for the tasks of later stages, and what an allocator
    retains in each of them counts against the executor."""
    def until_end(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass
    return until_end


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective), wrapping uint64 arithmetic."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_GOLD = 0x9E3779B97F4A7C15
BYTE = mix((np.arange(1, 257, dtype=U64)) * U64(_GOLD))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
BYTE_FOLDED = BYTE[_FOLD]
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_P = U64(0x5851F42D4C957F2D)  # odd, so it has an inverse modulo 2**64
_P_INV = U64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW.get("p", ())) < n:
        for k, base in (("p", _P), ("q", _P_INV)):
            a = np.full(n, base, dtype=U64)
            a[0] = 1
            _POW[k] = np.multiply.accumulate(a)
    return _POW["p"][:n], _POW["q"][:n]


def binary_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow binary array without nulls; offsets start at 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    width = np.int64 if pa.types.is_large_binary(col.type) else np.int32
    off = np.frombuffer(col.buffers()[1], dtype=width)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return (buf[off[0]:off[-1]] if len(off) else buf), off - (off[0] if len(off) else 0)


def pieces(off: np.ndarray, size: int = PIECE):
    """Ranges [i, j) of documents with about `size` bytes together, at least one each."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, side="right")) - 1)
        yield i, j
        i = j


def _spans(buf: np.ndarray, off: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes outside `space` in the documents of `buf`."""
    on = ~space[buf]
    first, last = on.copy(), on.copy()
    first[1:] &= ~on[:-1]
    last[:-1] &= ~on[1:]
    starts = off[:-1][(off[:-1] < off[1:])]
    first[starts] = on[starts]
    ends = off[1:][(off[:-1] < off[1:])] - 1
    last[ends] = on[ends]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, table_: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end), both ascending. The
    polynomial sums run over pieces of bounded length, so one very long
    document costs no more memory per byte."""
    out = np.empty(len(start), dtype=U64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + PIECE, side="right")))
        lo, hi = int(start[i]), int(end[j - 1])
        p, q = _powers(max(PIECE, hi - lo))
        acc = np.empty(hi - lo + 1, dtype=U64)
        acc[0] = 0
        np.cumsum(table_[buf[lo:hi]] * p[:hi - lo], out=acc[1:])
        out[i:j] = (acc[end[i:j] - lo] - acc[start[i:j] - lo]) * q[start[i:j] - lo]
        i = j
    return mix(out + (end - start).astype(U64) * U64(_GOLD))


def word_hashes(buf: np.ndarray, off: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words (A-Z folded) of documents laid end to end;
    words are `[^\\x20\\x09-\\x0D]+` unless another `space` is given.

    Returns (hash, start, end, word_offsets): document d has the words
    word_offsets[d]:word_offsets[d+1].
    """
    start, end = _spans(buf, off, space)
    return span_hashes(buf, start, end, BYTE_FOLDED), start, end, np.searchsorted(start, off)


# ---- a bounded filter of keys: 2**bits bits, never a list of all keys ----

def key_filter(keys: DataFrame, col: str, count: int, max_bits: int = 27) -> np.ndarray:
    """Bit table of the 64-bit keys in `keys.col`, for use inside tasks.

    Its size is bounded (2**max_bits bits, 16 MB) whatever the number of
    keys; beyond that more keys pass that are not in the table, which costs
    work downstream (the exact join that follows drops them), never a result.
    """
    bits = int(min(max_bits, max(16, np.ceil(np.log2(max(1, count) * 16)))))

    def fill(batches):
        table_ = np.zeros(1 << bits, bool)
        for b in batches:
            table_[slots(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64), bits)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(table_).tobytes()], pa.binary())], ["bits"])

    out = np.zeros(1 << (bits - 3), np.uint8)
    parts = keys.select(F.col(col).cast("long")).where(F.col(col).isNotNull()).repartition(8).mapInArrow(fill, "bits binary")
    for r in parts.toLocalIterator():  # eight tables of fixed size
        out |= np.frombuffer(r["bits"], np.uint8)
    return out


def slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mix(keys.view(U64) + U64(_GOLD)) >> U64(64 - bits)).astype(np.int64)


def may_hold(table_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bits = int(np.log2(len(table_))) + 3
    s = slots(keys, bits)
    return (table_[s >> 3] >> (7 - (s & 7)).astype(np.uint8)) & 1 == 1
