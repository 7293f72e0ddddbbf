"""Benchmark decontamination by latent semantic retrieval.

1. Every document is cut into passages of `PASSAGE` words. One pass over all
   documents sums, per word bucket, the passages that hold it (document
   frequency) and a random sketch of their co-occurrence matrix M = T'T
   (M times a Gaussian matrix). Nystrom's method turns the sketch, weighted by
   idf, into the leading singular directions of the TF-IDF passages; the
   directions of the benchmark's own TF-IDF passages that these leave out are
   added. A space has room for all of them: the benchmark is cut into blocks of
   at most `RANK` less the corpus' directions, each with a space of its own, so
   no passage loses length in it however many items there are.
2. Documents are searched by overlapping windows (three strides): the cosine
   of a window and a benchmark passage in the latent space, relative to the
   window's TF-IDF norm, has to reach `COSINE`. There is no cap on candidates.
3. For each candidate the longest common subsequence of words between the
   benchmark passage and the surroundings of the window is computed exactly:
   it must hold `LCS` of the passage's words, and `ANSWER` of its last
   `ANSWER_WORDS` words (where an item's answer stands) in order.

Words are runs of letters and digits, A-Z folded; punctuation separates, so
changed case or punctuation hides nothing. What returns to the driver is
bounded by the word buckets, not by the corpus. The benchmark is searched in
slices of `SLICE` items, so what is broadcast has a bound whatever its size; a
slice's blocks share one pass over the texts.

Null and empty texts and items match nothing. Items of fewer than `SHORT` words
need every word in order. Repeated rows each report their matches. An empty
benchmark or an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binary_column, pieces, released, text_bytes, U64, word_hashes

BUCKET_BITS = 15
STRIDE = 16
PASSAGE = 3 * STRIDE
SKETCH = 16
RANK = 128
COSINE = 0.25
LCS = 0.6
ANSWER_WORDS = 5
ANSWER = 0.6
SHORT = 8
SLICE = 1_000  # some ten blocks, up to 8 MB each
PIECE = 1 << 18
SEED = 11
_SEPARATES = ~np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> U64(64 - BUCKET_BITS)).astype(np.int64)


def _gaussian() -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(1 << BUCKET_BITS, SKETCH)).astype(np.float32)


def corpus_sketch(docs: DataFrame, text: str = "text") -> tuple[int, np.ndarray, np.ndarray]:
    """(passages, document frequency by bucket, M times the Gaussian matrix)."""
    size = 1 << BUCKET_BITS

    def run(batches):
        omega, y, df, total = _gaussian(), np.zeros((size, SKETCH), np.float32), np.zeros(size, np.int64), 0
        for b in batches:
            buf, off = binary_column(b.column(0))
            for i, j in pieces(off, PIECE):
                h, _, _, w = word_hashes(buf[off[i]:off[j]], off[i:j + 1] - off[i], _SEPARATES)
                if not len(h):
                    continue
                n = np.diff(w)
                per = -(-n // PASSAGE)
                passage = np.repeat(np.cumsum(per) - per, n) + (np.arange(len(h)) - np.repeat(w[:-1], n)) // PASSAGE
                pair = np.sort((passage << BUCKET_BITS) | _bucket(h))
                pair = pair[np.concatenate(([True], pair[1:] != pair[:-1]))]
                p, k = pair >> BUCKET_BITS, (pair & (size - 1)).astype(np.uint16)
                total += int(per.sum())
                df += np.bincount(k, minlength=size)
                starts = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
                mean = np.add.reduceat(omega[k], starts, axis=0)
                o = np.argsort(k, kind="stable")
                at = np.flatnonzero(np.concatenate(([True], k[o][1:] != k[o][:-1])))
                row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(p))))
                y[k[o][at]] += np.add.reduceat(mean[row[o]], at, axis=0)
        used = np.flatnonzero(df)
        cols = [pa.array(used, pa.int64()), pa.array(df[used], pa.int64())] + [pa.array(y[used, c].astype(np.float32), pa.float32()) for c in range(SKETCH)]
        yield pa.RecordBatch.from_arrays(cols, names)
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([total], pa.int64())] + [pa.array([0.0], pa.float32())] * SKETCH, names)

    names = ["bucket", "df"] + [f"y{c}" for c in range(SKETCH)]
    parts = docs.select(text_bytes(text).alias("b")).mapInArrow(released(run), "bucket long, df long, " + ", ".join(f"y{c} float" for c in range(SKETCH)))
    sums = parts.groupBy("bucket").agg(F.sum("df").alias("df"), *[F.sum(f"y{c}").alias(f"y{c}") for c in range(SKETCH)]).toPandas()  # one row a bucket
    total = int(sums.loc[sums["bucket"] == -1, "df"].sum())
    sums = sums[sums["bucket"] >= 0]
    df, y = np.zeros(size), np.zeros((size, SKETCH))
    df[sums["bucket"].to_numpy()] = sums["df"]
    y[sums["bucket"].to_numpy()] = sums[[f"y{c}" for c in range(SKETCH)]]
    return total, df, y


@dataclass
class Block:
    first: int                            # its first passage
    row: np.ndarray                       # row of a bucket in `words`, -1 if it is all zero
    words: np.ndarray                     # row x rank: idf times the latent directions, in steps of `step`
    step: float
    latent: np.ndarray                    # passage x rank, rows scaled to length 1


@dataclass
class Model:
    idf2: np.ndarray                      # squared idf by bucket
    blocks: list = field(default_factory=list)  # latent spaces, each of some of the passages
    item: list = field(default_factory=list)    # of each passage
    hashes: list = field(default_factory=list)  # its words
    last: list = field(default_factory=list)    # the item's last words


def _orthonormal(rows: np.ndarray, least: float = 1e-6) -> np.ndarray:
    """Orthonormal columns that span the rows, by their Gram matrix: no copy of
    the rows' size but the result."""
    val, vec = np.linalg.eigh((rows @ rows.T).astype(np.float64))
    ok = val > least * max(1e-300, val.max(initial=0))
    return rows.T @ (vec[:, ok] / np.sqrt(val[ok])).astype(np.float32)


def build(sketch: tuple[int, np.ndarray, np.ndarray], items: list[tuple[int, str]]) -> Model:
    """The latent spaces of the corpus and these items (at most SLICE)."""
    total, df, y = sketch
    idf = np.log((1.0 + total) / (1.0 + df)) + 0.1  # a word of every passage keeps some weight
    size = len(idf)
    # Nystrom: M ~ Y (Omega'Y)^-1 Y'; weighted by idf on both sides its range is that of idf * Y
    omega = _gaussian().astype(float)
    core = omega.T @ y
    val, vec = np.linalg.eigh((core + core.T) / 2)
    ok = val > 1e-9 * max(1e-300, val.max(initial=0))
    u = _orthonormal(((idf[:, None] * y) @ (vec[:, ok] / np.sqrt(val[ok]))).T.astype(np.float32)) if ok.any() else np.zeros((size, 0), np.float32)
    item, hashes, last = [], [], []
    for key, text in items:
        raw = (text or "").encode()
        h = word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), _SEPARATES)[0] if raw else np.empty(0, U64)
        if not len(h):
            continue
        n = max(1, round(len(h) / (PASSAGE + STRIDE)))
        for part in np.array_split(h, n):  # long items by passages of even length
            item.append(key)
            hashes.append(part.tolist())
            last.append(part[-ANSWER_WORDS:].tolist() if n > 1 else h[-ANSWER_WORDS:].tolist())
    room = RANK - u.shape[1]
    blocks = [_block(lo, hashes[lo:lo + room], idf, u) for lo in range(0, len(item), room)]
    return Model((idf ** 2).astype(np.float32), blocks, item, hashes, last)


def _block(first: int, hashes: list, idf: np.ndarray, u: np.ndarray) -> Block:
    """The space of the directions `u` and of all these passages."""
    b = np.zeros((len(hashes), len(idf)), np.float32)
    for r, h in enumerate(hashes):
        b[r, _bucket(np.array(h, dtype=U64))] = 1.0
    b *= idf.astype(np.float32)
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
    rest = b - (b @ u) @ u.T if u.shape[1] else b
    space = np.concatenate([u, _orthonormal(rest)], axis=1)
    del rest
    latent = b @ space
    del b
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    # 12 bits a value: a stride's sum fits 16 bits; buckets without weight need no row
    space *= idf.astype(np.float32)[:, None]
    step = max(float(space.max(initial=0)), -float(space.min(initial=0))) / 2047 or 1.0
    space /= step
    steps = np.rint(space, out=space).astype(np.int16)
    del space
    some = steps.any(axis=1)
    row = np.where(some, np.cumsum(some) - 1, -1)
    return Block(first, row, steps[some], step, latent.astype(np.float32))


def lcs(words: list[int], masks: dict[int, int], n: int) -> int:
    """Longest common subsequence with the passage behind `masks`, bit-parallel."""
    full = (1 << n) - 1
    v = full
    for w in words:
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def masks_of(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | (1 << i)
    return out


def matches(buf: np.ndarray, off: np.ndarray, model: Model, masks: list, cosine: float = COSINE):
    """(document, item, cosine, lcs share, answer share) of the verified pairs, the best per pair."""
    if not model.item:
        return
    for i, j in pieces(off, PIECE):
        h, _, _, w = word_hashes(buf[off[i]:off[j]], off[i:j + 1] - off[i], _SEPARATES)
        n = np.diff(w)
        per = -(-n // STRIDE)  # strides of each document
        if not len(h):
            continue
        ends = np.cumsum(per)
        first = np.repeat(w[:-1], per) + (np.arange(ends[-1]) - np.repeat(ends - per, per)) * STRIDE
        doc = np.repeat(np.arange(j - i), per)
        k = _bucket(h)
        # a word counts once a stride; sums by stride run in slices, so a very long text needs no more memory
        pair = np.sort((np.repeat(np.arange(len(first)), np.diff(np.append(first, len(h)))) << BUCKET_BITS) | k)
        pair = pair[np.concatenate(([True], pair[1:] != pair[:-1]))]
        stride, k = pair >> BUCKET_BITS, pair & ((1 << BUCKET_BITS) - 1)
        norm = np.bincount(stride, weights=model.idf2[k], minlength=len(first)).astype(np.float32)
        # a window that starts in the last two strides is part of the one before
        starts = np.flatnonzero((np.arange(len(first)) + 2 < ends[doc]) | (np.arange(len(first)) == (ends - per)[doc]))
        best: dict[tuple[int, int], tuple] = {}
        for block in model.blocks:
            row = block.row[k]
            some = np.flatnonzero(row >= 0)
            full, at = np.unique(stride[some], return_index=True)
            at = np.append(at, len(some))
            sums = np.zeros((len(first), block.words.shape[1]), np.int16)
            for lo in range(0, len(full), 128):  # what a slice gathers fits the cache
                hi = min(lo + 128, len(full))
                sums[full[lo:hi]] = np.add.reduceat(block.words[row[some[at[lo]:at[hi]]]], at[lo:hi] - at[lo], axis=0, dtype=np.int16)
            for lo in range(0, len(starts), 8192):
                own = starts[lo:lo + 8192]
                x, nn = sums[own].astype(np.float32), norm[own].copy()
                for s in (1, 2):  # the next strides of the same document
                    ok = np.flatnonzero(own + s < ends[doc[own]])
                    x[ok] += sums[own[ok] + s]
                    nn[ok] += norm[own[ok] + s]
                cos = (x * (block.step / np.sqrt(np.maximum(nn, 1e-12)))[:, None]) @ block.latent.T
                for r, q in zip(*np.nonzero(cos >= cosine)):
                    d, p = int(doc[own[r]]), block.first + int(q)
                    words, m = model.hashes[p], masks[p]
                    a = max(w[d], first[own[r]] - STRIDE)
                    z = min(w[d + 1], first[own[r]] + PASSAGE + STRIDE)
                    if z - a < LCS * len(words):
                        continue
                    near = h[a:z].tolist()
                    share = lcs(near, m, len(words)) / len(words)
                    if share < (LCS if len(words) >= SHORT else 1.0):
                        continue
                    tail = model.last[p]
                    answer = lcs(near, masks_of(tail), len(tail)) / len(tail)
                    if answer < ANSWER:
                        continue
                    got = (share, float(cos[r, q]), answer)
                    key = (d, p)
                    if key not in best or best[key] < got:
                        best[key] = got
        items: dict[tuple[int, int], tuple] = {}
        for (d, p), got in best.items():
            key = (d, model.item[p])
            if key not in items or items[key] < got:
                items[key] = got
        for (d, it), (share, cos_, answer) in sorted(items.items()):
            yield i + d, it, cos_, share, answer


def _models(docs: DataFrame, benchmark: DataFrame, text: str, item_col: str, item_text: str):
    items = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item_col).cast("long").alias("i"), F.col(item_text).alias("t"))
    slices = max(1, -(-items.count() // SLICE))
    sketch = corpus_sketch(docs, text)
    for s in range(slices):  # bounded by SLICE on average, whatever the benchmark's size
        part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(slices)) == s).orderBy("i", "t").collect()
        yield docs.sparkSession.sparkContext.broadcast(build(sketch, [(r["i"], r["t"]) for r in part]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item, cosine, lcs, answer): one row per row of `docs` and item it holds."""
    src = docs.select(F.col(id_col).alias("id"), text_bytes(text).alias("b"))
    schema = T.StructType([T.StructField("id", src.schema["id"].dataType), T.StructField("item", T.LongType()), T.StructField("cosine", T.DoubleType()),
                           T.StructField("lcs", T.DoubleType()), T.StructField("answer", T.DoubleType())])
    out = None
    for model in _models(docs, benchmark, text, item_col, item_text):
        def run(batches, model=model):
            masks = [masks_of(x) for x in model.value.hashes]
            for b in batches:
                buf, off = binary_column(b.column(1))
                rows = list(matches(buf, off, model.value, masks))
                if rows:
                    d, *rest = zip(*rows)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(d)), pa.array(rest[0], pa.int64()), *[pa.array(x, pa.float64()) for x in rest[1:]]], schema.names)

        part = src.mapInArrow(released(run), schema)
        out = part if out is None else out.unionByName(part)
    return out.withColumnsRenamed({"id": id_col, "item": item_col})


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of `docs` that hold no benchmark item; no shuffle, all columns kept."""
    cols = docs.columns
    at, out = cols.index(text), docs
    for model in _models(docs, benchmark, text, item_col, item_text):
        src = out.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"))

        def run(batches, model=model):
            masks = [masks_of(x) for x in model.value.hashes]
            for b in batches:
                buf, off = binary_column(b.column(0).field(at))  # the row's own text: it moves once; nulls have no bytes
                keep = np.ones(b.num_rows, bool)
                keep[[d for d, *_ in matches(buf, off, model.value, masks)]] = False
                yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(keep))], ["row"])

        out = src.mapInArrow(released(run), T.StructType([T.StructField("row", src.schema["row"].dataType)])).select("row.*")
    return out
