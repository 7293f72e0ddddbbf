"""Language identification by prediction by partial matching.

One byte context tree per language, of order `ORDER`: a node is a context
(the last 0..ORDER bytes), its counts are the bytes that followed it in the
language's training texts. A byte costs -log2(c / (n + d)) in the longest
context that has seen it; every longer known context first charges its escape
probability d / (n + d) (n bytes, d distinct bytes seen there); a byte new to
the whole language costs 8 bits more than the escapes. The counts are frozen
after training, so the code length of a text is exact and depends only on its
(ORDER+1)-grams: a batch's distinct grams are priced once and summed by text.

Training counts cover every labelled training row. They are aggregated by
Spark; the model keeps the `max_grams` grams with the largest share of their
language (a documented capacity, so the broadcast model stays under ~10 MB).

Texts are lower-cased and everything but letters becomes one space, so
capitals, digits and punctuation carry no weight. Null texts, and texts
without a letter, get `und` with score 0; ties go to the language whose name
sorts first. Very long texts are priced in pieces of bounded size. With no
training rows every text is `und`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binary_column, pieces, released, U64

ORDER = 3
SLICE = 1 << 18  # bytes priced at once: about 100 bytes of work arrays for each, in every worker
UNFOLDED = 100_000  # grams of a language that a counting task lists beyond twice its distinct ones
MAX_GRAMS = 400_000
UNDETERMINED = "und"


def normalised(col: str = "text") -> Column:
    """Letters in lower case, runs of anything else one space, padded with
    ORDER spaces in front so that the first byte has a full context."""
    letters = F.regexp_replace(F.lower(F.col(col)), r"[^\p{L}]+", " ")
    return F.encode(F.concat(F.lit(" " * ORDER), F.coalesce(letters, F.lit(""))), "UTF-8")


def _grams(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ORDER+1)-byte grams ending at each byte past the padding, and their text."""
    b = buf.astype(U64)
    g = (b[:-3] << U64(24)) | (b[1:-2] << U64(16)) | (b[2:-1] << U64(8)) | b[3:]
    n = np.maximum(np.diff(off) - ORDER, 0)
    doc = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(off[:-1], n)
    return g[at], doc


def _split_long(buf: np.ndarray, off: np.ndarray):
    """Pieces (bytes, offsets, first text); a text longer than SLICE is cut
    into slices that repeat the ORDER bytes before them."""
    for i, j in pieces(off, SLICE):
        lo, hi = off[i], off[j]
        if hi - lo <= 2 * SLICE:
            yield buf[lo:hi], off[i:j + 1] - lo, i
        else:  # pieces() leaves such a text alone in its range
            for s in range(lo, hi - ORDER, SLICE):
                part = buf[s:min(s + SLICE + ORDER, hi)]
                yield part, np.array([0, len(part)]), i


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = np.sort(x)
    at = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.empty(0, np.int64)
    return x[at], np.diff(np.append(at, len(x)))


def count_grams(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, gram, n) over all rows with a language and a text; counted per
    task first, so a hot language reaches the shuffle as one row per gram."""
    src = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), normalised(text).alias("b"))

    def count(batches):
        kept: dict[str, list] = {}
        held: dict[str, int] = {}  # grams listed in it

        def fold(parts):
            g, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            o = np.argsort(g, kind="stable")
            g, n = g[o], n[o]
            at = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
            return [(g[at], np.add.reduceat(n, at))]

        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            names, code = langs.dictionary.to_pylist(), langs.indices.to_numpy(zero_copy_only=False)
            buf, off = binary_column(batch.column(1))
            for part, o, first in _split_long(buf, off):
                g, doc = _grams(part, o)
                which = code[first + doc]
                for k, name in enumerate(names):
                    x, n = _runs(g[which == k])
                    if len(x):
                        kept.setdefault(name, []).append((x, n))
                        held[name] = held.get(name, 0) + len(x)
                        if held[name] > UNFOLDED + 2 * len(kept[name][0][0]):  # the first part is the last fold
                            kept[name] = fold(kept[name])
                            held[name] = len(kept[name][0][0])
        for name, parts in kept.items():
            (g, n), = fold(parts)
            for i in range(0, len(g), 200_000):
                part = g[i:i + 200_000]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(part)), pa.array(part.astype(np.int64)), pa.array(n[i:i + 200_000].astype(np.int64))], ["lang", "gram", "n"])

    return src.mapInArrow(released(count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    langs: list[str]
    levels: list[list[tuple]]  # per language and order: sorted grams, bits of a hit, sorted contexts, bits of an escape

    def bits(self, gram: np.ndarray) -> np.ndarray:
        """Code length of each gram's last byte after its other bytes, per language."""
        out = np.zeros((len(gram), len(self.langs)))
        for k, levels in enumerate(self.levels):
            cost = np.zeros(len(gram))
            left = np.arange(len(gram))
            for order, (grams, hit, contexts, escape) in zip(range(ORDER, -1, -1), levels):
                g = gram[left] & U64((1 << (8 * (order + 1))) - 1)
                i = np.minimum(np.searchsorted(grams, g), len(grams) - 1)
                found = grams[i] == g
                cost[left[found]] += hit[i[found]]
                left, g = left[~found], g[~found]
                c = g >> U64(8)
                i = np.minimum(np.searchsorted(contexts, c), len(contexts) - 1)
                known = contexts[i] == c
                cost[left[known]] += escape[i[known]]
            cost[left] += 8.0
            out[:, k] = cost
        return out


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", max_grams: int = MAX_GRAMS) -> Model:
    counts = count_grams(docs, lang, text)
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    top = (counts.join(total, "lang").withColumn("share", F.col("n") / F.col("total"))
           .orderBy(F.desc("share"), "lang", "gram").limit(max_grams).select("lang", "gram", "n").toPandas())
    langs = sorted(top["lang"].unique())
    levels = []
    for name in langs:
        own = top[top["lang"] == name].sort_values("gram")
        g, n = own["gram"].to_numpy().astype(U64), own["n"].to_numpy().astype(float)
        tree = []
        for order in range(ORDER, -1, -1):
            g4 = g & U64((1 << (8 * (order + 1))) - 1)
            grams, inv = np.unique(g4, return_inverse=True)
            c = np.bincount(inv, weights=n)
            contexts, ctx = np.unique(grams >> U64(8), return_inverse=True)
            n_ctx, d_ctx = np.bincount(ctx, weights=c), np.bincount(ctx)
            tree.append((grams, -np.log2(c / (n_ctx + d_ctx)[ctx]), contexts, -np.log2(d_ctx / (n_ctx + d_ctx))))
        levels.append(tree)
    return Model(langs, levels)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lang_pred, score, bits): the language with the shortest code; score
    is its posterior under equal priors; bits its code length per byte."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(id_col).alias("id"), normalised(text).alias("b"),
                      F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    schema = T.StructType([T.StructField("id", src.schema["id"].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())])

    def score(batches):
        m = shared.value
        for batch in batches:
            buf, off = binary_column(batch.column(1))
            n = len(off) - 1
            letters = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            bits = np.zeros((n, max(1, len(m.langs))))
            for part, o, first in _split_long(buf, off) if m.langs else ():
                g, doc = _grams(part, o)
                key, times = _runs((g << U64(32)) | doc.astype(U64))
                uniq, inv = np.unique(key >> U64(32), return_inverse=True)
                cost, d = m.bits(uniq), (key & U64(0xFFFFFFFF)).astype(np.int64)
                for k in range(len(m.langs)):
                    bits[first:first + len(o) - 1, k] += np.bincount(d, weights=cost[inv, k] * times, minlength=len(o) - 1)
            best = bits.argmin(axis=1)
            least = bits[np.arange(n), best]
            post = 1.0 / np.exp2(np.clip(least[:, None] - bits, -1000, 0)).sum(axis=1)
            ok = letters & bool(m.langs)
            names = np.array(m.langs + [UNDETERMINED], dtype=object)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(names[np.where(ok, best, len(m.langs))], pa.string()),
                pa.array(np.where(ok, post, 0.0)), pa.array(np.where(ok, least / np.maximum(np.diff(off) - ORDER, 1), 0.0))],
                ["id", "lang_pred", "score", "bits_per_byte"])

    return src.mapInArrow(released(score), schema).withColumnRenamed("id", id_col)


def keep_known(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Documents whose language is known: not `und`, and posterior >= `least`.
    Rows keep all their columns; the decision is taken on the text alone."""
    tagged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))
    judged = predict(tagged, model, "row", "text")  # the whole row is the id: no join back, no shuffle
    return judged.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)).select("row.*")
