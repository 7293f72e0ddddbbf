"""Language-model scoring with a hashed maximum-entropy model.

Tokens are words `[^\\x20\\x09-\\x0D]+` with A-Z folded, and one end after each
text. A token falls into a bucket: the `OWN` most frequent training tokens have
one each, all others share `TAILS` buckets by a hash of their last three bytes.
The model is

    P(token | history) = P(class | history) P(member | class, history) P(token | bucket)

with buckets dealt into CLASSES x MEMBERS. The first two factors are softmaxes
(maximum entropy) whose scores add the log frequency and one weight row for each
feature of the history: the token before (n-gram), the two before (n-gram), the
second before alone and the third before alone (skips). Features, and features
with a class, are hashed into tables of 2**ROW_BITS rows. The last factor is
(c + 1) / (N_b + V_b + 1) over a bucket's N_b training tokens of V_b kinds, so one
share of each shared bucket is left for unseen words, and probabilities add up
to one.

1. Counts: tasks count their tokens by 64-bit hash, Spark adds them up. The
   table of counts grows with the corpus and stays in Spark.
2. Training: one pass over all training texts in `ROUNDS` rounds. A task takes
   gradient steps of `STEP` tokens on its texts from the round's weights; Spark
   adds the tasks' weight rows, weighted by how often each was met, and the
   averages are the next round's weights (iterative parameter mixing). A task
   sends at most one model; the driver gets one.
3. Scoring: sparse numpy batches against the broadcast weights. Counts of the
   most frequent tokens (at most `TABLE`) are broadcast with them; a document's
   other tokens are joined with the table of counts.

Broadcast and collected data are bounded by CLASSES, MEMBERS, ROW_BITS and TABLE.
Every text is scored and every training text learned from, whole.

Null and empty texts are the end alone. Repeated rows are scored and learned from
each. Without training texts nothing is known: N is 0 and every token unseen. An
empty table gives no rows. Columns of the results' names are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BYTE_FOLDED, U64, binary_column, mix, pieces, stored, text_bytes, word_hashes

CLASSES, MEMBERS = 32, 32
OWN_MEMBERS = 24                            # of each class: buckets of one token
OWN, TAILS = CLASSES * OWN_MEMBERS, CLASSES * (MEMBERS - OWN_MEMBERS)
BUCKETS = CLASSES * MEMBERS
FEATURES = 4
ROW_BITS = 15                               # at most 16
TABLE = 1 << 19
FIRST_BITS = 19
ROUNDS = 2
RATE = 0.8
STEP = 4096
CHUNK = 1 << 21                             # tokens counted at once
ROWS_SENT = 512                             # weight rows in one row of the shuffle
END = U64(0x0E0D0E0D0E0D0E0D)
_START = BUCKETS                            # the symbol before a text
_SALTS = mix(np.arange(11, 11 + 2 * FEATURES, dtype=U64))


def tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, tail, document offsets) of the tokens of documents laid end to end."""
    h, start, end, w = word_hashes(buf, off)
    n = len(off) - 1
    ending = np.zeros(len(h), U64)
    for back in (1, 2, 3):
        at = end - back
        ending = mix(ending + np.where(at >= start, BYTE_FOLDED[buf[np.maximum(at, 0)]], U64(back)))
    stops = w[1:] + np.arange(n)
    words = np.ones(len(h) + n, bool)
    words[stops] = False
    token, tail = np.full(len(words), END, U64), np.zeros(len(words), np.int16)
    token[words] = h
    tail[words] = (ending % U64(TAILS)).astype(np.int16)
    return token, tail, w + np.arange(n + 1)


def token_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(token, tail, n) over all rows."""
    def run(batches):
        held, size = [], 0

        def flush():
            t, tail = (np.concatenate(x) for x in zip(*held))
            key, first, n = np.unique(t, return_index=True, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(tail[first].astype(np.int32)), pa.array(n.astype(np.int64))], ["token", "tail", "n"])

        for b in batches:
            buf, off = binary_column(b.column(0))
            for i, j in pieces(off):
                t, tail, _ = tokens(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                held.append((t, tail))
                size += len(t)
                if size >= CHUNK:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    parts = docs.select(text_bytes(text).alias("b")).mapInArrow(run, "token long, tail int, n long")
    return parts.groupBy("token", "tail").agg(F.sum("n").alias("n"))


def _bucket_of_own(rank: np.ndarray) -> np.ndarray:
    return rank % CLASSES * MEMBERS + rank // CLASSES


def _bucket_of_tail(tail: np.ndarray) -> np.ndarray:
    return tail % CLASSES * MEMBERS + OWN_MEMBERS + tail // CLASSES


@dataclass
class Vocabulary:
    total: int                # N
    kinds: int                # V
    level: int                # tokens of at least this level (`_level`) are in the table
    keys: np.ndarray          # their hashes, ascending
    counts: np.ndarray
    own: np.ndarray           # their own bucket, -1 without
    inside: np.ndarray        # by bucket: log10 of N_b + V_b + 1 (an own bucket: of c + 1)
    class_bias: np.ndarray    # log frequency of the classes, and of the members of each
    member_bias: np.ndarray
    first: np.ndarray = field(init=False)     # by a key's leading bits: where such keys begin
    longest: int = field(init=False)          # most keys of the same leading bits

    def __post_init__(self):
        self.first = np.searchsorted(self.keys >> U64(64 - FIRST_BITS), np.arange((1 << FIRST_BITS) + 1, dtype=U64)).astype(np.int32)
        self.longest = int(np.diff(self.first).max())

    def place(self, token: np.ndarray) -> np.ndarray:
        """Where tokens stand in the table, or another place where they don't:
        keys are hashes, so few share their leading bits."""
        at = self.first[token >> U64(64 - FIRST_BITS)]
        last = np.int32(len(self.keys) - 1)
        np.minimum(at, last, out=at)
        left = np.flatnonzero(self.keys[at] < token)
        for _ in range(self.longest - 1):
            at[left] = np.minimum(at[left] + 1, last)
            left = left[self.keys[at[left]] < token[left]]
            if not len(left):
                break
        return at

    def look_up(self, token: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, count) of tokens; -1 where the table does not hold a token."""
        bucket, count = _bucket_of_tail(tail.astype(np.int64)), np.full(len(token), -1, np.int64)
        if len(self.keys):
            at = self.place(token)
            hit = self.keys[at] == token
            count[hit] = self.counts[at[hit]]
            own = np.where(hit, self.own[at], -1)
            bucket = np.where(own >= 0, own, bucket)
        return bucket, count


def _level():
    """Eight levels to a doubling of the count."""
    return F.floor(F.log2("n") * 8).cast("int")


def vocabulary(counts: DataFrame, table: int = TABLE) -> Vocabulary:
    """`counts`: a stored table of (token, tail, n)."""
    whole = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    levels = sorted(((r["level"], r["k"]) for r in counts.groupBy(_level().alias("level")).agg(F.count("*").alias("k")).collect()), reverse=True)
    level, held = (levels[0][0] + 1 if levels else 0), 0
    for at, k in levels:
        if held + k > table:
            break
        level, held = at, held + k
    top = counts.where(_level() >= level).select("token", "tail", "n").toPandas()  # at most `table` rows
    key, n = top["token"].to_numpy(np.int64).view(U64), top["n"].to_numpy(np.int64)
    by_count = np.lexsort((key, -n))[:OWN]
    own = np.full(len(key), -1)
    own[by_count] = _bucket_of_own(np.arange(len(by_count)))
    size, kinds = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():  # TAILS rows
        b = _bucket_of_tail(r["tail"])
        size[b], kinds[b] = r["n"], r["v"]
    shared = _bucket_of_tail(top["tail"].to_numpy(np.int64)[by_count])
    np.subtract.at(size, shared, n[by_count])
    np.subtract.at(kinds, shared, 1)
    inside = np.log10(size + kinds + 1)
    size[own[by_count]] = n[by_count]
    inside[own[by_count]] = np.log10(n[by_count] + 1)
    grid = size.reshape(CLASSES, MEMBERS) + 0.5
    o = np.argsort(key)
    return Vocabulary(whole["n"] or 0, whole["v"], level, key[o], n[o], own[o], inside,
                      np.log(grid.sum(axis=1) / grid.sum()).astype(np.float32), np.log(grid / grid.sum(axis=1, keepdims=True)).astype(np.float32))


def features(bucket: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """tokens x FEATURES hashes of the histories; `doc`: first token of each document."""
    before = []
    place = np.arange(len(bucket)) - np.repeat(doc[:-1], np.diff(doc))
    for back in (1, 2, 3):
        b = np.full(len(bucket), _START, np.int64)
        b[back:] = bucket[:-back] if len(bucket) > back else b[back:]
        before.append(np.where(place >= back, b, _START).astype(U64))
    one, two, three = before
    return np.column_stack([mix(one + _SALTS[0]), mix(one * U64(BUCKETS + 1) + two + _SALTS[1]), mix(two + _SALTS[2]), mix(three + _SALTS[3])])


@dataclass
class Weights:
    of_class: np.ndarray      # rows x CLASSES
    of_member: np.ndarray     # rows x MEMBERS

    @staticmethod
    def zero() -> "Weights":
        return Weights(np.zeros((1 << ROW_BITS, CLASSES), np.float32), np.zeros((1 << ROW_BITS, MEMBERS), np.float32))


def _rows(f: np.ndarray) -> np.ndarray:
    return (f >> U64(64 - ROW_BITS)).astype(np.uint16)


def _softmax(weights: np.ndarray, rows: np.ndarray, bias: np.ndarray, target: np.ndarray, all_: bool = True) -> tuple[np.ndarray | None, np.ndarray]:
    """(probabilities if ``all_`` are wanted, log probability of the target)."""
    z = weights.take(rows[:, 0], axis=0)
    for k in range(1, rows.shape[1]):
        z += weights.take(rows[:, k], axis=0)
    z += bias
    z -= z.max(axis=1, keepdims=True)
    own = z[np.arange(len(z)), target]
    np.exp(z, out=z)
    total = z.sum(axis=1)
    if all_:
        z *= (1 / total)[:, None]
    return z if all_ else None, own - np.log(total)


def _factors(w: Weights, v: Vocabulary, f: np.ndarray, bucket: np.ndarray, all_: bool = True):
    """((weights, rows, probabilities, target) of both softmaxes, log probability)."""
    c, m = bucket // MEMBERS, bucket % MEMBERS
    rows = _rows(f)
    p, lp = _softmax(w.of_class, rows, v.class_bias, c, all_)
    rows2 = _rows(mix(f + _SALTS[FEATURES] * (c + 1).astype(U64)[:, None]))
    q, lq = _softmax(w.of_member, rows2, v.member_bias[c], m, all_)
    return ((w.of_class, rows, p, c), (w.of_member, rows2, q, m)), lp.astype(np.float64) + lq


def log10_buckets(w: Weights, v: Vocabulary, bucket: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """log10 P(bucket | history) of every token."""
    f, out = features(bucket, doc), np.empty(len(bucket))
    for i in range(0, len(bucket), STEP):
        out[i:i + STEP] = _factors(w, v, f[i:i + STEP], bucket[i:i + STEP], False)[1]
    return out / np.log(10)


def _segment_sums(p: np.ndarray, take: np.ndarray, at: np.ndarray, short: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of the rows p[take] by segments that start at `at`: (sums, the
    segments' order, their sizes). The first rows of all segments are added
    together, then the second ones and so on; only what long segments hold
    beyond `short` rows is reduced one by one."""
    size = np.diff(np.append(at, len(take)))
    by = np.argsort(-size, kind="stable")
    start, size = at[by], size[by]
    g = p.take(take[start], axis=0)
    for r in range(1, min(short, int(size[0]))):
        k = int(np.searchsorted(-size, -r))
        g[:k] += p.take(take[start[:k] + r], axis=0)
    k = int(np.searchsorted(-size, -short))
    if k:
        rest = size[:k] - short
        ends = np.cumsum(rest)
        pos = np.arange(ends[-1]) + np.repeat(start[:k] + short - (ends - rest), rest)
        g[:k] += np.add.reduceat(p.take(take[pos], axis=0), ends - rest, axis=0)
    return g, by, size


class Trainer:
    """Gradient steps from given weights, with a rate for each row that falls with its gradients."""

    def __init__(self, w: Weights, v: Vocabulary, rate: float = RATE):
        self.w, self.v, self.rate = Weights(w.of_class.copy(), w.of_member.copy()), v, rate
        self.seen = [np.zeros(1 << ROW_BITS, np.float32) for _ in range(2)]
        self.visits = [np.zeros(1 << ROW_BITS, np.float32) for _ in range(2)]

    def learn(self, bucket: np.ndarray, doc: np.ndarray) -> None:
        f = features(bucket, doc)
        for i in range(0, len(bucket), STEP):
            factors, _ = _factors(self.w, self.v, f[i:i + STEP], bucket[i:i + STEP])
            for which, (weights, rows, p, target) in enumerate(factors):
                np.negative(p, out=p)
                p[np.arange(len(p)), target] += 1
                flat = rows.ravel()
                o = np.argsort(flat, kind="stable")  # 16 bits: a radix sort
                flat = flat[o]
                at = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
                g, by, size = _segment_sums(p, o // FEATURES, at)
                row = flat[at[by]]
                self.seen[which][row] += np.einsum("ij,ij->i", g, g)
                weights[row] += g * (self.rate / np.sqrt(self.seen[which][row] + 1))[:, None]
                self.visits[which][row] += size


@dataclass
class Model:
    vocabulary: Vocabulary
    weights: Weights
    counts: DataFrame         # the whole table of counts, in Spark


def _parsed(batches, col: int):
    """Documents of each piece of a batch: (first row, tokens, tails, offsets)."""
    for b in batches:
        buf, off = binary_column(b.column(col))
        for i, j in pieces(off):
            yield b, i, *tokens(buf[off[i]:off[j]], off[i:j + 1] - off[i])


_SENT = "kind int, block int, task int, visits binary, weights binary"


def _trained(docs: DataFrame, v: Vocabulary, w: Weights, text: str, rate: float) -> Weights:
    """One round: every task's weights, averaged row by row."""
    shared = docs.sparkSession.sparkContext.broadcast((v, w))

    def learn(batches):
        trainer, task = None, TaskContext.get().partitionId()
        for _, _, token, tail, doc in _parsed(batches, 0):
            trainer = trainer or Trainer(shared.value[1], shared.value[0], rate)
            trainer.learn(trainer.v.look_up(token, tail)[0], doc)
        for kind, table in enumerate((trainer.w.of_class, trainer.w.of_member) if trainer else ()):
            for lo in range(0, len(table), ROWS_SENT):
                n = trainer.visits[kind][lo:lo + ROWS_SENT]
                if n.any():
                    sent = (table[lo:lo + ROWS_SENT] * (n > 0)[:, None]).astype(np.float16)
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((kind, lo // ROWS_SENT, task, n.tobytes(), sent.tobytes()),
                                                      (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["kind", "block", "task", "visits", "weights"])

    def add(batches):
        held = None
        for b in batches:
            for kind, block, _, n, part in zip(*[c.to_pylist() for c in b.columns]):
                if held is None or held[:2] != (kind, block):
                    if held:
                        yield _sent(held)
                    held = (kind, block, np.zeros(ROWS_SENT), np.zeros((ROWS_SENT, MEMBERS if kind else CLASSES)))
                n = np.frombuffer(n, np.float32)
                held[2][:] += n
                held[3][:] += np.frombuffer(part, np.float16).reshape(held[3].shape) * n[:, None].astype(float)
        if held:
            yield _sent(held)

    def _sent(held):
        kind, block, n, total = held
        mean = (total / np.maximum(n, 1)[:, None]).astype(np.float32)
        return pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([block], pa.int32()), pa.array([(n > 0).tobytes()]), pa.array([mean.tobytes()])],
                                          ["kind", "block", "met", "weights"])

    parts = docs.select(text_bytes(text).alias("b")).mapInArrow(learn, _SENT)
    sums = (parts.repartition("kind", "block").sortWithinPartitions("kind", "block", "task")  # in one order, so reruns agree
            .mapInArrow(add, "kind int, block int, met binary, weights binary"))
    out = Weights(w.of_class.copy(), w.of_member.copy())
    for r in sums.toLocalIterator():  # the rows of one model
        table = out.of_member if r["kind"] else out.of_class
        met, lo = np.frombuffer(r["met"], bool), r["block"] * ROWS_SENT
        table[lo:lo + ROWS_SENT][met] = np.frombuffer(r["weights"], np.float32).reshape(ROWS_SENT, -1)[met]
    shared.destroy()
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rounds: int = ROUNDS, rate: float = RATE, table: int = TABLE) -> Model:
    """The model of all texts of `docs`; each is learned from in one round, by a hash of its id."""
    counts = stored(token_counts(docs, text), "token-counts")
    v, w = vocabulary(counts, table), Weights.zero()
    for r in range(rounds if v.total else 0):
        w = _trained(docs.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(rounds)) == r), v, w, text, rate)
    return Model(v, w, counts)


_NUMBERS = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` without the text, with n_tokens, n_known (seen in training),
    train_tokens (N), base_score (log10 of the add-one unigram probability) and
    score (log10 probability of the model)."""
    others = [c for c in docs.columns if c not in (text, *_NUMBERS)]
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), text_bytes(text).alias("b"))
    shared = docs.sparkSession.sparkContext.broadcast((model.vocabulary, model.weights))
    schema = T.StructType([src.schema["row"], T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()),
                           T.StructField("score", T.DoubleType()), T.StructField("rare", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType()))])

    def run(batches):
        v, w = shared.value
        unit = np.log10(v.total + v.kinds + 1)
        for b, i, token, tail, doc in _parsed(batches, 1):
            bucket, count = v.look_up(token, tail)
            held = count >= 0
            seen = np.log10(np.maximum(count, 0) + 1.0)
            known = np.add.reduceat(count > 0, doc[:-1], dtype=np.int64)
            size = np.diff(doc)
            base = np.add.reduceat(seen - unit, doc[:-1])
            own = np.add.reduceat(log10_buckets(w, v, bucket, doc) + seen - v.inside[bucket], doc[:-1])
            # tokens outside the table, once a document
            which = np.repeat(np.arange(len(size)), size)[~held]
            rest = token[~held]
            o = np.lexsort((rest, which))
            which, rest = which[o], rest[o]
            at = np.flatnonzero(np.concatenate(([True], (which[1:] != which[:-1]) | (rest[1:] != rest[:-1])))) if len(rest) else np.empty(0, np.int64)
            off = pa.array(np.searchsorted(which[at], np.arange(len(size) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                b.column(0).slice(i, len(size)), pa.array(size.astype(np.int64)), pa.array(known), pa.array(base), pa.array(own),
                pa.ListArray.from_arrays(off, pa.array(rest[at].view(np.int64))),
                pa.ListArray.from_arrays(off, pa.array(np.diff(np.append(at, len(rest))).astype(np.int32)))], schema.names)

    first = stored(src.mapInArrow(run, schema).withColumn("at", F.monotonically_increasing_id()), "lm-scores")
    shared.destroy()
    # a token outside the table adds log10(c + 1), nothing where it was never seen
    rare = first.select("at", F.explode(F.arrays_zip("rare", "times")).alias("t")).select("at", F.col("t.rare").alias("token"), F.col("t.times").alias("times"))
    low = model.counts.where(_level() < model.vocabulary.level).select("token", "n")
    found = rare.join(low, "token").groupBy("at").agg(F.array_sort(F.collect_list(F.struct("token", "times", "n"))).alias("found"))
    more = found.select("at", F.aggregate("found", F.lit(0.0), lambda s, x: s + x["times"] * F.log10(x["n"] + 1.0)).alias("more"),
                        F.aggregate("found", F.lit(0).cast("long"), lambda s, x: s + x["times"]).alias("known"))
    add = F.coalesce(F.col("more"), F.lit(0.0))
    return first.join(more, "at", "left").select(
        "row.*", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(model.vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("base_score") + add).alias("base_score"), (F.col("score") + add).alias("score"))
