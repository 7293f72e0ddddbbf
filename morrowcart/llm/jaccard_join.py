"""Exact n-gram Jaccard self-join by partitioned universes (pigeonhole).

A document's set holds its distinct `WORDS`-word shingles (64-bit hashes).
Sizes are cut into bands such that two sets that link lie in the same or in
neighbouring bands; every set takes part in two instances, one for its own
band with the one below and one with the band above. An instance hashes the
shingle universe into segments. Two sets of its sizes that link differ in at
most H shingles, so with m0 segments indexed by their exact subset and m1
segments indexed by the subset and its one-deletion neighbourhood, where
m0 + 2 m1 = H + 1 + e, a linking pair agrees (up to one deletion) on an m1
segment or exactly on at least 1 + e of the m0 segments. Each set may
therefore leave out its e costliest exact segments (fewest shingles: empty
ones first, the order is a function of the signature alone, so both sides
leave out the same ones). `allocate` chooses m0, m1 and e per instance by cost:
signatures written plus the false candidates expected for the number of sets
in the instance (the corpus' size histogram).

Equal sets share one node (a 64-bit digest of the set), so copies cost one
signature list a task and one node. A second digest tells sets apart that share
the first; such a digest names no set, they go by their next one. Sets that share a signature form a group.
Only what components need is verified: in two rounds, for every node one other
node that it shares a signature with. Groups that lie in one component by then
are done. Of the others all pairs across components are compared: groups of up
to `LISTED` nodes list those whose sizes allow a link (distinct over all
groups), larger ones compare in blocks of `BLOCK` by `BLOCK` sets (a matrix
product over the shingles that two or more of them hold) that hand on one link
per set, so a large group never makes a list of pairs. Large groups often hold
the same nodes many times over: those that share nodes are put together where
that copies fewer sets than comparing each alone. Verification is exact on the
shingle hashes: 100 * intersection >= `PERCENT` * union. Before a listed pair's
sets travel, the counts of their shingles by `CELLS` cells bound the
intersection from above; pairs whose bound is too small cannot link.

Null and empty texts have an empty set, link with nothing and are their own
component. Repeated rows are equal sets and link. A null id gets a null
component. With fewer than WORDS words the whole sequence is the one shingle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_column, key_filter, may_hold, mix, pieces, released, shuffle_partitions, stored, text_bytes, U64, word_hashes
from .components import components, union

WORDS = 4
PERCENT = 85
LISTED = 32
BLOCK = 512
CELLS = 256
SIGNATURES_PER_PARTITION = 4_000_000
_K = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9), U64(0x27D4EB2F165667C5),
      U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB), U64(0x8EBC6AF09C88C6E3)]


def shingle_sets(buf: np.ndarray, off: np.ndarray, words: int = WORDS):
    """For each document of `buf`: its sorted distinct shingle hashes."""
    for i, j in pieces(off):
        h, _, _, w = word_hashes(buf[off[i]:off[j]], off[i:j + 1] - off[i])
        n = max(0, len(h) - words + 1)
        s = np.full(n, U64(words), dtype=U64)
        for k in range(words):
            s += mix(h[k:k + n] ^ _K[k % len(_K)]) * _K[(k + 3) % len(_K)]
        s = mix(s)
        for lo, hi in zip(w[:-1], w[1:]):
            if hi - lo >= words:
                yield np.unique(s[lo:hi - words + 1])
            elif hi > lo:
                one = U64(hi - lo)
                for k in range(lo, hi):
                    one = mix(np.array([one ^ h[k]], U64) + _K[0])[0]
                yield np.array([one], dtype=U64)
            else:
                yield np.empty(0, dtype=U64)


def digest(s: np.ndarray, seed: int, bits: int = 64) -> int:
    """Digest of a set, as a signed 64-bit number."""
    x = mix(s ^ mix(_K[1] + np.array([seed], U64) * _K[2])).sum(dtype=U64, keepdims=True) + np.array([len(s)], U64) * _K[0]
    return int((mix(x) >> U64(64 - bits)).view(np.int64)[0])


@dataclass(frozen=True)
class Names:
    """How sets are named: by the first of their digests that is not known to be `shared` by different sets."""
    shared: frozenset = frozenset()
    bits: int = 64

    def of(self, s: np.ndarray) -> int:
        seed = 1
        while (me := digest(s, seed, self.bits)) in self.shared:
            seed += 1
        return me


CHECK = 0  # the seed of the digest that no set is named by


# ---- bands and allocation ----

def bands(largest: int, percent: int = PERCENT) -> list[int]:
    """Lower ends of the size bands up to `largest`, and one end beyond."""
    ends = [1]
    while ends[-1] <= largest:
        ends.append(max(ends[-1] + 1, (ends[-1] - 1) * 100 // percent + 1))
    return ends


@dataclass(frozen=True)
class Instance:
    exact: int      # m0
    deletion: int   # m1
    skip: int       # e


def allocate(ends: list[int], sets: dict[int, int], percent: int = PERCENT) -> list[Instance]:
    """One allocation per instance k, which holds the sizes ends[k-1] <= s < ends[k+1]."""
    out = []
    for k in range(len(ends)):
        top = ends[min(k + 1, len(ends) - 1)] - 1
        most = (100 - percent) * 2 * top // (100 + percent)  # H
        others = sum(n for b, n in sets.items() if b in (k - 1, k)) / 1000
        best = None
        for m1 in sorted({0, 1, (most + 2) // 2, most // 4, most // 16}):
            if m1 > (most + 2) // 2:
                continue
            for e in sorted({0, 1, 1 + most // 10, 1 + most // 5}):
                m0 = max(0, most + 1 + e - 2 * m1)
                if m0 + m1 == 0 or (m0 == 0 and e) or (m0 and e == 0):
                    continue
                g = top / (m0 + m1)
                cost = max(0, m0 - e) * (1 + others * np.exp(-g) * (e + 1) ** -0.5) + m1 * (1 + g) * (1 + others * np.exp(1 - g))
                if best is None or cost < best[0]:
                    best = cost, Instance(m0, m1, e)
        out.append(best[1])
    return out


def signatures(s: np.ndarray, k: int, at: Instance) -> np.ndarray:
    """Signatures of the sorted set `s` in instance k."""
    m = at.exact + at.deletion
    t = mix(s ^ mix(np.array([k + 1], U64) * _K[2]))
    seg = (t % U64(m)).astype(np.int64)
    o = np.argsort(seg, kind="stable")
    seg, t = seg[o], mix(t[o] ^ _K[3])
    n = np.bincount(seg, minlength=m)
    total = np.zeros(m, dtype=U64)
    some = n > 0
    total[some] = np.add.reduceat(t, (np.cumsum(n) - n)[some])
    name = mix(np.arange(m, dtype=U64) * _K[4] + np.array([k], U64) * _K[5])
    sig = mix(total * _K[0] + name)
    out = []
    if at.exact:
        own, size = sig[:at.exact], n[:at.exact]
        out.append(own[np.lexsort((own, size))[at.skip:]] if at.skip else own)
    if at.deletion:
        last = seg >= at.exact
        out += [sig[at.exact:], mix((total[seg[last]] - t[last]) * _K[0] + name[seg[last]])]
    return np.unique(np.concatenate(out))


# ---- the join ----

def set_sizes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS, names: Names = Names()) -> DataFrame:
    """(id, n_shingles, node, check): node is null for an empty set."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text).alias("b"))

    def run(batches):
        for b in batches:
            buf, off = binary_column(b.column(1))
            n, node, check = [], [], []
            for s in shingle_sets(buf, off, words):
                n.append(len(s))
                node.append(names.of(s) if len(s) else None)
                check.append(digest(s, CHECK) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(check, pa.int64())], ["id", "n_shingles", "node", "check"])

    return src.mapInArrow(released(run), "id long, n_shingles long, node long, check long")


def _groups(docs: DataFrame, sizes: DataFrame, text: str, words: int, percent: int, names: Names) -> DataFrame:
    """(gid, node): nodes that share a signature, without groups of equal members."""
    spark = docs.sparkSession
    largest = sizes.agg(F.max("n_shingles")).first()[0] or 0
    ends = bands(largest, percent)
    edge = np.array(ends)
    band = F.lit(-1)
    for e in ends[:-1]:
        band = band + (F.col("n_shingles") >= e).cast("int")
    per_band = {r["band"]: r["n"] for r in sizes.where("n_shingles > 0").groupBy(band.alias("band")).agg(F.count("*").alias("n")).toLocalIterator()}
    plan = allocate(ends, per_band, percent)
    expected = sum(n * sum(plan[k].exact + plan[k].deletion + (ends[b] * plan[k].deletion // max(1, plan[k].exact + plan[k].deletion)) for k in (b, min(b + 1, len(plan) - 1)))
                   for b, n in per_band.items())
    parts = max(shuffle_partitions(spark), -(-expected // SIGNATURES_PER_PARTITION))

    def index(batches):
        seen: set[int] = set()
        sig, node, held = [], [], 0
        for b in batches:
            buf, off = binary_column(b.column(0))
            for s in shingle_sets(buf, off, words):
                if not len(s):
                    continue
                me = names.of(s)
                if me in seen:
                    continue
                if len(seen) < 2_000_000:  # only saves work: repeats are merged after the shuffle too
                    seen.add(me)
                k = int(np.searchsorted(edge, len(s), side="right")) - 1
                for inst in (k, k + 1):
                    x = signatures(s, inst, plan[min(inst, len(plan) - 1)])
                    sig.append(x)
                    node.append(np.full(len(x), me, dtype=np.int64))
                    held += len(x)
                if held > 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sig).view(np.int64)), pa.array(np.concatenate(node))], ["sig", "node"])
                    sig, node, held = [], [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sig).view(np.int64)), pa.array(np.concatenate(node))], ["sig", "node"])

    def group(batches):
        rows = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not rows:
            return
        sig, node = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
        del rows
        o = np.argsort(sig, kind="stable")
        sig, node = sig[o], node[o]
        n = np.diff(np.append(np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1]))), len(sig)))
        keep = np.repeat(n > 1, n)
        sig, node = sig[keep], node[keep]
        o = np.lexsort((node, sig))
        sig, node = sig[o], node[o]
        keep = np.concatenate(([True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1]))) if len(sig) else np.empty(0, bool)
        sig, node = sig[keep], node[keep]
        if not len(sig):
            return
        at = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
        n = np.diff(np.append(at, len(sig)))
        members = mix(np.add.reduceat(mix(node.view(U64)), at) + n.astype(U64))
        _, first = np.unique(members, return_index=True)
        chosen = np.zeros(len(at), bool)
        chosen[first] = True
        keep = np.repeat(chosen & (n > 1), n)
        sig, node = np.repeat(members, n).view(np.int64)[keep], node[keep]
        for i in range(0, len(sig), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(sig[i:i + 200_000]), pa.array(node[i:i + 200_000])], ["gid", "node"])

    sigs = docs.select(text_bytes(text).alias("b")).mapInArrow(released(index), "sig long, node long")
    # the members of a group name it, so equal groups of different partitions meet here
    return stored(sigs.repartition(parts, "sig").mapInArrow(released(group), "gid long, node long").distinct(), "signature-groups")


def _sets_of(docs: DataFrame, nodes: DataFrame, id_col: str, text: str, words: int, names: Names) -> DataFrame:
    """(node, s, cells): the shingle sets of `nodes` (node, rep), from their
    representatives' texts, and how many shingles each cell holds (a byte each;
    null if one holds more than a byte can say)."""
    needed = key_filter(nodes, "rep", nodes.count())
    shared = docs.sparkSession.sparkContext.broadcast(needed)
    src = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), text_bytes(text).alias("b"))

    def run(batches):
        for b in batches:
            keep = may_hold(shared.value, b.column(0).to_numpy().astype(np.int64))
            b = b.filter(pa.array(keep))
            if not b.num_rows:
                continue
            buf, off = binary_column(b.column(1))
            node, s_, cells = [], [], []
            for s in shingle_sets(buf, off, words):
                node.append(names.of(s) if len(s) else 0)
                s_.append(s.tobytes())
                n = np.bincount((s % U64(CELLS)).astype(np.int64), minlength=CELLS)
                cells.append(n.astype(np.uint8).tobytes() if n.max() < 256 else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(node, pa.int64()), pa.array(s_, pa.binary()), pa.array(cells, pa.binary())], ["id", "node", "s", "cells"])

    found = src.mapInArrow(released(run), "id long, node long, s binary, cells binary")
    return stored(found.join(nodes.select(F.col("rep").alias("id"), "node"), ["id", "node"], "left_semi").dropDuplicates(["id", "node"]).select("node", "s", "cells"), "verify-sets")


def _needed(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of `sets` that a filter of bounded size does not rule out for `nodes`
    (node), so that a join with these nodes moves few other sets."""
    shared = sets.sparkSession.sparkContext.broadcast(key_filter(nodes, "node", nodes.count()))

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(may_hold(shared.value, b.column(0).to_numpy().astype(np.int64))))

    return sets.select("node", "s").mapInArrow(released(run), "node long, s binary")


def _may_link(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose cells do not rule a link out."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("cells").alias("ca")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("cells").alias("cb")), "b").select("a", "b", "ca", "cb"))

    def run(batches):
        for batch in batches:
            known = pa.compute.and_(batch.column(2).is_valid(), batch.column(3).is_valid())
            x, y = (binary_column(batch.column(k).filter(known))[0].reshape(-1, CELLS) for k in (2, 3))
            most = np.minimum(x, y).sum(axis=1, dtype=np.int64)
            known = known.to_numpy(zero_copy_only=False).copy()
            keep = ~known
            keep[known] = 100 * most >= percent * (x.sum(axis=1, dtype=np.int64) + y.sum(axis=1, dtype=np.int64) - most)
            keep = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return stored(both.mapInArrow(released(run), "a long, b long"), "pairs")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    pairs = _may_link(pairs, sets, percent)
    sets = _needed(sets, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b").select("a", "b", "sa", "sb"))

    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    ok.append(False)
                    continue
                same = len(x) + len(y) - len(np.union1d(x, y))
                ok.append(100 * same >= percent * (len(x) + len(y) - same))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return both.mapInArrow(released(run), "a long, b long")


def linked(sets: list[np.ndarray], percent: int, columns: int = 4096) -> np.ndarray:
    """For each of the sets the first one of its component under the links among them."""
    size = np.array([len(x) for x in sets])
    flat = np.concatenate(sets)
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    new = np.cumsum(shared) - 1
    owner = np.repeat(np.arange(len(sets)), size)
    keep = shared[column]
    owner, column = owner[keep], new[column[keep]]
    o = np.argsort(column, kind="stable")
    owner, column = owner[o], column[o]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, int(shared.sum()), columns):  # counts stay exact below 2**24
        i, j = np.searchsorted(column, [lo, lo + columns])
        m = np.zeros((len(sets), columns), np.float32)
        m[owner[i:j], column[i:j] - lo] = 1
        both += m @ m.T
    i, j = np.nonzero(np.triu(100 * both >= percent * (size[:, None] + size[None, :] - both), 1))
    first = np.arange(len(sets))
    union(first, i, j)
    return first


def _unsettled(groups: DataFrame, comp: DataFrame) -> DataFrame:
    """(gid, node, c, n) of the groups whose nodes lie in several components."""
    member = groups.join(comp, "node", "left").select("gid", "node", F.coalesce("component", "node").alias("c"))
    apart = member.groupBy("gid").agg(F.count("*").alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo != hi")
    return member.join(apart.select("gid", "n"), "gid")


def _together(large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`large` (gid, node, c, n) in two parts of the same columns: groups that share
    nodes as one group of their distinct nodes, where its blocks copy no more sets
    than theirs do, and the other groups as they are."""
    least = large.groupBy("gid").agg(F.min("node").alias("least"))
    touching = components(large.join(least, "gid"), "node", "least", "touching-groups").select("node", F.col("component").alias("cluster"))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK)
    x = large.join(touching, "node")
    alone = x.groupBy("cluster").agg(F.sum(blocks("n")).alias("alone"))
    whole = touching.groupBy("cluster").agg(F.count("*").alias("members"))
    chosen = whole.join(alone, "cluster").where(F.col("members") * blocks("members") <= F.col("alone")).select("cluster", "members")
    x = stored(x.join(chosen, "cluster", "left"), "touching-groups")
    return (x.where("members IS NOT NULL").select(F.col("cluster").alias("gid"), "node", "c", F.col("members").alias("n")).distinct(),
            x.where("members IS NULL").select("gid", "node", "c", "n"))


def _settle(x: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join what links within the groups of `x` (gid, node, c, n)."""
    x = x.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("node", "gid"), F.col("blocks")).cast("int")
    x = (x.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
         .select("gid", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "c"))

    def settle(t: pa.Table) -> pa.Table:
        node, c = t["node"].to_numpy(), t["c"].to_numpy()
        o = np.argsort(node)
        node, c = node[o], c[o]
        if len(np.unique(c)) < 2:
            pick = np.arange(len(node))
        else:
            s = t["s"].combine_chunks()
            pick = linked([np.frombuffer(s[int(k)].as_buffer(), U64) for k in o], percent)
        out = pick != np.arange(len(node))
        return pa.table({"a": node[pick[out]], "b": node[out]})

    sets = _needed(sets, x.select("node").distinct())
    return x.join(sets, "node").groupBy("gid", "i", "j").applyInArrow(settle, "a long, b long")


def _named(docs: DataFrame, id_col: str, text: str, words: int, bits: int = 64) -> tuple[Names, DataFrame, DataFrame]:
    """Names that tell all sets apart, the documents' sets by name, and one row a
    name. Of n sets about n * n / 2**65 digests are shared (3 of 1e10 sets); they
    are found by the second digest, and the texts are then read once more."""
    names = Names(bits=bits)
    while True:
        sizes = stored(set_sizes(docs, id_col, text, words, names), "set-sizes")
        classes = stored(sizes.where("node IS NOT NULL AND id IS NOT NULL").groupBy("node").agg(
            F.min("id").alias("rep"), F.max("n_shingles").alias("size"), F.min("check").alias("lo"), F.max("check").alias("hi")), "equal-sets")
        shared = frozenset(r["node"] for r in classes.where("lo != hi").select("node").toLocalIterator())
        if not shared:
            return names, sizes, classes
        names = Names(names.shared | shared, bits)


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT,
                    digest_bits: int = 64) -> DataFrame:
    """(id, n_shingles, component_id) for every row."""
    names, sizes, classes = _named(docs, id_col, text, words, digest_bits)
    groups = _groups(docs.where(F.col(id_col).isNotNull()), sizes, text, words, percent, names)
    nodes = groups.select("node").distinct().join(classes.select("node", "rep"), "node")
    sets = _sets_of(docs, nodes, id_col, text, words, names)
    # each node with one partner of its groups: the smallest node, then the largest of another component
    least = groups.groupBy("gid").agg(F.min("node").alias("a"))
    pairs = groups.join(least, "gid").where("node != a").groupBy(F.col("node").alias("b")).agg(F.min("a").alias("a"))
    tested = stored(pairs.select("a", "b"), "candidates")
    links = stored(_verify(tested, sets, percent), "links")
    comp = stored(components(links, "a", "b", "set-components"), "node-components")
    rest = _unsettled(groups, comp)
    most = rest.groupBy("gid").agg(F.max(F.struct("node", "c")).alias("z"))
    pairs = rest.join(most, "gid").where("c != z.c").groupBy(F.col("node").alias("a")).agg(F.max("z.node").alias("b")).join(tested, ["a", "b"], "left_anti")
    again = stored(pairs, "candidates")
    if not again.isEmpty():
        tested = tested.unionByName(again)
        links = links.unionByName(stored(_verify(again, sets, percent), "links"))
        comp = stored(components(links, "a", "b", "set-components"), "node-components")
        rest = _unsettled(rest.select("gid", "node"), comp)
    # what is left: pairs across components, listed for small groups, in blocks for large ones
    rest = stored(rest, "unsettled-groups")
    if not rest.isEmpty():
        one, alone = _together(rest.where(F.col("n") > LISTED))
        of = classes.select("node", "size").join(one.select("node", F.col("gid").alias("cluster")), "node", "left")
        few = rest.where(F.col("n") <= LISTED).join(of, "node")
        x, y = (few.select("gid", F.struct("c", "size", "cluster").alias(of), F.col("node").alias(node)) for node, of in (("a", "x"), ("b", "y")))
        fits = 100 * F.least("x.size", "y.size") >= percent * F.greatest("x.size", "y.size")
        apart = (F.col("x.c") != F.col("y.c")) & ~F.coalesce(F.col("x.cluster") == F.col("y.cluster"), F.lit(False))
        pairs = x.join(y, "gid").where("a < b").where(fits & apart).select("a", "b").distinct().join(tested, ["a", "b"], "left_anti")
        more = (_verify(pairs, sets, percent).unionByName(_settle(alone, sets, percent))
                .unionByName(_settle(one, sets, percent)))
        comp = stored(components(links.unionByName(stored(more, "links")), "a", "b", "set-components"), "node-components")
    # components of nodes, then the smallest document id of each
    of = classes.join(comp, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("c"))
    best = of.groupBy("c").agg(F.min("rep").alias("component_id"))
    of = of.join(best, "c").select("node", "component_id")
    return sizes.join(of, "node", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.when(F.col("id").isNull(), None).otherwise(F.coalesce("component_id", "id")).alias("component_id"))
