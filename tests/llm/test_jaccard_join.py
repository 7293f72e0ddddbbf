import random
import re

import numpy as np

from morrowcart.llm import jaccard_join as J
from llm_fixtures import docs_of  # noqa: F401


def _set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return set()
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)}


def _brute(rows):
    sets = [_set(t) for _, t in rows]
    comp = {i: i for i, _ in rows}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for a, (i, _) in enumerate(rows):
        for b, (j, _) in enumerate(rows[:a]):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                p, q = root(i), root(j)
                comp[max(p, q)] = min(p, q)
    return {i: (len(sets[a]), root(i)) for a, (i, _) in enumerate(rows)}


def _result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def _corpus(seed, n=30, copies=6):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(4000)]
    rows, i = [], 0
    for _ in range(n):
        base = rng.choices(vocab, k=rng.choice([1, 2, 3, 4, 5, 8, 12, 20, 60, 200, 700]))
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, max(1, len(w) // 60), max(1, len(w) // 50), max(1, len(w) // 45)])):
                k = rng.randrange(len(w))
                what = rng.random()
                if what < 0.4:
                    w[k] = rng.choice(vocab)
                elif what < 0.7 and len(w) > 1:
                    del w[k]
                else:
                    w.insert(k, rng.choice(vocab))
            rows.append((i, " ".join(w)))
            i += 1
    rng.shuffle(rows)
    return [(k, t) for k, (_, t) in enumerate(rows)]


def test_matches_brute_force(docs_of):
    rows = _corpus(3) + _corpus(4)
    rows = [(i * 3 + 5, t) for i, (_, t) in enumerate(rows)]
    assert _result(J.jaccard_classes(docs_of(rows))) == _brute(rows)


def test_large_group_of_near_copies_and_common_passage(docs_of):
    rng = random.Random(9)
    vocab = [f"v{i}" for i in range(3000)]
    base, passage = rng.choices(vocab, k=300), rng.choices(vocab, k=60)
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(300)] = rng.choice(vocab)
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(rng.choices(vocab, k=80) + passage)) for i in range(150)]
    assert _result(J.jaccard_classes(docs_of(rows))) == _brute(rows)


def test_edges(docs_of):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "A b"), (9, "a  B\n"), (5, "one two three four"), (6, "one two three four"), (7, "x"), (8, "y " * 60_000), (10, "y " * 50_000)]
    assert _result(J.jaccard_classes(docs_of(rows))) == _brute(rows)
    twice = J.jaccard_classes(docs_of([(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e")])).collect()
    assert sorted((r.doc_id, r.component_id) for r in twice if r.doc_id) == [(1, 1), (1, 1)]
    assert [r.component_id for r in twice if r.doc_id is None] == [None]
    assert J.jaccard_classes(docs_of([(1, "a")]).where("false")).count() == 0
    clash = docs_of([(1, "a b c d e"), (2, "a b c d e")]).selectExpr("*", "1 AS node", "2 AS s", "3 AS component_id")
    assert _result(J.jaccard_classes(clash)) == {1: (2, 1), 2: (2, 1)}


def test_sets_that_share_a_digest_are_told_apart(docs_of):
    """Digests of 12 bits: several of the sets share one, and go by another."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12))) for i in range(150)]
    rows += [(500 + i, t) for i, t in rows[::3]]
    names, sizes, classes = J._named(docs_of(rows), "doc_id", "text", 4, 12)
    assert names.shared and classes.count() == 150
    assert sizes.select("id", "node").distinct().count() == len(rows)
    assert _result(J.jaccard_classes(docs_of(rows), digest_bits=12)) == _brute(rows)


def test_no_link_is_ruled_out_by_its_cells(spark):
    """Pairs about the threshold, small and large; a set with a cell of more than 255 is never ruled out."""
    rng = np.random.default_rng(8)
    sets, pairs, links = [], [], set()
    for k, n in enumerate([1, 2, 5, 7, 20, 60, 300, 3000] * 12 + [80_000]):
        a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        change = int(rng.integers(0, 0.12 * n + 2))
        b = np.unique(np.concatenate([a[min(change, n - 1):], rng.integers(0, 2 ** 63, change // 2).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        pairs.append((2 * k, 2 * k + 1))
        if 100 * both >= 85 * (len(a) + len(b) - both):
            links.add(pairs[-1])
        for node, x in zip(pairs[-1], (a, b)):
            n = np.bincount((x % np.uint64(J.CELLS)).astype(int), minlength=J.CELLS)
            sets.append((node, x.tobytes(), n.astype(np.uint8).tobytes() if n.max() < 256 else None))
    assert 20 < len(links) < len(pairs) and sets[-1][2] is None
    sets = spark.createDataFrame(sets, "node long, s binary, cells binary")
    pairs = spark.createDataFrame(pairs, "a long, b long")
    left = {(r.a, r.b) for r in J._may_link(pairs, sets, 85).collect()}
    assert links <= left
    far = spark.createDataFrame([(2 * k, 2 * k + 3) for k in range(90)], "a long, b long")
    assert J._may_link(far, sets, 85).count() < 15
    assert {(r.a, r.b) for r in J._verify(pairs, sets, 85).collect()} == links


def test_touching_large_groups_become_one(spark):
    """Many groups over the same nodes are one; a chain of groups that touch in one node stays apart."""
    rows = [(g, n, n, 40) for g in range(20) for n in range(g % 3, 40 + g % 3)]
    rows += [(100 + g, 1000 + 600 * g + n, n, 601) for g in range(4) for n in range(601)]
    one, alone = J._together(spark.createDataFrame(rows, "gid long, node long, c long, n long"))
    assert sorted(r.node for r in one.collect()) == list(range(42)) and one.select("gid", "n").distinct().collect() == [(0, 42)]
    assert alone.count() == 4 * 601 and alone.select("gid").distinct().count() == 4
    none = J._together(spark.createDataFrame([], "gid long, node long, c long, n long"))
    assert none[0].count() == none[1].count() == 0


def test_every_pair_that_links_shares_a_signature():
    """The pigeonhole argument, on random sets near the threshold, for every kind of allocation."""
    rng = np.random.default_rng(5)
    ends = J.bands(3000)
    plan = J.allocate(ends, {b: 10 ** (b % 6) for b in range(len(ends))})
    assert any(p.deletion for p in plan) and any(p.exact for p in plan)
    for _ in range(400):
        n = int(rng.integers(1, 12)) if rng.random() < 0.4 else int(rng.integers(12, 2500))
        a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        drop, add = (int(rng.integers(0, max(1, 0.2 * n) + 1)) for _ in range(2))
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2 ** 63, add).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 85 * (len(a) + len(b) - both):
            continue
        sig = []
        for s in (a, b):
            k = int(np.searchsorted(ends, len(s), side="right")) - 1
            sig.append(np.concatenate([J.signatures(s, i, plan[min(i, len(plan) - 1)]) for i in (k, k + 1)]))
        assert len(np.intersect1d(*sig)), (len(a), len(b), both)
