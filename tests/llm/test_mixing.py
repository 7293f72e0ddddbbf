import pytest

from morrowcart.llm import mixing as M
from llm_fixtures import docs_of  # noqa: F401


def _brute_targets(sizes, epochs=3):
    """Excess shared again by weight until no target is above its stop."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, bound = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in bound]
        rest = total - sum(bound.values())
        share = {s: weight[s] * rest / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= epochs * sizes[s]]
        if not over:
            return {**bound, **share}
        bound |= {s: epochs * sizes[s] for s in over}


def _check(rows, doc_words):
    sizes = {}
    for _, s, n in doc_words:
        sizes[s] = sizes.get(s, 0) + n
    want = _brute_targets(sizes)
    taken = {}
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        assert r.taken // max(1, r.size) in (int(r.target // max(1, r.source_size)), int(r.target // max(1, r.source_size)) + 1) or r.size == 0
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in taken.items():
        assert abs(t - want[s]) < 1


def test_targets_and_epochs(docs_of):
    rows = []
    for s, n in (("a", 400), ("b", 10), ("c", 60), ("d", 300), (None, 20), ("Z", 5)):
        rows += [(len(rows) + k, "w " * (1 + (k * 7) % 13), "en", s) for k in range(n)]
    docs = docs_of(rows)
    got = M.mix(docs).collect()
    _check(got, [(i, s, len(t.split())) for i, t, _, s in rows])
    again = M.mix(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_quality_weights_draw_more(spark, docs_of):
    rows = [(i, "w " * 10, "en", "a" if i < 2000 else "b") for i in range(2300)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(2000)] + [(0, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = M.mix(docs_of(rows), labels=labels).collect()
    a = [r for r in got if r.source == "a"]
    frac = {q: sum(r.taken for r in a if r.doc_id % 2 == q and r.doc_id) for q in (0, 1)}
    assert len(got) == 2300 and frac[1] > 1.2 * frac[0]


def test_edges(docs_of):
    got = M.mix(docs_of([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x y z"), (4, "w " * 100_000)])).collect()
    assert len(got) == 6 and sum(r.taken for r in got) == 100_007
    assert M.mix(docs_of([(1, "a")]).where("false")).count() == 0
    assert [r.taken for r in M.mix(docs_of([(1, None), (2, "")])).collect()] == [0, 0]
    clash = docs_of([(1, "a b c")]).selectExpr("*", "9 AS size", "9 AS key", "9 AS bucket", "9 AS target")
    assert M.mix(clash).first().taken == 3
